"""Greedy longest-match encoding, id tables, tokenizer comparison and lexicon segmentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import matching
from textloom.operators.matching import UNK
from textloom.session import salted_join, small_side, spread


def _longest_matches(units: DataFrame, key: str, vocab: DataFrame, continued: bool) -> DataFrame:
    """``(key, starts)``: for each start position the end of the longest vocabulary entry beginning there.

    Substrings are cut no longer than the longest entry and looked up with an equi-join; ``units`` is distributed by
    ``key``, so both aggregates run where the rows already are.
    """
    entries = vocab.select("token").distinct()
    longest = entries.agg(F.max(F.length("token"))).scalar()
    starts = units.withColumn("s", F.explode(F.sequence(F.lit(1), F.length(key)))).withColumn("longest", longest)
    last = F.least(F.length(key), F.col("s") + F.col("longest") - 1)
    spans = starts.select(key, "s", F.explode(F.sequence(F.col("s"), last)).alias("e"))
    piece = F.substring(F.col(key), F.col("s"), F.col("e") - F.col("s") + 1)
    if continued:
        piece = F.when(F.col("s") == 1, piece).otherwise(F.concat(F.lit("##"), piece))
    hits = spans.withColumn("token", piece).join(small_side(entries), "token", "left_semi")
    ends = hits.groupBy(key, "s").agg(F.max("e").alias("e"))
    return ends.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("s", "e"))).alias("ends"))


def _walk(key: str, on_gap: str, continued: bool) -> Column:
    """Follow the start-to-end pointers from the left; a gap fails the word or yields one character."""
    word, ends = F.col(key), F.col("ends")
    no_pieces = F.array().cast("array<struct<piece:string,hit:boolean>>")

    def step(state: Column, i: Column) -> Column:
        end = F.coalesce(F.try_element_at(ends, i), i if on_gap == "char" else F.lit(-1))
        piece = F.substring(word, i, end - i + 1)
        if continued:
            piece = F.when(i == 1, piece).otherwise(F.concat(F.lit("##"), piece))
        item = F.struct(piece.alias("piece"), F.try_element_at(ends, i).isNotNull().alias("hit"))
        moved = F.struct((end + 1).alias("next"), F.concat(state["pieces"], F.array(item)).alias("pieces"))
        failed = F.struct(F.lit(-1).alias("next"), no_pieces.alias("pieces"))
        return F.when(i != state["next"], state).when(end < 0, failed).otherwise(moved)

    start = F.struct(F.lit(1).alias("next"), no_pieces.alias("pieces"))
    return F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step, lambda s: s["pieces"])


def encode_words(words: DataFrame, vocab: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``(word, tokens)`` for distinct words; a word that cannot be covered, or is too long, becomes ``[UNK]``.

    A vocabulary of a measured size goes to the tasks; with a larger one, substrings are joined with it.
    """
    distinct = spread(words.select("word").where(F.col("word") != "").distinct(), "word")
    if (held := matching.sent(vocab)) is not None:
        return matching.encode_lists(distinct.withColumn("words", F.array(_word(F.col("word"), False))), "word", held, max_chars)
    short = distinct if max_chars is None else distinct.where(F.length("word") <= max_chars)
    found = distinct.join(_longest_matches(short, "word", vocab, continued=True), "word", "left")
    walked = found.withColumn("pieces", F.when(F.col("ends").isNotNull(), _walk("word", "fail", continued=True)))
    tokens = F.transform("pieces", lambda p: p["piece"])
    unknown = F.col("pieces").isNull() | (F.size("pieces") == 0)
    return walked.select("word", F.when(unknown, F.array(F.lit(UNK))).otherwise(tokens).alias("tokens"))


def _word(word: Column, hit: bool) -> Column:
    return F.struct(word.alias("word"), F.lit(hit).alias("hit"))


def _pre_tokens(text: Column, hit: Column | None = None) -> Column:
    """``array<struct<word, hit>>``: the pre-tokens of a text, or the text itself as a hit."""
    words = F.transform(T.pretokenize(text, single_marks=True), lambda w: _word(w, False))
    return words if hit is None else F.when(hit, F.array(_word(text, True))).otherwise(words)


def _split_added(chunks: DataFrame, added: DataFrame) -> DataFrame:
    """``(chunk, pos, piece, hit)``: added tokens cut out of each chunk, leftmost and longest first."""
    found = chunks.join(_longest_matches(chunks, "chunk", added, continued=False), "chunk", "left")
    walked = found.select(
        "chunk", F.when(F.col("ends").isNotNull(), _walk("chunk", "char", continued=False)).alias("pieces")
    )
    # Neighbouring single characters that matched nothing are glued back to one piece.
    glued = F.aggregate(
        F.col("pieces"),
        F.array().cast("array<struct<piece:string,hit:boolean>>"),
        lambda acc, p: F.when(
            (F.size(acc) > 0) & ~p["hit"] & ~F.coalesce(F.get(acc, F.size(acc) - 1)["hit"], F.lit(True)),
            F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.concat(F.get(acc, F.size(acc) - 1)["piece"], p["piece"]).alias("piece"), p["hit"].alias("hit")
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(p))),
    )
    whole = F.array(F.struct(F.col("chunk").alias("piece"), F.lit(False).alias("hit")))
    return walked.select("chunk", F.posexplode(F.when(F.col("pieces").isNull(), whole).otherwise(glued)).alias("pos", "p")).select(
        "chunk", "pos", "p.piece", "p.hit"
    )


def encode_chunks(chunks: DataFrame, vocab: DataFrame, added: DataFrame | None = None, max_chars: int | None = None) -> DataFrame:
    """``(chunk, tokens)`` of distinct white-space chunks; added tokens match first, also inside words."""
    distinct = spread(chunks.select("chunk").where(F.col("chunk") != "").distinct(), "chunk")
    held = matching.sent(vocab)
    held_added = matching.sent(added) if added is not None and held is not None else None
    if held is not None and (added is None or held_added is not None):
        if added is None:
            listed = distinct.select("chunk", _pre_tokens(F.col("chunk")).alias("words"))
        else:
            pieces = matching.cut(distinct, "chunk", held_added, glued=True)
            listed = _words_of_pieces(pieces, "chunk")
        return matching.encode_lists(listed, "chunk", held, max_chars).where(F.size("tokens") > 0)
    if added is None:
        pieces = distinct.select("chunk", F.lit(0).alias("pos"), F.col("chunk").alias("piece"), F.lit(False).alias("hit"))
    else:
        pieces = _split_added(distinct, added)
    words = pieces.select(
        "chunk",
        "pos",
        F.posexplode_outer(F.when(F.col("hit"), F.array("piece")).otherwise(T.pretokenize(F.col("piece"), single_marks=True))).alias(
            "word_pos", "word"
        ),
        "hit",
    ).where(F.col("word").isNotNull())
    encoded = encode_words(words.where(~F.col("hit")), vocab, max_chars)
    tokens = F.when(F.col("hit"), F.array("word")).otherwise(F.col("tokens"))
    joined = words.join(encoded, "word", "left").select("chunk", "pos", "word_pos", tokens.alias("tokens"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "word_pos", "tokens")))
    return joined.groupBy("chunk").agg(F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens"))


def chunk_uses(docs: DataFrame, text: Column, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, pos, chunk)`` of the lowered text."""
    chunks = T.split_blank(F.lower(text), any_whitespace=True)
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode_outer(chunks).alias("pos", "chunk")).where(
        F.col("chunk").isNotNull()
    )


def encode_docs(uses: DataFrame, encoded: DataFrame) -> DataFrame:
    """``(doc_id, tokens)``: the encodings of distinct chunks put back in place."""
    placed = salted_join(uses, encoded, ["chunk"], "doc_id")
    ordered = F.array_sort(F.collect_list(F.struct("pos", "tokens")))
    return placed.groupBy("doc_id").agg(F.flatten(F.transform(ordered, lambda p: p["tokens"])).alias("tokens"))


def encode_texts(docs: DataFrame, text: Column, vocab: DataFrame, id_col: str = "doc_id", max_chars: int | None = None) -> DataFrame:
    """``(doc_id, tokens)`` of the lowered texts that have words, as ``encode_docs`` of their chunks.

    With a vocabulary of a measured size a text is encoded where it lies. Texts that share an id make one row, chunk by
    chunk; only those are taken apart and put together again.
    """
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))

    def together(rows: DataFrame) -> DataFrame:
        uses = chunk_uses(rows, F.col("text"))
        return encode_docs(uses, encode_chunks(uses, vocab, max_chars=max_chars))

    if (held := matching.sent(vocab)) is None:
        return together(keyed)

    def alone(rows: DataFrame) -> DataFrame:
        listed = rows.select("doc_id", _pre_tokens(F.lower("text")).alias("words"))
        return matching.encode_lists(listed, "doc_id", held, max_chars).where(F.size("tokens") > 0)

    repeated = keyed.groupBy(F.col("doc_id").alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again")
    if repeated.isEmpty():
        return alone(keyed)
    met = F.col("doc_id").eqNullSafe(F.col("again"))
    shared = small_side(repeated)
    return alone(keyed.join(shared, met, "left_anti")).unionByName(together(keyed.join(shared, met, "left_semi")))


def text_lengths(
    docs: DataFrame, text: Column, vocab: DataFrame, added: DataFrame | None = None, id_col: str = "doc_id", max_chars: int | None = None
) -> DataFrame:
    """``(doc_id, n_tokens)``: the tokens of each id's lowered texts; added tokens match first, also inside words.

    With vocabularies of a measured size the tokens are counted where the texts lie, else by distinct chunks.
    """
    held = matching.sent(vocab)
    held_added = matching.sent(added) if added is not None and held is not None else None
    if held is None or (added is not None and held_added is None):
        counts = chunk_counts(docs, text, id_col)
        sizes = encode_chunks(counts, vocab, added, max_chars).select("chunk", F.size("tokens").cast("long").alias("n_tokens"))
        return token_lengths(counts, sizes, "n_tokens")
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.lower(text).alias("text"))
    if added is None:
        listed = keyed.select("doc_id", _pre_tokens(F.col("text")).alias("words"))
    else:
        chunks = keyed.select("doc_id", T.split_blank(F.col("text"), any_whitespace=True).alias("chunks"))
        listed = _words_of_pieces(matching.cut_lists(chunks, "doc_id", held_added, glued=True), "doc_id")
    counted = matching.count_lists(listed, "doc_id", held, max_chars).where("n > 0")
    return counted.groupBy("doc_id").agg(F.sum("n").alias("n_tokens"))


def _words_of_pieces(pieces: DataFrame, key: str) -> DataFrame:
    return pieces.select(key, F.flatten(F.transform("pieces", lambda p: _pre_tokens(p["piece"], p["hit"]))).alias("words"))


def chunk_counts(docs: DataFrame, text: Column, id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, chunk, n)`` of the lowered text, counted inside the row."""
    ordered = docs.select(F.col(id_col).alias("doc_id"), F.sort_array(T.split_blank(F.lower(text), any_whitespace=True)).alias("ordered"))
    counted = ordered.select("doc_id", T.count_runs(F.col("ordered")).alias("runs"))
    return counted.select("doc_id", F.inline_outer("runs").alias("chunk", "n")).where(F.col("chunk").isNotNull())


def token_lengths(counts: DataFrame, sizes: DataFrame, *names: str) -> DataFrame:
    """``(doc_id, *names)``: sums of the sizes ``names`` of each document's chunks.

    ``counts`` is ``(doc_id, chunk, n)`` and ``sizes`` has a row per distinct chunk. Sizes of a measured amount go to
    the counts; else both meet by chunk, frequent chunks spread. No token list is built.
    """
    met = salted_join(counts, sizes, ["chunk"], "doc_id")
    return met.groupBy("doc_id").agg(*[F.sum(F.col("n") * F.col(name)).alias(name) for name in names])


def encode_ids(doc_tokens: DataFrame, vocab: DataFrame, cls: str = "[CLS]", sep: str = "[SEP]") -> DataFrame:
    """``(doc_id, ids)`` wrapped in the special tokens; unknown tokens get the id of ``[UNK]``.

    ``doc_tokens`` has an id once. A vocabulary of a measured size goes to the rows.
    """
    if (held := matching.sent_ids(vocab)) is not None:
        return matching.id_lists(doc_tokens, "doc_id", held, cls, sep)
    wrapped = F.concat(F.array(F.lit(cls)), F.col("tokens"), F.array(F.lit(sep)))
    rows = doc_tokens.select("doc_id", F.posexplode(wrapped).alias("pos", "token"))
    ids = small_side(vocab.groupBy("token").agg(F.min("token_id").alias("token_id")))
    unknown = vocab.where(F.col("token") == UNK).agg(F.min("token_id")).scalar()
    joined = rows.join(ids, "token", "left").withColumn("token_id", F.coalesce("token_id", unknown))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token_id")))
    return joined.groupBy("doc_id").agg(F.transform(ordered, lambda p: p["token_id"]).alias("ids"))


def decode_ids(doc_ids: DataFrame, vocab: DataFrame, skip: list[str]) -> DataFrame:
    """``(doc_id, text)``: tokens joined by spaces, continuation pieces attached, special tokens left out.

    ``doc_ids`` has an id once. A vocabulary of a measured size goes to the rows.
    """
    if (held := matching.sent_ids(vocab)) is not None:
        return matching.text_lists(doc_ids, "doc_id", held, skip)
    rows = doc_ids.select("doc_id", F.posexplode("ids").alias("pos", "token_id"))
    joined = rows.join(small_side(vocab.select("token", "token_id")), "token_id").where(~F.col("token").isin(skip))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "token")))
    text = F.array_join(F.transform(ordered, lambda p: p["token"]), " ")
    return joined.groupBy("doc_id").agg(F.replace(text, F.lit(" ##"), F.lit("")).alias("text"))


def compare_tokenizers(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per text: token counts under two vocabularies, difference, percent and verdict."""
    joined = before.select("doc_id", F.col("n_tokens").alias("base_tokens")).join(
        after.select("doc_id", F.col("n_tokens").alias("extended_tokens")), "doc_id"
    )
    return compare_lengths(joined)


def compare_lengths(joined: DataFrame) -> DataFrame:
    """``compare_tokenizers`` of ``(..., base_tokens, extended_tokens)``."""
    saved = F.col("base_tokens") - F.col("extended_tokens")
    percent = F.when(F.col("base_tokens") > 0, saved / F.col("base_tokens") * 100).otherwise(0.0)
    verdict = F.when(saved > 0, "improved").when(saved == 0, "same").otherwise("worse")
    return joined.select("*", saved.alias("saved"), percent.alias("saved_percent"), verdict.alias("verdict"))


def token_length_stats(compared: DataFrame) -> DataFrame:
    """Corpus summary of ``compare_tokenizers``."""
    improved = F.col("saved") > 0
    total = F.count("*")
    stats = compared.agg(
        total.alias("texts"),
        F.avg("base_tokens").alias("base_mean"),
        F.avg("extended_tokens").alias("extended_mean"),
        F.avg("saved").alias("mean_saved"),
        F.count_if(improved).alias("improved"),
        F.count_if(F.col("saved") == 0).alias("same"),
        F.count_if(F.col("saved") < 0).alias("worse"),
        F.coalesce(F.avg(F.when(improved, F.col("saved"))), F.lit(0.0)).alias("mean_gain_improved"),
        F.coalesce(F.max(F.when(improved, F.col("saved"))), F.lit(0)).alias("max_gain"),
    )
    rate = F.when(F.col("base_mean") > 0, F.col("mean_saved") / F.col("base_mean") * 100).otherwise(0.0)
    return stats.select("*", rate.alias("saved_percent"), (F.col("improved") / F.col("texts") * 100).alias("improved_percent"))


def term_gains(compared: DataFrame, floor: float = 25.0) -> DataFrame:
    """Terms whose token count fell by at least ``floor`` percent, largest gain first."""
    kept = compared.where((F.col("saved") > 0) & (F.col("saved_percent") >= floor))
    return kept.select("term", "base_tokens", "extended_tokens", "saved_percent").orderBy(F.desc("saved_percent"), "term")


def fertility(docs: DataFrame, lengths: DataFrame, text: Column, id_col: str = "doc_id") -> DataFrame:
    """White-space words, tokens and tokens per word of each text."""
    words = docs.select(F.col(id_col).alias("doc_id"), F.size(T.split_blank(text, any_whitespace=True)).alias("n_words"))
    return words.join(lengths, "doc_id").select(
        "doc_id", "n_words", "n_tokens", (F.col("n_tokens") / F.col("n_words")).alias("tokens_per_word")
    )


def segment(texts: DataFrame, id_col: str, text: Column, lexicon: DataFrame, search: bool = False) -> DataFrame:
    """``(id, tokens)``: unspaced text cut greedily into lexicon words; ``search`` adds 2- and 3-character words.

    ``lexicon`` is ``(token)``. Distinct white-space blocks are segmented once.
    """
    blocks = texts.select(
        F.col(id_col), F.posexplode_outer(T.split_blank(T.clean_unspaced(text), any_whitespace=True)).alias("pos", "block")
    ).where(F.col("block").isNotNull())
    distinct = spread(blocks.select("block").distinct(), "block")
    if (held := matching.sent(lexicon)) is not None:
        found, cut = matching.cut(distinct, "block", held, glued=False), F.col("pieces")
    else:
        found = distinct.join(_longest_matches(distinct, "block", lexicon, continued=False), "block", "left")
        single = F.transform(T.characters(F.col("block")), lambda c: F.struct(c.alias("piece"), F.lit(False).alias("hit")))
        cut = F.when(F.col("ends").isNull(), single).otherwise(_walk("block", "char", continued=False))
    rows = found.select("block", F.posexplode(cut).alias("n", "p")).select("block", "n", F.col("p.piece").alias("word"))
    if search:
        rows = _add_search_pieces(rows, lexicon)
    else:
        rows = rows.select("block", "n", F.lit(0).alias("m"), "word")
    ordered = F.array_sort(F.collect_list(F.struct("n", "m", "word")))
    per_block = rows.groupBy("block").agg(F.transform(ordered, lambda p: p["word"]).alias("tokens"))
    placed = blocks.join(per_block, "block")
    in_order = F.array_sort(F.collect_list(F.struct("pos", "tokens")))
    return placed.groupBy(id_col).agg(F.flatten(F.transform(in_order, lambda p: p["tokens"])).alias("tokens"))


def _add_search_pieces(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Before each word, its 2-character then 3-character lexicon pieces from left to right."""
    pieces = F.concat(
        F.when(F.length("word") > 2, T.char_ngrams(F.col("word"), 2)).otherwise(T.no_tokens()),
        F.when(F.length("word") > 3, T.char_ngrams(F.col("word"), 3)).otherwise(T.no_tokens()),
    )
    grams = rows.select("word").distinct().select("word", F.posexplode_outer(pieces).alias("m", "gram")).where("gram is not null")
    known = grams.join(small_side(lexicon.select(F.col("token").alias("gram")).distinct()), "gram", "left_semi")
    inner = rows.join(known, "word").select("block", "n", "m", F.col("gram").alias("word"))
    whole = rows.select("block", "n", F.lit(2**30).alias("m"), "word")
    return inner.unionByName(whole)
