"""Inverted index, word lookup and BM25 ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from textloom.functions import text as T
from textloom.operators import ranking
from textloom.operators.encoding import segment
from textloom.operators.ranking import TIE_DIGITS
from textloom.session import cut_lineage, fits_broadcast, salted_join, small_side, spread

TOKENIZERS: dict[str, Callable[[Column], Column]] = {"za": T.tokenize_ws, "eng": T.tokenize_ws, "kgv": T.tokenize_ws}
"""Tokenizers that are plain column expressions; unspaced text goes through ``encoding.segment``."""


def counted(docs: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """``(pair_id, dl, runs)``: every document with its distinct tokens and their counts.

    Counting happens inside each row, so building an index moves no text between executors.
    """
    ordered = docs.select(F.col(id_col).alias("pair_id"), F.sort_array(tokens).alias("ordered"))
    return ordered.select("pair_id", F.size("ordered").alias("dl"), T.count_runs(F.col("ordered")).alias("runs"))


def postings(docs: DataFrame, id_col: str, tokens: Column) -> DataFrame:
    """``(pair_id, dl, token, tf)``, one row per document and distinct token."""
    return _inlined(counted(docs, id_col, tokens))


def _inlined(counted: DataFrame) -> DataFrame:
    # The outer form keeps the optimizer from re-evaluating the array expressions in an inferred size filter.
    return counted.select("pair_id", "dl", F.inline_outer("runs")).where(F.col("token").isNotNull())


def parallel_counted(pairs: DataFrame, src_lang: str, tgt_lang: str, lexicon: DataFrame | None = None) -> DataFrame:
    """``(lang, pair_id, dl, runs)`` of both sides of a parallel corpus.

    A language without spaces between words is cut by ``lexicon``, a table ``(token)``, with its search pieces.
    """

    def side(lang: str, column: str) -> DataFrame:
        if lang in TOKENIZERS:
            found = counted(pairs, "pair_id", TOKENIZERS[lang](F.col(column)))
        elif lexicon is None:
            raise ValueError(f"language {lang!r} needs a lexicon")
        else:
            found = counted(segment(pairs, "pair_id", F.col(column), lexicon, search=True), "pair_id", F.col("tokens"))
        return found.select(F.lit(lang).alias("lang"), "*")

    return side(src_lang, "src").unionByName(side(tgt_lang, "tgt"))


def parallel_postings(pairs: DataFrame, src_lang: str, tgt_lang: str, lexicon: DataFrame | None = None) -> DataFrame:
    """Postings of both sides of a parallel corpus with a ``lang`` column."""
    both = parallel_counted(pairs, src_lang, tgt_lang, lexicon)
    return both.select("lang", "pair_id", "dl", F.inline_outer("runs")).where(F.col("token").isNotNull())


def lookup_word(words: DataFrame, index: DataFrame, pairs: DataFrame, repeat: bool = False) -> DataFrame:
    """Pairs holding each word, with its multiplicity ``tf`` (or one row per occurrence)."""
    asked = words.select("word", T.strip(F.lower("word")).alias("token")).distinct()
    hits = salted_join(index, asked, ["token"], "pair_id").select("word", "pair_id", "tf")
    if repeat:
        hits = hits.select("word", "pair_id", F.explode(F.array_repeat(F.lit(1), F.col("tf"))).alias("tf"))
    return hits.join(pairs, "pair_id")


ROWS_TOGETHER = 20_000
"""Source postings of one word that may meet at one place; the asked pairs of a more frequent word are repeated."""

LIST_BITS = 20
"""Asked target words of a source word are listed together by number, at most ``2**LIST_BITS`` of them in a row."""


def lookup_word_pair(word_pairs: DataFrame, index: DataFrame, src_lang: str, tgt_lang: str) -> DataFrame:
    """Pairs whose source holds ``src_word`` and target holds ``tgt_word``; ``tf`` is the source multiplicity.

    Words are numbered. A source posting goes to the asked pairs of its word with the numbers of all words of the
    target, so that what is moved grows with the asked pairs and the index, not with the asked pairs of each posting.
    The asked pairs of a source word come as a list of target numbers, since a row for each of them, handed to Python,
    costs more than all postings.
    A pair that is in the index more than once comes once for each source, or if the source word is in more pairs than
    the target word, once for each source and target.
    """
    asked = word_pairs.select("src_word", "tgt_word")
    source = index.where((F.col("lang") == src_lang) & F.col("pair_id").isNotNull()).select("pair_id", "token", "tf")
    target = index.where((F.col("lang") == tgt_lang) & F.col("pair_id").isNotNull()).select("pair_id", "token")
    sides = F.explode(F.array(F.struct(F.lit(True).alias("src"), F.col("src_word").alias("word")), F.struct(F.lit(False).alias("src"), F.col("tgt_word").alias("word"))))
    words = cut_lineage(asked.select(sides.alias("side")).select("side.*").distinct().withColumn("token", T.strip(F.lower("word"))))
    src, tgt = (_numbered(words.where(chosen), index.where(F.col("lang") == lang)) for chosen, lang in ((F.col("src"), src_lang), (~F.col("src"), tgt_lang)))
    src = src.withColumn("places", F.ceil(F.col("df") / ROWS_TOGETHER).cast("int"))
    # Each a row per asked word of the index; broadcast where measured to fit, and joined by word otherwise.
    from_src, from_tgt = small_side(src), small_side(tgt)
    numbers = asked.join(from_src.select(F.col("word").alias("src_word"), F.col("number").alias("s")), "src_word")
    numbers = numbers.join(from_tgt.select(F.col("word").alias("tgt_word"), F.col("number").alias("t")), "tgt_word")
    # Both numbers in one, which is quicker to tell apart.
    numbers = numbers.select(F.shiftleft(F.col("s").cast("long"), 32).bitwiseOR(F.col("t")).alias("st")).distinct()
    numbers = numbers.select(F.shiftright("st", 32).cast("int").alias("s"), F.col("st").bitwiseAND(2**32 - 1).cast("int").alias("t"))
    listed = numbers.groupBy("s", F.shiftright("t", LIST_BITS).alias("part")).agg(F.sort_array(F.collect_list("t")).alias("ts"))
    listed = listed.join(from_src.select(F.col("number").alias("s"), "places"), "s")
    place = F.explode(F.sequence(F.lit(0), F.col("places") - 1))
    kind, tf = source.schema["pair_id"].dataType.simpleString(), source.schema["tf"].dataType.simpleString()
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("pair_id", kind), ("tf", tf))]
    wanted = listed.select("s", place.alias("place"), "part", *nothing, "ts")
    held = target.join(from_tgt.select("token", "number"), "token").groupBy("pair_id").agg(F.sort_array(F.collect_set("number")).alias("ts"))
    offered = source.join(from_src.select("token", F.col("number").alias("s"), "places"), "token").join(held, "pair_id")
    offered = offered.select("s", F.pmod(F.xxhash64("pair_id"), "places").cast("int").alias("place"), F.lit(None).cast("int").alias("part"), "pair_id", "tf", "ts")
    together = spread(wanted.unionByName(offered), "s", "place").sortWithinPartitions("s", "place", F.col("part").asc_nulls_last())
    found = together.mapInArrow(_both_held, f"s int, t int, pair_id {kind}, tf {tf}")
    found = found.join(from_src.select(F.col("number").alias("s"), F.col("word").alias("src_word"), F.col("df").alias("s_df")), "s")
    found = found.join(from_tgt.select(F.col("number").alias("t"), F.col("word").alias("tgt_word"), F.col("df").alias("t_df"), F.col("token").alias("t_token")), "t")
    columns = ["src_word", "tgt_word", "pair_id", "tf"]
    again = cut_lineage(target.groupBy("pair_id", F.col("token").alias("t_token")).agg(F.count("*").alias("times")).where("times > 1"))
    if again.isEmpty():
        return found.select(*columns)
    times = F.when(F.col("s_df") > F.col("t_df"), F.col("times")).otherwise(1).cast("int")
    repeated = found.join(small_side(again), ["pair_id", "t_token"], "left").withColumn("times", F.coalesce(times, F.lit(1)))
    return repeated.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("_")).drop("_")


def _numbered(words: DataFrame, index: DataFrame) -> DataFrame:
    """``(word, token, df, number)``: the words whose token is in the index, with whole numbers from 0, few of them left out."""
    counted = index.groupBy("token").agg(F.count("*").alias("df"))
    known = cut_lineage(words.select("word", "token").join(counted, "token").withColumn("n", F.monotonically_increasing_id()))
    tasks = known.agg(F.coalesce(F.max(F.shiftright("n", 33)), F.lit(0))).first()[0] + 1
    number = F.col("n").bitwiseAND(2**33 - 1) * tasks + F.shiftright("n", 33)
    return known.select("word", "token", "df", number.cast("int").alias("number"))


def _both_held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The asked pairs that postings hold, ``(s, t, pair_id, tf)``, from rows sorted by word and place, asked lists first."""
    last, carried = None, np.empty(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        s, place = (batch.column(i).to_numpy() for i in (0, 1))
        group = np.concatenate([[0], np.cumsum((np.diff(s) != 0) | (np.diff(place) != 0))]).astype(np.int64)
        if (s[0], place[0]) != last:
            carried = carried[:0]
        asks = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        wanted = batch.column(5).filter(pa.array(asks))
        asked = np.concatenate([carried, np.repeat(group[asks] << 32, wanted.value_lengths().to_numpy()) | wanted.flatten().to_numpy()])
        rows = np.flatnonzero(~asks)
        # Asked lists come by word, place and part and are sorted, so their keys ascend.
        for part in np.array_split(rows, max(len(rows) // 4096, 1)) if len(rows) and len(asked) else ():
            lists = batch.column(5).take(pa.array(part))
            row = np.repeat(part, lists.value_lengths().to_numpy())
            t = lists.flatten().to_numpy().astype(np.int64)
            keys = group[row] << 32 | t
            hits = np.flatnonzero(asked[np.minimum(np.searchsorted(asked, keys), len(asked) - 1)] == keys)
            row = pa.array(row[hits])
            columns = [batch.column(0).take(row), pa.array(t[hits].astype(np.int32)), batch.column(3).take(row), batch.column(4).take(row)]
            yield pa.record_batch(columns, names=["s", "t", "pair_id", "tf"])
        last = (s[-1], place[-1])
        carried = asked[asked >> 32 == group[-1]] & 0xFFFFFFFF


def bm25_stats(index: DataFrame, docs: DataFrame, epsilon: float = 0.25) -> DataFrame:
    """``(token, df, idf, n_docs, avg_len)``; negative idf becomes ``epsilon`` times the mean idf.

    ``index`` has postings, or the totals of every token. ``docs`` has one row per ranked document, empty ones
    included; only its row count is read.
    """
    terms = index if "total" in index.columns else index.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    n_docs = docs.agg(F.count("*").cast("double")).scalar()
    terms = terms.withColumn("n_docs", n_docs)
    idf = F.log(F.col("n_docs") - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    terms = terms.withColumn("raw_idf", idf)
    # Read twice, for the corpus means and for the terms themselves; one row per distinct term.
    terms = terms.persist()
    means = F.struct((F.sum("total") / F.first("n_docs")).alias("avg_len"), F.avg("raw_idf").alias("mean_idf"))
    corpus = terms.agg(means.alias("means")).scalar()
    floor = F.lit(epsilon) * corpus["mean_idf"]
    return terms.select(
        "token",
        "df",
        F.when(F.col("raw_idf") < 0, floor).otherwise(F.col("raw_idf")).alias("idf"),
        "n_docs",
        corpus["avg_len"].alias("avg_len"),
    )


def query_terms(queries: DataFrame, tokens: Column) -> DataFrame:
    """``(query_id, token, qtf)`` with repeated query tokens counted."""
    return postings(queries, "query_id", tokens).select(F.col("pair_id").alias("query_id"), "token", F.col("tf").alias("qtf"))


def bm25_scores(
    terms: DataFrame, index: DataFrame, stats: DataFrame, k1: float = 1.5, b: float = 0.75
) -> DataFrame:
    """``(query_id, pair_id, score)`` of every pair sharing a token with the query.

    Only postings of query tokens leave the scan; a hot token is spread over its documents.
    """
    weighted = stats.join(small_side(terms), "token").select("token", "query_id", "qtf", "idf", "avg_len")
    # Measured and then joined; as many rows as the queries have distinct tokens.
    weighted = weighted.persist()
    hits = salted_join(index, weighted, ["token"], "pair_id")
    length_norm = F.lit(k1) * (F.lit(1 - b) + F.lit(b) * F.col("dl") / F.col("avg_len"))
    part = F.col("qtf") * F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + length_norm)
    return hits.groupBy("query_id", "pair_id").agg(F.sum(part).alias("score"))


def top_k(scored: DataFrame, k: int, group: str = "query_id", order: list[Column] | None = None) -> DataFrame:
    """Best ``k`` rows per group with their ``rank``; plans as a group limit before and after the shuffle."""
    order = order or [F.round("score", TIE_DIGITS).desc(), F.col("pair_id").desc()]
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def bm25_topk(
    queries: DataFrame,
    docs: DataFrame,
    query_tokens: Column,
    doc_tokens: Column,
    k: int = 5,
    pad_zero: bool = False,
    index: DataFrame | None = None,
    forward: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> DataFrame:
    """``(query_id, pair_id, score, rank)``, rank 1 best; equal scores put the higher id first.

    ``forward`` and ``totals`` are the counted documents and token totals of a stored index, ``index`` its postings
    alone; without them the documents are counted on the way. Query terms of a measured size go to the documents,
    which are scored where they lie; more of them, or postings alone, meet by token and document in a shuffle.
    ``pad_zero`` fills up with the highest ids of score 0 when fewer than ``k`` documents match.
    """
    terms = query_terms(queries, query_tokens)
    if index is None:
        forward = counted(docs, "pair_id", doc_tokens) if forward is None else forward
        stats = bm25_stats(_inlined(forward) if totals is None else totals, docs)
        weighted = stats.join(small_side(terms), "token").select("query_id", "token", "qtf", "idf", "avg_len").persist()
        if forward.schema["pair_id"].dataType == LongType() and fits_broadcast(weighted):
            scored = ranking.local_topk(weighted.toArrow(), forward, k)
        else:
            scored = bm25_scores(terms, _inlined(forward), stats)
        weighted.unpersist()
    else:
        scored = bm25_scores(terms, index, bm25_stats(index, docs))
    best = top_k(scored, k)
    if not pad_zero:
        return best
    # A query short of k matches less than k documents, so k unmatched ones are among the 2k highest ids.
    last_ids = docs.select("pair_id").orderBy(F.desc("pair_id")).limit(2 * k)
    short = queries.select("query_id").join(best.groupBy("query_id").agg(F.count("*").alias("n")), "query_id", "left")
    short = short.where(F.coalesce("n", F.lit(0)) < k)
    fill = short.withColumn("pair_id", F.explode(last_ids.agg(F.collect_list("pair_id")).scalar()))
    fill = fill.join(best, ["query_id", "pair_id"], "left_anti")
    zero = fill.select("query_id", "pair_id", F.lit(0.0).alias("score"))
    return top_k(best.drop("rank").unionByName(zero), k)
