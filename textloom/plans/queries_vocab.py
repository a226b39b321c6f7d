"""Queries on vocabulary learning, subword encoding and tokenizer comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions import text as T
from textloom.operators import encoding, shaping, vector, vocabulary
from textloom.plans import inputs as I
from textloom.plans import sql as S
from textloom.plans.queries_text import bars
from textloom.plans.registry import query

_DOC_WORDS = S.word_counts("w", "documents", "doc_id")


def document_words(spark: SparkSession, sf: str) -> DataFrame:
    return I.bert_words(I.documents(spark, sf), "doc_id")


@query("word_freq", f"WITH {_DOC_WORDS} SELECT word, freq, CAST(first_seen.doc AS BIGINT) AS first_doc, CAST(first_seen.pos AS INTEGER) AS first_pos FROM w")
def word_freq(spark: SparkSession, sf: str) -> DataFrame:
    first = [F.col("first_seen.doc").alias("first_doc"), F.col("first_seen.pos").alias("first_pos")]
    return document_words(spark, sf).select("word", "freq", *first)


@query("alphabet", f"WITH {_DOC_WORDS} SELECT DISTINCT unnest({S.UNITS}) AS unit FROM w")
def alphabet(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.alphabet(document_words(spark, sf))


@query(
    "alphabet_top",
    f"""WITH {_DOC_WORDS} SELECT char, CAST(sum(freq) AS BIGINT) AS freq FROM (
      SELECT unnest(string_split(word, '')) AS char, freq FROM w) GROUP BY char ORDER BY freq DESC, char LIMIT 50""",
)
def alphabet_top(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.alphabet_top(document_words(spark, sf), 50)


@query(
    "pair_stats",
    f"""WITH {_DOC_WORDS}, u AS (SELECT word, freq, {S.UNITS} AS us FROM w),
    one AS (SELECT x, CAST(sum(freq) AS BIGINT) AS n FROM (SELECT unnest(us) AS x, freq FROM u) GROUP BY x),
    two AS (SELECT lhs, rhs, CAST(sum(freq) AS BIGINT) AS freq FROM (
      SELECT us[i] AS lhs, us[i + 1] AS rhs, freq FROM (SELECT us, freq, unnest(range(1, len(us))) AS i FROM u)) GROUP BY ALL)
    SELECT lhs, rhs, freq, a.n AS lhs_freq, b.n AS rhs_freq, round(CAST(freq AS DOUBLE) / (CAST(a.n AS DOUBLE) * b.n), 12) AS score
    FROM two JOIN one a ON a.x = lhs JOIN one b ON b.x = rhs""",
)
def pair_stats(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.pair_stats(document_words(spark, sf)).withColumn("score", F.round("score", 12))


@query("train_wordpiece")
def train_wordpiece(spark: SparkSession, sf: str) -> DataFrame:
    """Likelihood training on all documents: alphabet plus 500 merges."""
    words = document_words(spark, sf).persist()
    size = len(C.SPECIALS_LIKELIHOOD) + vocabulary.alphabet(words).count() + 500
    return vocabulary.train_wordpiece(words, size)


@query("train_wordpiece_freq")
def train_wordpiece_freq(spark: SparkSession, sf: str) -> DataFrame:
    """Frequency training on all documents, 30,000 entries."""
    text = T.pretokenize(T.normalize_text(F.col("text")))
    words = vocabulary.word_freq(I.documents(spark, sf), text)
    return vocabulary.train_wordpiece_freq(words.persist(), 30000)


_PASSAGE_WORDS = f"""{S.BASE_VOCAB}, {_DOC_WORDS}, ask AS (SELECT word FROM w)"""


@query("wordpiece_encode", f"WITH RECURSIVE {_PASSAGE_WORDS}, {S.walk('ask', 'base')} SELECT word, array_to_string(tokens, '|') AS tokens FROM enc")
def wordpiece_encode(spark: SparkSession, sf: str) -> DataFrame:
    """All document words under the vocabulary of the passages."""
    encoded = encoding.encode_words(document_words(spark, sf), I.base_vocab(spark, sf))
    return encoded.select("word", bars("tokens").alias("tokens"))


def _uses(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.chunk_uses(I.documents(spark, sf), F.col("text"))


def _encoded_docs(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.encode_texts(I.documents(spark, sf), F.col("text"), I.base_vocab(spark, sf))


_ENCODED = f"""{_PASSAGE_WORDS}, {S.walk('ask', 'base')},
d AS (SELECT doc_id, {S.bert_tokens('lower(text)')} AS ws FROM documents),
placed AS (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM d)),
toks AS (SELECT doc_id, i, j, tokens[j] AS token FROM (SELECT doc_id, i, tokens, unnest(range(1, len(tokens) + 1)) AS j
  FROM placed JOIN enc USING (word))),
ided AS (SELECT doc_id, list(coalesce(token_id, 1) ORDER BY i, j) AS ids, list(token ORDER BY i, j) AS tokens
  FROM toks LEFT JOIN base USING (token) GROUP BY doc_id)"""


@query("encode_ids", f"WITH RECURSIVE {_ENCODED} SELECT doc_id, array_to_string(list_concat([2], ids, [3]), '|') AS ids FROM ided")
def encode_ids(spark: SparkSession, sf: str) -> DataFrame:
    ids = encoding.encode_ids(_encoded_docs(spark, sf), I.base_vocab(spark, sf))
    return ids.select("doc_id", bars(F.col("ids").cast("array<string>")).alias("ids"))


@query(
    "decode_ids",
    f"""WITH RECURSIVE {_ENCODED} SELECT doc_id,
      replace(array_to_string(list_filter(tokens, lambda t: t <> '[UNK]'), ' '), ' ##', '') AS text FROM ided
    WHERE len(list_filter(tokens, lambda t: t <> '[UNK]')) > 0""",
)
def decode_ids(spark: SparkSession, sf: str) -> DataFrame:
    vocab = I.base_vocab(spark, sf)
    return encoding.decode_ids(encoding.encode_ids(_encoded_docs(spark, sf), vocab), vocab, C.SPECIALS_LIKELIHOOD)


@query(
    "pad_truncate",
    f"""WITH RECURSIVE {_ENCODED}, cut AS (SELECT doc_id, list_slice(ids, 1, 126) AS ids FROM ided)
    SELECT doc_id, array_to_string(list_resize(list_concat([2], ids, [3]), 128, 0), '|') AS input_ids,
      repeat('1|', len(ids) + 1) || '1' || repeat('|0', 126 - len(ids)) AS attention_mask, CAST(128 AS INT) AS types FROM cut""",
)
def pad_truncate(spark: SparkSession, sf: str) -> DataFrame:
    ids = encoding.encode_ids(_encoded_docs(spark, sf), I.base_vocab(spark, sf))
    bare = ids.select("doc_id", F.slice("ids", F.lit(2), F.size("ids") - 2).cast("array<int>").alias("ids"))
    columns = shaping.pad_truncate(F.col("ids"), 128, 2, 3, 0)
    fixed = bare.select("doc_id", *[c.alias(n) for n, c in columns.items()])
    return fixed.select(
        "doc_id",
        bars(F.col("input_ids").cast("array<string>")).alias("input_ids"),
        bars(F.col("attention_mask").cast("array<string>")).alias("attention_mask"),
        F.size("token_type_ids").alias("types"),
    )


@query("fits_limit", f"WITH RECURSIVE {_ENCODED} SELECT doc_id, len(ids) + 2 <= 512 AS fits FROM ided")
def fits_limit(spark: SparkSession, sf: str) -> DataFrame:
    ids = encoding.encode_ids(_encoded_docs(spark, sf), I.base_vocab(spark, sf))
    return ids.select("doc_id", shaping.fits_limit(F.col("ids")).alias("fits"))


@query("is_domain_term", f"WITH {_DOC_WORDS.replace('w AS (', 'w0 AS (')}, w AS (SELECT word AS token FROM w0) SELECT token, {S.DOMAIN} AS domain FROM w")
def is_domain_term(spark: SparkSession, sf: str) -> DataFrame:
    return document_words(spark, sf).select(F.col("word").alias("token"), vocabulary.is_domain_term(F.col("word")).alias("domain"))


_CHOSEN = f"{S.BASE_VOCAB}, {S.TRAINED}, {S.selected(5000)}"


@query("select_new_tokens", f"WITH {_CHOSEN} SELECT token, CAST(tier AS INT) AS tier, pos FROM chosen")
def select_new_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary.select_new_tokens(I.trained_vocab(spark, sf), I.base_vocab(spark, sf), 5000)


@query("select_few_tokens", f"WITH {S.BASE_VOCAB}, {S.TRAINED}, {S.selected(5)} SELECT token, CAST(tier AS INT) AS tier, pos FROM chosen")
def select_few_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """A small quota, which domain terms fill alone where there are enough of them."""
    return vocabulary.select_new_tokens(I.trained_vocab(spark, sf), I.base_vocab(spark, sf), 5)


_EXTENDED = f"""{_CHOSEN}, ext AS (SELECT token, token_id, FALSE AS added FROM base
  UNION ALL SELECT token, (SELECT max(token_id) FROM base) + pos, TRUE FROM chosen)"""


@query("extend_vocab", f"WITH {_EXTENDED} SELECT token, token_id, added FROM ext")
def extend_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return I.extended_vocab(spark, sf)


@query("vocab_report", f"""WITH {_EXTENDED} SELECT (SELECT count(*) FROM base) AS base_size, count(*) AS extended_size,
  count(*) - (SELECT count(*) FROM base) AS added_tokens, (count(*) - (SELECT count(*) FROM base)) * 768 AS added_parameters,
  round((count(*) - (SELECT count(*) FROM base)) / (SELECT count(*) FROM base) * 100, 6) AS growth_percent FROM ext""")
def vocab_report(spark: SparkSession, sf: str) -> DataFrame:
    report = vocabulary.vocab_report(I.base_vocab(spark, sf), I.extended_vocab(spark, sf))
    return report.withColumn("growth_percent", F.round("growth_percent", 6))


# Added tokens are cut out of the white-space chunks first, leftmost and longest; the rest goes through the base vocabulary.
_CUT = f"""chunks AS (SELECT DISTINCT c FROM (SELECT unnest({S.split_any('lower(text)')}) AS c FROM documents)),
hits AS (SELECT c, s, max(e) AS e FROM (SELECT c, s, unnest(range(s, least(length(c), s + (SELECT max(length(token)) FROM chosen) - 1) + 1)) AS e
  FROM (SELECT c, unnest(range(1, length(c) + 1)) AS s FROM chunks)) JOIN chosen ON token = substring(c, s, e - s + 1) GROUP BY c, s),
jumps AS (SELECT c, s, coalesce(e, s) AS e, e IS NOT NULL AS hit FROM (SELECT c, unnest(range(1, length(c) + 1)) AS s FROM chunks)
  LEFT JOIN hits USING (c, s)),
visits AS (SELECT c, CAST(1 AS BIGINT) AS nxt, CAST(NULL AS BOOLEAN) AS hit, CAST(0 AS BIGINT) AS s FROM chunks UNION ALL
  SELECT v.c, j.e + 1, j.hit, j.s FROM visits v JOIN jumps j ON j.c = v.c AND j.s = v.nxt),
runs AS (SELECT c, s, nxt, hit, sum(CASE WHEN hit OR before THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY s) AS run FROM (
  SELECT c, s, nxt, hit, coalesce(lag(hit) OVER (PARTITION BY c ORDER BY s), TRUE) AS before FROM visits WHERE s > 0)),
parts AS (SELECT c, run, bool_or(hit) AS hit, substring(c, min(s), max(nxt) - min(s)) AS part FROM runs GROUP BY c, run),
subs AS (SELECT c, run, hit, list_value(part) AS ws FROM parts WHERE hit
  UNION ALL SELECT c, run, hit, {S.bert_tokens('part')} FROM parts WHERE NOT hit),
subwords AS (SELECT c, run, hit, i, ws[i] AS word FROM (SELECT c, run, hit, ws, unnest(range(1, len(ws) + 1)) AS i FROM subs)),
ask AS (SELECT DISTINCT word FROM subwords WHERE NOT hit)"""
_CHUNK_TOKENS = f"""{_CHOSEN}, {_CUT}, {S.walk('ask', 'base')},
chunk_tokens AS (SELECT c, flatten(list(CASE WHEN hit THEN [word] ELSE tokens END ORDER BY run, i)) AS tokens
  FROM subwords LEFT JOIN enc USING (word) GROUP BY c)"""


@query("encode_extended", f"WITH RECURSIVE {_CHUNK_TOKENS} SELECT c AS chunk, array_to_string(tokens, '|') AS tokens FROM chunk_tokens")
def encode_extended(spark: SparkSession, sf: str) -> DataFrame:
    added = I.extended_vocab(spark, sf).where("added")
    chunks = encoding.encode_chunks(_uses(spark, sf), I.base_vocab(spark, sf), added)
    return chunks.select("chunk", bars("tokens").alias("tokens"))


def _sizes(encoded: DataFrame, name: str) -> DataFrame:
    return encoded.select("chunk", F.size("tokens").cast("long").alias(name))


def _both_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """``(chunk, base_tokens, extended_tokens)`` of every distinct chunk."""
    chunks = _uses(spark, sf).select("chunk").distinct().persist()
    base, added = I.base_vocab(spark, sf), I.extended_vocab(spark, sf).where("added")
    before = _sizes(encoding.encode_chunks(chunks, base), "base_tokens")
    return before.join(_sizes(encoding.encode_chunks(chunks, base, added), "extended_tokens"), "chunk")


def compared(spark: SparkSession, sf: str) -> DataFrame:
    """Every document under the base and the extended vocabulary."""
    docs, text, base = I.documents(spark, sf), F.col("text"), I.base_vocab(spark, sf)
    none = F.lit(0).cast("long")
    before = encoding.text_lengths(docs, text, base).select("doc_id", F.col("n_tokens").alias("base_tokens"), none.alias("extended_tokens"))
    added = I.extended_vocab(spark, sf).where("added")
    after = encoding.text_lengths(docs, text, base, added).select("doc_id", none.alias("base_tokens"), F.col("n_tokens").alias("extended_tokens"))
    sums = [F.sum(name).alias(name) for name in ("base_tokens", "extended_tokens")]
    return encoding.compare_lengths(before.unionByName(after).groupBy("doc_id").agg(*sums))


_COMPARED = f"""{_CHUNK_TOKENS},
words0 AS (SELECT DISTINCT word FROM (SELECT unnest({S.bert_tokens('lower(text)')}) AS word FROM documents)),
{S.walk('words0', 'base', 'b_')},
base_len AS (SELECT doc_id, sum(len(tokens)) AS n FROM (SELECT doc_id, unnest({S.bert_tokens('lower(text)')}) AS word FROM documents)
  JOIN b_enc USING (word) GROUP BY doc_id),
ext_len AS (SELECT doc_id, sum(len(tokens)) AS n FROM (SELECT doc_id, unnest({S.split_any('lower(text)')}) AS c FROM documents)
  JOIN chunk_tokens USING (c) GROUP BY doc_id),
cmp AS (SELECT doc_id, CAST(b.n AS BIGINT) AS base_tokens, CAST(e.n AS BIGINT) AS extended_tokens, CAST(b.n - e.n AS BIGINT) AS saved,
  CAST(b.n - e.n AS DOUBLE) / b.n * 100 AS saved_percent FROM base_len b JOIN ext_len e USING (doc_id))"""


@query(
    "compare_tokenizers",
    f"""WITH RECURSIVE {_COMPARED} SELECT doc_id, base_tokens, extended_tokens, saved, round(saved_percent, 6) AS saved_percent,
      CASE WHEN saved > 0 THEN 'improved' WHEN saved = 0 THEN 'same' ELSE 'worse' END AS verdict FROM cmp""",
)
def compare_tokenizers(spark: SparkSession, sf: str) -> DataFrame:
    return compared(spark, sf).withColumn("saved_percent", F.round("saved_percent", 6))


@query(
    "token_length_stats",
    f"""WITH RECURSIVE {_COMPARED} SELECT count(*) AS texts, round(avg(base_tokens), 6) AS base_mean,
      round(avg(extended_tokens), 6) AS extended_mean, round(avg(saved), 6) AS mean_saved,
      count(*) FILTER (saved > 0) AS improved, count(*) FILTER (saved = 0) AS same, count(*) FILTER (saved < 0) AS worse,
      round(coalesce(avg(saved) FILTER (saved > 0), 0), 6) AS mean_gain_improved,
      coalesce(max(saved) FILTER (saved > 0), 0) AS max_gain,
      round(avg(saved) / avg(base_tokens) * 100, 6) AS saved_percent,
      round(count(*) FILTER (saved > 0) / count(*) * 100, 6) AS improved_percent FROM cmp""",
)
def token_length_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = encoding.token_length_stats(compared(spark, sf))
    rounded = ["base_mean", "extended_mean", "mean_saved", "mean_gain_improved", "saved_percent", "improved_percent"]
    return stats.select(*[F.round(c, 6).alias(c) if c in rounded else c for c in stats.columns])


@query(
    "term_gains",
    f"""WITH RECURSIVE {_CHUNK_TOKENS}, terms AS (SELECT c AS term, {S.bert_tokens('c')} AS ws FROM chunks),
    term_words AS (SELECT term, unnest(ws) AS word FROM terms), words0 AS (SELECT DISTINCT word FROM term_words),
    {S.walk('words0', 'base', 'b_')},
    before AS (SELECT term, CAST(sum(len(tokens)) AS BIGINT) AS base_tokens FROM term_words JOIN b_enc USING (word) GROUP BY term),
    pair AS (SELECT term, base_tokens, CAST(len(tokens) AS BIGINT) AS extended_tokens FROM before JOIN chunk_tokens ON c = term)
    SELECT term, base_tokens, extended_tokens, round((base_tokens - extended_tokens) / base_tokens * 100, 6) AS saved_percent FROM pair
    WHERE base_tokens > extended_tokens AND (base_tokens - extended_tokens) / base_tokens * 100 >= 25""",
)
def term_gains(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct chunk of the documents as a term."""
    both = encoding.compare_lengths(_both_sizes(spark, sf).withColumnRenamed("chunk", "term"))
    return encoding.term_gains(both).withColumn("saved_percent", F.round("saved_percent", 6))


@query(
    "fertility",
    f"""WITH RECURSIVE {_ENCODED} SELECT doc_id, CAST(len({S.split_any('text')}) AS INT) AS n_words, CAST(len(ids) AS BIGINT) AS n_tokens,
      round(len(ids) / len({S.split_any('text')}), 6) AS tokens_per_word FROM ided JOIN documents USING (doc_id)""",
)
def fertility(spark: SparkSession, sf: str) -> DataFrame:
    lengths = encoding.text_lengths(I.documents(spark, sf), F.col("text"), I.base_vocab(spark, sf))
    report = encoding.fertility(I.documents(spark, sf), lengths, F.col("text"))
    return report.withColumn("tokens_per_word", F.round("tokens_per_word", 6))


@query(
    "embedding_stats",
    """SELECT CAST(i - 1 AS INT) AS pos, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std FROM (
      SELECT i, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))
    GROUP BY i""",
)
def embedding_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = vector.embedding_stats(I.table(spark, sf, "embeddings", "embedding"))
    return stats.select("pos", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query("init_vectors")
def init_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The embedding table extended by one tenth new rows."""
    rows = I.table(spark, sf, "embeddings", "vec_id", "embedding")
    grown = vector.init_vectors(rows, rows.count() // 10)
    return grown.select("vec_id", bars(F.transform("embedding", lambda x: F.round(x, 4).cast("string"))).alias("embedding"))
