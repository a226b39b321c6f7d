"""Queries on lexical, vector and hybrid retrieval and on dictionary lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import lexical, lookup, vector
from textloom.operators.index import StoredIndex
from textloom.operators.prompts import semantic_rules
from textloom.plans import inputs as I
from textloom.plans import sql as S
from textloom.plans.queries_text import bars
from textloom.plans.registry import query
from textloom.session import scratch_path


def _postings_sql(name: str, table: str, id_col: str, text: str) -> str:
    return f"""{name} AS (SELECT {id_col} AS pair_id, token, count(*) AS tf, any_value(dl) AS dl FROM (
      SELECT {id_col}, len(ts) AS dl, unnest(ts) AS token FROM (SELECT {id_col}, {S.tok_ws(text)} AS ts FROM {table})) GROUP BY ALL)"""


def _idf_sql(docs: str, doc_id: str, doc_text: str) -> str:
    return f"""{_postings_sql('post', docs, doc_id, doc_text)},
corpus AS (SELECT (SELECT count(*) FROM {docs}) AS n, (SELECT sum(tf) FROM post) / (SELECT count(*) FROM {docs}) AS avg_len),
raw_idf AS (SELECT token, count(*) AS df, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM post, corpus GROUP BY token, n),
idf AS (SELECT token, df, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM raw_idf) ELSE idf END AS idf FROM raw_idf)"""


def _bm25_sql(docs: str, doc_id: str, doc_text: str, queries: str, query_id: str, query_text: str, k: int) -> str:
    return f"""{_idf_sql(docs, doc_id, doc_text)},
asked AS (SELECT {query_id} AS query_id, token, count(*) AS qtf FROM (
  SELECT {query_id}, unnest({S.tok_ws(query_text)}) AS token FROM {queries}) GROUP BY ALL),
scored AS (SELECT query_id, pair_id, sum(qtf * idf * tf * 2.5 / (tf + CAST(1.5 AS DOUBLE) * (CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * dl / avg_len))) AS score
  FROM asked JOIN post USING (token) JOIN idf USING (token), corpus GROUP BY ALL),
bm25 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, pair_id DESC) AS rank FROM scored)
  WHERE rank <= {k})"""


def stored_index(spark: SparkSession, counted: DataFrame) -> StoredIndex:
    index = StoredIndex(spark, scratch_path(spark, "index"))
    index.append(counted)
    return index


@query(
    "bm25_topk",
    f"""WITH {_bm25_sql('documents', 'doc_id', 'text', 'benchmark', 'item_id', 'text', 5)}
    SELECT query_id, pair_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM bm25""",
)
def bm25_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking of the documents from an index stored once."""
    tokens, docs = T.tokenize_ws(F.col("text")), I.corpus(spark, sf)
    stored = stored_index(spark, lexical.counted(docs, "pair_id", tokens))
    best = lexical.bm25_topk(I.passages(spark, sf), docs, tokens, tokens, forward=stored.documents(), totals=stored.totals())
    return best.select("query_id", "pair_id", F.round("score", 6).alias("score"), "rank")


@query(
    "bm25_topk_tgt",
    f"""WITH {S.PAIRS}, {_bm25_sql('pairs', 'pair_id', 'tgt', 'benchmark', 'item_id', 'text', 3)}
    SELECT query_id, pair_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM bm25""",
)
def bm25_topk_tgt(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking on the target side, from an index stored once and read for that language only."""
    pairs = I.parallel_pairs(spark, sf)
    stored = stored_index(spark, lexical.parallel_counted(pairs, "za", "eng"))
    tokens = lexical.TOKENIZERS["eng"](F.col("text"))
    best = lexical.bm25_topk(I.passages(spark, sf), pairs, tokens, tokens, k=3, forward=stored.documents("eng"), totals=stored.totals("eng"))
    return best.select("query_id", "pair_id", F.round("score", 6).alias("score"), "rank")


@query(
    "bm25_stats",
    f"""WITH {_idf_sql('documents', 'doc_id', 'text')}
    SELECT token, df, round(idf, 6) AS idf, CAST(n AS DOUBLE) AS n_docs, round(avg_len, 6) AS avg_len FROM idf, corpus""",
)
def bm25_stats(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.corpus(spark, sf)
    stats = lexical.bm25_stats(lexical.postings(docs, "pair_id", T.tokenize_ws(F.col("text"))), docs)
    return stats.select("token", "df", F.round("idf", 6).alias("idf"), "n_docs", F.round("avg_len", 6).alias("avg_len"))


_INDEX = f"""{S.PAIRS}, {_postings_sql('za', 'pairs', 'pair_id', 'src')}, {_postings_sql('eng', 'pairs', 'pair_id', 'tgt')}"""


@query(
    "inverted_index",
    f"""WITH {_INDEX} SELECT 'za' AS lang, token, pair_id, CAST(tf AS INT) AS tf FROM za
    UNION ALL SELECT 'eng', token, pair_id, CAST(tf AS INT) FROM eng""",
)
def inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.parallel_postings(I.parallel_pairs(spark, sf), "za", "eng").select("lang", "token", "pair_id", "tf")


@query(
    "lookup_word",
    f"""WITH {_INDEX}, {S.WORDS} SELECT word, pair_id, CAST(tf AS INT) AS tf, src FROM words JOIN za ON token = word JOIN pairs USING (pair_id)""",
)
def lookup_word(spark: SparkSession, sf: str) -> DataFrame:
    """Every passage word, asked with blanks and capitals."""
    pairs = I.parallel_pairs(spark, sf)
    index = stored_index(spark, lexical.parallel_counted(pairs, "za", "eng")).postings("za")
    asked = I.passage_words(spark, sf).select(F.concat(F.lit(" "), F.translate("word", "abcdefgh", "ABCDEFGH"), F.lit("\t")).alias("word"))
    found = lexical.lookup_word(asked, index, pairs)
    return found.select(T.strip(F.lower("word")).alias("word"), "pair_id", "tf", "src")


@query(
    "lookup_word_pair",
    f"""WITH {_INDEX}, asked AS (SELECT DISTINCT ts[i] AS src_word, ts[i + 1] AS tgt_word FROM (
      SELECT ts, unnest(range(1, len(ts))) AS i FROM (SELECT {S.tok_ws('text')} AS ts FROM documents)))
    SELECT src_word, tgt_word, z.pair_id, CAST(z.tf AS INT) AS tf FROM asked JOIN za z ON z.token = src_word
    JOIN eng e ON e.token = tgt_word AND e.pair_id = z.pair_id""",
)
def lookup_word_pair(spark: SparkSession, sf: str) -> DataFrame:
    """All neighbouring words of every document as word pairs."""
    stored = stored_index(spark, lexical.parallel_counted(I.parallel_pairs(spark, sf), "za", "eng"))
    both = [stored.postings(lang).withColumn("lang", F.lit(lang)) for lang in ("za", "eng")]
    words = I.documents(spark, sf).select(T.tokenize_ws(F.col("text")).alias("t"))
    following = F.arrays_zip(F.col("t").alias("src_word"), F.slice("t", 2, 2**31 - 1).alias("tgt_word"))
    # The outer form, and no filter on the words, so that each text is cut into words once in a pass.
    asked = words.select(F.inline_outer(following)).where("tgt_word is not null")
    return lexical.lookup_word_pair(asked, both[0].unionByName(both[1]), "za", "eng")


def keyword_queries(items: DataFrame) -> DataFrame:
    return items.select("query_id", T.word_set(F.col("za")).alias("words"), F.map_keys("related_words").alias("keys"))


def keyword_hits(spark: SparkSession, sf: str, items: DataFrame) -> DataFrame:
    return vector.keyword_score(keyword_queries(items), I.rules(spark, sf))


@query("keyword_score", f"WITH {S.KEYWORDS} SELECT query_id, rule_id, kw FROM kw")
def keyword_score(spark: SparkSession, sf: str) -> DataFrame:
    return keyword_hits(spark, sf, I.items(spark, sf))


def item_vectors(spark: SparkSession, sf: str, items: DataFrame) -> DataFrame:
    return I.assigned_vectors(spark, sf, items.select(F.col("query_id").alias("id")), 31, 0)


def rule_vectors(spark: SparkSession, sf: str, factor: int = 1, offset: int = 0) -> DataFrame:
    ids = I.table(spark, sf, "benchmark", F.col("item_id").alias("id"))
    return I.assigned_vectors(spark, sf, ids, factor, offset)


def hybrid(spark: SparkSession, sf: str, k: int = 5, alpha: float = 0.5, mode: str = "hybrid") -> DataFrame:
    items = I.items(spark, sf)
    kw = keyword_hits(spark, sf, items)
    return vector.hybrid_topk(kw, item_vectors(spark, sf, items), rule_vectors(spark, sf), k, alpha, mode)


def _rounded(best: DataFrame) -> DataFrame:
    kept = ["query_id", "rule_id", F.col("kw").cast("long").alias("kw"), F.round("cos", 6).alias("cos")]
    return best.select(*kept, F.round("score", 6).alias("score"), "rank")


_BEST = "SELECT query_id, rule_id, CAST(kw AS BIGINT) AS kw, round(cos, 6) AS cos, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM best"


@query("hybrid_topk", f"WITH {S.HYBRID}, {S.best_rules('0.5', 5)} {_BEST}")
def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(hybrid(spark, sf))


@query("keyword_topk", f"WITH {S.HYBRID}, {S.best_rules('1.0', 3)} {_BEST}")
def keyword_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Retrieval mode ``keyword``."""
    return _rounded(hybrid(spark, sf, 3, mode="keyword"))


@query("semantic_topk", f"WITH {S.HYBRID}, {S.best_rules('0.0', 3)} {_BEST}")
def semantic_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Retrieval mode ``semantic``."""
    return _rounded(hybrid(spark, sf, 3, mode="semantic"))


_DYNAMIC = f"""{S.HYBRID.replace('fused AS (SELECT q.query_id', 'fused0 AS (SELECT q.query_id')},
fused AS (SELECT f.*, CASE WHEN len({S.split_any('za')}) < 5 THEN 0.7 ELSE 0.3 END AS a FROM fused0 f JOIN items USING (query_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, rule_id DESC) AS rank
  FROM (SELECT query_id, rule_id, kw, cos, CAST(a AS DOUBLE) * kw / (top_kw + CAST(1e-9 AS DOUBLE)) + (1 - CAST(a AS DOUBLE)) * (cos + 1) / 2 AS score
    FROM fused)) WHERE rank <= 3)"""


@query("hybrid_dynamic_topk", f"WITH {_DYNAMIC} {_BEST}")
def hybrid_dynamic_topk(spark: SparkSession, sf: str) -> DataFrame:
    items = I.items(spark, sf)
    kw = keyword_hits(spark, sf, items)
    sentences = items.select("query_id", F.col("za").alias("text"))
    return _rounded(vector.hybrid_dynamic_topk(kw, item_vectors(spark, sf, items), rule_vectors(spark, sf), sentences))


@query(
    "rerank_topk",
    f"""WITH {S.HYBRID}, {S.best_rules('0.5', 5)}, {S.assigned('q2', 'items', 'query_id', 7, 3)}, {S.assigned('r2', 'rules', 'rule_id', 7, 3)},
    again AS (SELECT b.query_id, b.rule_id, b.rank, list_cosine_similarity(q2.vec, r2.vec) AS s FROM best b
      JOIN q2 ON q2.query_id = b.query_id JOIN r2 ON r2.rule_id = b.rule_id)
    SELECT query_id, rule_id, CAST(rank AS INT) AS first_rank, round(s, 6) AS rerank_score FROM again
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(s, 9) DESC, rank) = 1""",
)
def rerank_topk(spark: SparkSession, sf: str) -> DataFrame:
    items = I.items(spark, sf)
    second = I.assigned_vectors(spark, sf, items.select(F.col("query_id").alias("id")), 7, 3)
    best = vector.rerank_topk(hybrid(spark, sf).select("query_id", "rule_id", "rank"), second, rule_vectors(spark, sf, 7, 3))
    return best.withColumn("rerank_score", F.round("rerank_score", 6))


def vector_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Every tenth embedding asks, the others answer."""
    rows = I.vectors(spark, sf)
    return rows.where("id % 10 = 0"), rows.where("id % 10 <> 0")


_COSINE = f"""{S.VECS}, cos AS (SELECT q.vec_id AS query_id, i.vec_id AS item_id, list_cosine_similarity(q.vec, i.vec) AS score
  FROM vecs q JOIN vecs i ON q.vec_id % 10 = 0 AND i.vec_id % 10 <> 0)"""


@query("cosine_scores", f"WITH {_COSINE} SELECT query_id, item_id, round(score, 6) AS score FROM cos WHERE score >= 0.25")
def cosine_scores(spark: SparkSession, sf: str) -> DataFrame:
    found = vector.cosine_scores(*vector_sides(spark, sf), min_score=0.25)
    return found.withColumn("score", F.round("score", 6))


@query(
    "cosine_topk",
    f"""WITH {_COSINE} SELECT query_id, item_id, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM cos) WHERE rank <= 3""",
)
def cosine_topk(spark: SparkSession, sf: str) -> DataFrame:
    return vector.cosine_topk(*vector_sides(spark, sf), k=3).withColumn("score", F.round("score", 6))


RULE_TEXT_SQL = """'Grammar description: ' || grammar_description || chr(10) || CASE WHEN len(ex) > 0 THEN
  'Examples:' || chr(10) || '  - Zhuang: ' || ex[1] || chr(10) || '    Chinese: zh ' || ex[1] || chr(10) ELSE '' END"""


def semantic_sql(queries: str, query_id: str) -> str:
    return f"""{S.assigned('sq', queries, query_id, 31, 0)}, {S.assigned('sr', 'rules', 'rule_id', 1, 0)},
near AS (SELECT query_id, rule_id, score, rank FROM (SELECT sq.{query_id} AS query_id, sr.rule_id, list_cosine_similarity(sq.vec, sr.vec) AS score,
  row_number() OVER (PARTITION BY sq.{query_id} ORDER BY round(list_cosine_similarity(sq.vec, sr.vec), 9) DESC, sr.rule_id) AS rank
  FROM sq CROSS JOIN sr JOIN rules r ON r.rule_id = sr.rule_id AND r.grammar_description <> '') WHERE rank <= 2 AND score > 0.5),
near_text AS (SELECT near.*, {RULE_TEXT_SQL} AS rule_text FROM near JOIN rules USING (rule_id))"""


@query(
    "semantic_rules",
    f"""WITH {S.ITEMS}, {S.RULES}, {S.VECS}, {semantic_sql('items', 'query_id')}
    SELECT query_id, rule_id, CAST(rank AS INT) AS rank, round(score, 6) AS score, rule_text FROM near_text""",
)
def semantic(spark: SparkSession, sf: str) -> DataFrame:
    found = semantic_rules(item_vectors(spark, sf, I.items(spark, sf)), I.rules(spark, sf), rule_vectors(spark, sf))
    return found.withColumn("score", F.round("score", 6))


@query(
    "rule_text",
    f"WITH {S.RULES} SELECT rule_id, grammar_description || chr(10) || coalesce(array_to_string(ex, ' '), '') AS text FROM rules",
)
def rule_text(spark: SparkSession, sf: str) -> DataFrame:
    return vector.rule_text(I.rules(spark, sf))


@query(
    "dict_exact",
    f"""WITH {S.DICTIONARY}, {S.WORDS} SELECT word, array_to_string(list_slice(meanings, 1, 2), '|') AS meanings, source
    FROM words LEFT JOIN dict USING (word)""",
)
def dict_exact(spark: SparkSession, sf: str) -> DataFrame:
    words = I.passage_words(spark, sf)
    found = lookup.dict_exact(words, I.dictionary(spark, sf, only=words), 2)
    return found.select("word", bars("meanings").alias("meanings"), "source")


MISSING_SQL = f"""{S.DICTIONARY}, {S.WORDS},
missing AS (SELECT word FROM words WHERE word NOT IN (SELECT word FROM dict)),
pool AS (SELECT word AS match, entry_rank FROM dict WHERE length(word) >= 3)"""
AFFIX_SQL = """prefix AS (SELECT word, match FROM (SELECT word, match, row_number() OVER (PARTITION BY word ORDER BY length(match) DESC) AS r
  FROM (SELECT word, substring(word, 1, n) AS match FROM (SELECT word, unnest(range(1, length(word) + 1)) AS n FROM asked_words))
  JOIN pool USING (match)) WHERE r = 1),
suffix AS (SELECT word, match FROM (SELECT t.word, t.match, row_number() OVER (PARTITION BY t.word ORDER BY length(t.match) DESC) AS r
  FROM (SELECT word, right(word, n) AS match FROM (SELECT word, unnest(range(1, length(word) + 1)) AS n FROM asked_words)) t
  JOIN pool USING (match) LEFT JOIN prefix p ON p.word = t.word WHERE p.match IS NULL OR p.match <> t.match) WHERE r = 1)"""
def _one_byte(x: str) -> str:
    """The checking engine counts edits in bytes; lowered words leave the capitals free to stand for other letters."""
    return f"translate({x}, 'áéíóúñüçèêàâîôûäößëï', 'ABCDEFGHIJKLMNOPQRSTU')"


FUZZY_SQL = f"""ratio AS (SELECT word, match, entry_rank,
    100 * (1 - CAST(levenshtein({_one_byte("word")}, {_one_byte("match")}) AS DOUBLE) / greatest(length(word), length(match))) AS score FROM asked_fuzzy CROSS JOIN pool),
fuzzy AS (SELECT word, match, score, rank FROM (SELECT *, row_number() OVER (PARTITION BY word ORDER BY round(score, 9) DESC, entry_rank) AS rank
  FROM ratio) WHERE rank <= 2)"""


def missing_words(spark: SparkSession, sf: str, dictionary: DataFrame) -> DataFrame:
    return I.passage_words(spark, sf).join(dictionary.select("word"), "word", "left_anti")


@query("dict_prefix", f"WITH {MISSING_SQL}, asked_words AS (SELECT word FROM words), {AFFIX_SQL} SELECT word, match, CAST(100 AS DOUBLE) AS score FROM prefix")
def dict_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.dict_prefix(I.passage_words(spark, sf), lookup.choices(I.dictionary(spark, sf), 3))


@query("dict_suffix", f"WITH {MISSING_SQL}, asked_words AS (SELECT word FROM words), {AFFIX_SQL} SELECT word, match, CAST(100 AS DOUBLE) AS score FROM suffix")
def dict_suffix(spark: SparkSession, sf: str) -> DataFrame:
    words = I.passage_words(spark, sf)
    pool = lookup.affix_entries(words, lookup.choices(I.dictionary(spark, sf), 3)).persist()
    return lookup.dict_suffix(words, pool, lookup.dict_prefix(words, pool))


@query(
    "dict_fuzzy_topk",
    f"WITH {MISSING_SQL}, asked_fuzzy AS (SELECT word FROM missing), {FUZZY_SQL} SELECT word, match, round(score, 6) AS score, CAST(rank AS INT) AS rank FROM fuzzy",
)
def dict_fuzzy_topk(spark: SparkSession, sf: str) -> DataFrame:
    dictionary = I.dictionary(spark, sf).persist()
    found = lookup.dict_fuzzy_topk(missing_words(spark, sf, dictionary), lookup.choices(dictionary, 3), 2)
    return found.withColumn("score", F.round("score", 6))


LOOKUP_SQL = f"""asked_words AS (SELECT word FROM missing), {AFFIX_SQL}, asked_fuzzy AS (SELECT word FROM missing), {FUZZY_SQL},
listed AS (SELECT word, match, 1 AS n, CAST(100 AS DOUBLE) AS score FROM prefix UNION ALL SELECT word, match, 2, 100 FROM suffix),
staged AS (SELECT * FROM listed UNION ALL SELECT word, match, 2 + rank, score FROM fuzzy f
  WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.word = f.word AND l.match = f.match)),
found AS (SELECT word, 1 AS n, 'exact' AS stage, word AS match, CAST(100 AS DOUBLE) AS score FROM words WHERE word IN (SELECT word FROM dict)
  UNION ALL SELECT word, row_number() OVER (PARTITION BY word ORDER BY n) AS rn,
    CASE n WHEN 1 THEN 'prefix' WHEN 2 THEN 'suffix' ELSE 'fuzzy' END, match, score FROM staged QUALIFY rn <= 2)"""


@query(
    "dict_lookup",
    f"""WITH {MISSING_SQL}, {LOOKUP_SQL} SELECT f.word, CAST(n AS INT) AS n, stage, f.match, round(score, 6) AS score,
      array_to_string(list_slice(meanings, 1, 2), '|') AS meanings FROM found f JOIN dict d ON d.word = f.match""",
)
def dict_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = lookup.dict_lookup(I.passage_words(spark, sf), I.dictionary(spark, sf).persist(), min_chars=3)
    return found.select("word", "n", "stage", "match", F.round("score", 6).alias("score"), bars("meanings").alias("meanings"))
