"""Queries on sources, contracts, sinks, projections and tokenizers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import encoding, shaping
from textloom.plans import inputs as I
from textloom.plans import sql as S
from textloom.plans.registry import query
from textloom.session import scratch_path
from textloom.sources import contracts, lines, sinks, tables


def bars(col: str | Column) -> Column:
    """Arrays leave a query as text, so that both engines print them alike."""
    return F.array_join(col, "|")


def _sql_bars(x: str) -> str:
    return f"coalesce(array_to_string({x}, '|'), '')"


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, text, label, split)``: document language as class, every fifth document as test set."""
    docs = I.documents(spark, sf, "lang")
    split = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    return docs.select("doc_id", "text", F.col("lang").alias("label"), split.alias("split"))


@query("scan_split", "SELECT doc_id, lang AS label, length(text) AS n FROM documents WHERE doc_id % 5 <> 0")
def scan_split(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "labelled")
    labelled(spark, sf).write.partitionBy("split").parquet(path)
    rows = tables.scan_split(spark, path, "train", ["doc_id", "text", "label"])
    return rows.select("doc_id", "label", F.length("text").cast("long").alias("n"))


def ragged_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, value)``: each document in one of the shapes of a corpus line, by its number, and blank lines."""
    d = I.documents(spark, sf, "lang", "source", "n_chars")
    one_line = F.translate("text", "\n", " ")
    shape = F.col("doc_id") % 8
    json_string = F.to_json(F.array("text"))
    value = (
        F.when(shape == 0, F.to_json(F.struct("text", F.col("source").alias("title"))))
        .when(shape == 1, F.to_json(F.struct(F.col("source").alias("title"), F.col("text").alias("body"))))
        .when(shape == 2, F.to_json(F.struct("lang", "n_chars", F.col("text").alias("note"))))
        .when((shape == 3) & (F.col("doc_id") % 16 == 11), F.concat(F.lit("{"), one_line, F.lit("}")))
        .when(shape == 3, one_line)
        .when(shape == 4, F.substring(json_string, F.lit(2), F.length(json_string) - 2))
        .when(shape == 5, json_string)
        .when(shape == 6, F.to_json(F.struct(F.array("lang", "text").alias("abstract"))))
        .otherwise(F.to_json(F.struct(F.lit("").alias("title"), F.col("text").alias("document"))))
    )
    blank = d.where(shape == 7).select("doc_id", F.lit("  ").alias("value"))
    return d.select("doc_id", value.alias("value")).unionByName(blank)


@query(
    "extract_text",
    f"""SELECT doc_id, {S.strip('t')} AS text FROM (SELECT doc_id, CASE
      WHEN doc_id % 8 = 0 THEN text || ' ' || source WHEN doc_id % 8 = 1 THEN text || ' ' || source
      WHEN doc_id % 8 = 2 THEN lang || ' ' || text WHEN doc_id % 16 = 11 THEN '{{' || replace(text, chr(10), ' ') || '}}'
      WHEN doc_id % 8 = 3 THEN replace(text, chr(10), ' ') WHEN doc_id % 8 = 4 THEN text
      WHEN doc_id % 8 = 6 THEN lang || ' ' || text WHEN doc_id % 8 = 7 THEN text END AS t FROM documents)
    WHERE t IS NOT NULL AND {S.strip('t')} <> ''""",
)
def extract_text(spark: SparkSession, sf: str) -> DataFrame:
    return lines.extract_text(ragged_lines(spark, sf))


@query(
    "extract_text_errors",
    """SELECT doc_id, CASE WHEN doc_id % 8 = 5 THEN 'JSON value without text' WHEN doc_id % 8 = 7 THEN 'blank line'
      ELSE 'broken JSON object kept as text' END AS reason FROM documents
    WHERE doc_id % 8 IN (5, 7) OR doc_id % 16 = 11""",
)
def extract_text_errors(spark: SparkSession, sf: str) -> DataFrame:
    return lines.extract_text_errors(ragged_lines(spark, sf)).select("doc_id", "reason")


@query(
    "load_json_array",
    f"""WITH {S.RULES} SELECT rule_id, grammar_description, CAST(len(ex) AS BIGINT) AS examples,
      (SELECT count(*) FROM rule_words w WHERE w.rule_id = rules.rule_id) AS words FROM rules""",
)
def load_json_array(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "rules")
    # Files of one hundred rules each, every file one JSON array.
    packed = I.rules(spark, sf).groupBy(F.floor(F.col("rule_id") / 100).alias("file")).agg(
        F.to_json(F.collect_list(F.struct("rule_id", "grammar_description", "examples"))).alias("value")
    )
    packed.select("value").write.option("maxRecordsPerFile", 1).text(path)
    rules = tables.read_json_array(spark, path, tables.RULE_SCHEMA)
    n_words = F.aggregate("examples", F.lit(0), lambda a, e: a + F.size(e["related_words"]))
    return rules.select(
        "rule_id", "grammar_description", F.size("examples").cast("long").alias("examples"), n_words.cast("long").alias("words")
    )


@query(
    "load_parallel",
    f"""WITH {S.PAIRS} SELECT pair_id, src, tgt,
      CASE WHEN pair_id // 4294967296 % 2 = 0 THEN 'talk' ELSE 'n/a' END AS source FROM pairs""",
)
def load_parallel(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pairs") + ".jsonl"
    even = F.floor(F.col("pair_id") / I.TURN_ID) % 2 == 0
    rows = I.parallel_pairs(spark, sf).select(
        F.col("pair_id").alias("line"), F.col("src").alias("za"), F.col("tgt").alias("zh"), F.when(even, "talk").alias("source")
    )
    rows.write.json(path)
    return tables.read_parallel(spark, path, "za", "zh")


@query(
    "load_dictionary",
    f"WITH {S.DICTIONARY} SELECT word, {_sql_bars('meanings')} AS meanings, source, entry_rank.doc_id AS first_doc, CAST(entry_rank.pos AS INTEGER) AS first_pos FROM dict",
)
def load_dictionary(spark: SparkSession, sf: str) -> DataFrame:
    return I.dictionary(spark, sf).select("word", bars("meanings").alias("meanings"), "source", F.col("entry_rank.doc_id").alias("first_doc"), F.col("entry_rank.pos").alias("first_pos"))


@query(
    "resolve_text_column",
    "SELECT page_id, html AS text FROM pages WHERE page_id % 3 <> 0",
)
def resolve_text_column(spark: SparkSession, sf: str) -> DataFrame:
    content = F.when(F.col("page_id") % 3 != 0, F.col("html")).alias("content")
    return tables.resolve_text_column(I.table(spark, sf, "pages", "page_id", F.col("url").alias("title"), content)).select("page_id", "text")


def response_items(spark: SparkSession, sf: str) -> DataFrame:
    """``(item_id, response_set)``: user turn as question, next turn as answer, both as responses."""
    rows = I.turns(spark, sf).where("role = 'user' and next_text is not null")
    response = F.array(
        F.struct(F.col("next_role").alias("model"), F.col("next_text").alias("output"), F.lit("next").alias("remark")),
        F.struct(F.col("role").alias("model"), F.col("text").alias("output"), F.lit("own").alias("remark")),
    )
    return rows.select(
        "id", F.col("text").alias("question"), F.col("next_text").alias("reference_answer"), response.alias("model_responses")
    )


_BROKEN = {1: "id_is_integer", 2: "question_is_string", 3: "remark_is_string", 4: "model_responses_is_list"}


@query(
    "validate_responses",
    f"""WITH {S.TURNS}, bad AS (SELECT id, id // 4294967296 % 7 AS kind FROM turns WHERE role = 'user' AND next_text IS NOT NULL),
    rules AS (SELECT unnest([{S.listed(contracts.RULES)}]) AS rule),
    hits AS (SELECT CASE kind {' '.join(f"WHEN {k} THEN '{r}'" for k, r in _BROKEN.items())} END AS rule,
      count(*) AS violations, min(id) AS first_bad_item FROM bad GROUP BY 1)
    SELECT rule, coalesce(violations, 0) AS violations, first_bad_item FROM rules LEFT JOIN hits USING (rule)""",
)
def validate_responses(spark: SparkSession, sf: str) -> DataFrame:
    good = response_items(spark, sf)
    kind = F.floor(F.col("id") / I.TURN_ID) % 7
    bare = F.transform("model_responses", lambda r: F.struct(r["model"].alias("model"), r["output"].alias("output")))
    others = ["question", "reference_answer"]
    value = (
        F.when(kind == 1, F.to_json(F.struct(F.col("id").cast("string").alias("id"), *others, "model_responses")))
        .when(kind == 2, F.to_json(F.struct("id", "reference_answer", "model_responses")))
        .when(kind == 3, F.to_json(F.struct("id", *others, F.slice(bare, 1, 1).alias("model_responses"))))
        .when(kind == 4, F.to_json(F.struct("id", *others, F.lit("none").alias("model_responses"))))
        .otherwise(F.to_json(F.struct("id", *others, "model_responses")))
    )
    items = good.select(F.col("id").alias("item_id"), F.parse_json(value).alias("item"))
    return contracts.validate_responses(items)


@query(
    "explode_responses",
    f"""WITH {S.TURNS}, asked AS (SELECT * FROM turns WHERE role = 'user' AND next_text IS NOT NULL)
    SELECT id, 0 AS pos, next_role AS model, next_text AS output, 'next' AS remark FROM asked
    UNION ALL SELECT id, 1, role, text, 'own' FROM asked""",
)
def explode_responses(spark: SparkSession, sf: str) -> DataFrame:
    return contracts.explode_responses(response_items(spark, sf))


@query(
    "explode_examples",
    f"""WITH {S.RULES} SELECT rule_id, CAST(pos - 1 AS INT) AS pos, za, 'zh ' || za AS zh,
      (SELECT count(*) FROM rule_words w WHERE w.rule_id = e.rule_id AND w.pos = e.pos) AS words FROM examples e""",
)
def explode_examples(spark: SparkSession, sf: str) -> DataFrame:
    flat = tables.explode_examples(I.rules(spark, sf))
    return flat.select("rule_id", "pos", "za", "zh", F.size("related_words").cast("long").alias("words"))


def metric_rows(spark: SparkSession, sf: str, old: bool) -> DataFrame:
    """One metrics row per source, language and split: shares of labelled documents by class."""
    docs = I.table(spark, sf, "documents", "doc_id", "lang", "source").join(I.table(spark, sf, "labels"), "doc_id")
    score = F.avg("quality") if old else F.avg("toxic")
    split = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    rows = docs.groupBy(F.col("lang").alias("model"), F.col("source").alias("dataset"), split.alias("split")).agg(
        F.round(score, 6).alias("accuracy")
    )
    return rows if old else rows.where("model <> 'en'")


@query(
    "upsert_metrics",
    """WITH m AS (SELECT lang AS model, source AS dataset, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
      round(avg(quality), 6) AS old, round(avg(toxic), 6) AS new FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
    SELECT model, dataset, split, CASE WHEN model = 'en' THEN old ELSE new END AS accuracy FROM m""",
)
def upsert_metrics(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["model", "dataset", "split", "accuracy"]
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(metric_rows(spark, sf, old=True).select(*columns), path)
    sinks.write_metrics(metric_rows(spark, sf, old=False).select(*columns), path)
    return spark.read.parquet(path).select(*columns)


@query(
    "upsert_metrics_table",
    """WITH m AS (SELECT lang AS model, source AS dataset, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
      round(avg(quality), 6) AS old, round(avg(toxic), 6) AS new FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
    SELECT model, dataset, split, CASE WHEN model = 'en' THEN old ELSE new END AS accuracy FROM m""",
)
def upsert_metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    return sinks.upsert_metrics(metric_rows(spark, sf, old=True), metric_rows(spark, sf, old=False))


@query("submission_csv", "SELECT conv_id || '-' || turn AS id, text AS translation FROM conversations")
def submission_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "submission")
    rows = I.table(spark, sf, "conversations", F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("text").alias("translation"))
    sinks.write_submission(rows, path)
    return sinks.read_submission(spark, path)


@query("result_log", f"WITH {S.LEVELLED} SELECT id, pred, gold, source FROM rated")
def result_log(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "log")
    sinks.write_log(I.translations(spark, sf), path)
    return spark.read.schema("id bigint, pred string, gold string, source string").json(path)


@query("vocab_export", f"WITH {S.BASE_VOCAB} SELECT token, token_id FROM base")
def vocab_export(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "vocab")
    sinks.write_vocab(I.base_vocab(spark, sf), path)
    return spark.read.schema("token string, token_id bigint").json(f"{path}/ids")


@query("skip_empty", f"WITH {S.TURNS} SELECT id, next_text AS za FROM turns WHERE length(next_text) > 0")
def skip_empty(spark: SparkSession, sf: str) -> DataFrame:
    items = I.turns(spark, sf).select("id", F.coalesce("next_text", F.lit("")).alias("za"))
    return tables.skip_empty(items)


@query(
    "multilabel_binarize",
    "SELECT doc_id, concat(CASE WHEN quality = 1 THEN 1 ELSE 0 END, '|', CASE WHEN toxic = 1 THEN 1 ELSE 0 END, '|0|0') AS label FROM labels",
)
def multilabel_binarize(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.multilabel(spark, sf)
    return rows.select("doc_id", bars(shaping.multilabel_binarize(F.col("label_ids"), 4).cast("array<string>")).alias("label"))


@query("preview", "SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS preview FROM documents")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return I.documents(spark, sf).select("doc_id", shaping.preview(F.col("text")).alias("preview"))


@query("sample_n", "SELECT doc_id, lang FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.sample_n(I.table(spark, sf, "documents", "doc_id", "lang"), "doc_id", 100)


@query("head_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100")
def head_n(spark: SparkSession, sf: str) -> DataFrame:
    return shaping.head_n(I.documents(spark, sf), "doc_id", 100)


def _tokens_query(name: str, sql_tokens: str, tokenize: Callable[[Column], Column]) -> None:
    sql = f"SELECT doc_id, CAST(len(t) AS BIGINT) AS n, {_sql_bars('t')} AS tokens FROM (SELECT doc_id, {sql_tokens} AS t FROM documents)"

    @query(name, sql)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        rows = I.documents(spark, sf).select("doc_id", tokenize(F.col("text")).alias("t"))
        return rows.select("doc_id", F.size("t").cast("long").alias("n"), bars("t").alias("tokens"))


_tokens_query("tokenize_ws", S.tok_ws("text"), T.tokenize_ws)
_tokens_query("tokenize_ws_keep", S.tok_ws_keep("text"), T.tokenize_ws_keep)
_tokens_query("pretokenize", S.pretokens("text"), T.pretokenize)
_tokens_query("pretokenize_single_marks", S.bert_tokens("text"), lambda text: T.pretokenize(text, single_marks=True))


@query(
    "word_ngrams",
    f"""SELECT doc_id, {_sql_bars(S.ngrams('t', 3))} AS grams FROM (SELECT doc_id, {S.tok_ws('text')} AS t FROM documents)""",
)
def word_ngrams(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.documents(spark, sf).select("doc_id", T.tokenize_ws(F.col("text")).alias("t"))
    return rows.select("doc_id", bars(T.word_ngrams(F.col("t"), 3)).alias("grams"))


@query(
    "normalize_text",
    rf"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '[\t\n\r\p{{Z}}]', ' ', 'g'),
      '[\p{{Cc}}\p{{Cf}}\p{{Co}}\x{{fffd}}]', '', 'g'), '([{S.C.CJK_CHARS}])', ' \1 ', 'g') AS text FROM pages
    UNION ALL SELECT -1 - doc_id, regexp_replace(text, '[\t\n\r]', ' ', 'g') FROM documents""",
)
def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    pages = I.table(spark, sf, "pages", "page_id", F.col("html").alias("text"))
    docs = I.table(spark, sf, "documents", (-1 - F.col("doc_id")).alias("page_id"), "text")
    return pages.unionByName(docs).select("page_id", T.normalize_text(F.col("text")).alias("text"))


@query(
    "word_set",
    f"""SELECT doc_id, {_sql_bars('list_sort(list_distinct(w))')} AS words FROM (
      SELECT doc_id, {S.split_any("replace(replace(lower(text), '.', ''), ',', '')")} AS w FROM documents)""",
)
def word_set(spark: SparkSession, sf: str) -> DataFrame:
    return I.documents(spark, sf).select("doc_id", bars(F.array_sort(T.word_set(F.col("text")))).alias("words"))


@query("fold_apostrophes", "SELECT page_id, replace(replace(html, '‘', chr(39)), '’', chr(39)) AS text FROM pages")
def fold_apostrophes(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "pages", "page_id", "html").select("page_id", T.fold_apostrophes(F.col("html")).alias("text"))


_UNSPACED = rf"regexp_replace(regexp_replace(regexp_replace(lower(text), '[{S.C.CJK_MARKS}]', '', 'g'), '\p{{Nd}}+', '', 'g'), '[{S.WS}]+', '', 'g')"
_SEGMENT = f"""WITH RECURSIVE lex AS (SELECT DISTINCT w FROM (SELECT unnest({S.tok_ws('text')}) AS w FROM documents)),
texts AS (SELECT item_id, {_UNSPACED} AS t FROM benchmark),
spans AS (SELECT item_id, s, max(e) AS e FROM (
  SELECT item_id, t, s, unnest(range(s, least(length(t), s + (SELECT max(length(w)) FROM lex) - 1) + 1)) AS e FROM (
    SELECT item_id, t, unnest(range(1, length(t) + 1)) AS s FROM texts)) JOIN lex ON w = substring(t, s, e - s + 1) GROUP BY ALL),
jumps AS (SELECT item_id, s, coalesce(e, s) AS e FROM (SELECT item_id, unnest(range(1, length(t) + 1)) AS s FROM texts)
  LEFT JOIN spans USING (item_id, s)),
steps AS (SELECT item_id, CAST(1 AS BIGINT) AS at, CAST(0 AS BIGINT) AS s FROM texts UNION ALL
  SELECT t.item_id, j.e + 1, j.s FROM steps t JOIN jumps j ON j.item_id = t.item_id AND j.s = t.at),
cut AS (SELECT item_id, x.s, substring(t, x.s, x.at - x.s) AS word FROM steps x JOIN texts USING (item_id) WHERE x.s > 0)"""


@query("segment_longest", f"{_SEGMENT} SELECT item_id, string_agg(word, '|' ORDER BY s) AS tokens FROM cut GROUP BY item_id")
def segment_longest(spark: SparkSession, sf: str) -> DataFrame:
    return _segmented(spark, sf, search=False)


@query(
    "segment_search",
    f"""{_SEGMENT}, parts AS (
      SELECT item_id, s, word, unnest(range(1, length(word))) AS m, 2 AS n FROM cut WHERE length(word) > 2
      UNION ALL SELECT item_id, s, word, unnest(range(1, length(word) - 1)), 3 FROM cut WHERE length(word) > 3),
    allp AS (SELECT item_id, s, n, m, substring(word, m, n) AS piece FROM parts WHERE substring(word, m, n) IN (SELECT w FROM lex)
      UNION ALL SELECT item_id, s, 9, 0, word FROM cut)
    SELECT item_id, string_agg(piece, '|' ORDER BY s, n, m) AS tokens FROM allp GROUP BY item_id""",
)
def segment_search(spark: SparkSession, sf: str) -> DataFrame:
    return _segmented(spark, sf, search=True)


def _segmented(spark: SparkSession, sf: str, search: bool) -> DataFrame:
    """Passages without blanks, cut with the words of the documents."""
    lexicon = I.documents(spark, sf).select(F.explode_outer(T.tokenize_ws(F.col("text"))).alias("token"))
    joined = F.regexp_replace("text", f"[{S.WS}]+", "")
    texts = I.table(spark, sf, "benchmark", "item_id", joined.alias("text"))
    cut = encoding.segment(texts, "item_id", F.col("text"), lexicon.where("token is not null").distinct(), search)
    return cut.select("item_id", bars("tokens").alias("tokens"))
