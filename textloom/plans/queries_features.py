"""Queries on features, classifiers and classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.operators import class_metrics, features, shaping
from textloom.plans import inputs as I
from textloom.plans import sql as S
from textloom.plans.queries_text import bars, labelled
from textloom.plans.registry import query

_STOP = S.listed(C.STOP_WORDS)
_TERMS = rf"""kept AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({_STOP})) AS ws
  FROM documents),
terms AS (SELECT doc_id, term, count(*) AS tf FROM (
  SELECT doc_id, unnest(ws) AS term FROM kept
  UNION ALL SELECT doc_id, ws[i] || ' ' || ws[i + 1] FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM kept)) GROUP BY ALL),
top AS (SELECT term, sum(tf) AS total, count(*) AS df FROM terms GROUP BY term ORDER BY total DESC, term LIMIT 50000),
raw AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM terms JOIN top USING (term)),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""


@query("tfidf", f"WITH {_TERMS} SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf")
def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    weights = features.tfidf_features(I.documents(spark, sf), F.col("text"))
    return weights.withColumn("weight", F.round("weight", 6))


@query(
    "class_weights",
    """SELECT lang AS label, round((SELECT count(*) FROM documents) / ((SELECT count(DISTINCT lang) FROM documents) * count(*)), 6) AS weight
    FROM documents GROUP BY lang""",
)
def class_weights(spark: SparkSession, sf: str) -> DataFrame:
    return features.class_weights(labelled(spark, sf)).withColumn("weight", F.round("weight", 6))


@query("loglinear")
def loglinear(spark: SparkSession, sf: str) -> DataFrame:
    """Language of all documents: metrics on the training and the test set."""
    rows = labelled(spark, sf).withColumn("label", F.array_position(F.array(*[F.lit(x) for x in ("de", "en", "es", "fr")]), F.col("label")).cast("int") - 1)
    split = [rows.where(F.col("split") == name) for name in ("train", "test")]
    predicted = features.loglinear(*split, max_features=50000)
    return class_metrics.classification_metrics(predicted, ["split"])


_CENTROIDS = f"""{S.VECS}, cells AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM (
  SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY ALL),
cents AS (SELECT label, list(x ORDER BY i) AS c FROM cells GROUP BY label),
predicted AS (SELECT e.vec_id, e.label, p.label AS prediction FROM embeddings e JOIN (
  SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY round(list_cosine_similarity(vec, c), 9) DESC, label) AS r
  FROM vecs CROSS JOIN cents) p ON p.vec_id = e.vec_id AND p.r = 1),
classes AS (SELECT label AS cls FROM predicted UNION SELECT prediction FROM predicted),
f AS (SELECT cls, count(*) FILTER (label = cls AND prediction = cls) AS tp, count(*) FILTER (label <> cls AND prediction = cls) AS fp,
  count(*) FILTER (label = cls AND prediction <> cls) AS fn FROM classes CROSS JOIN predicted GROUP BY cls),
scores AS (SELECT round_even(avg(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END), 4) AS macro_f1,
  round_even(sum(tp) / (SELECT count(*) FROM predicted), 4) AS accuracy FROM f)"""


@query("classification_metrics", f"WITH {_CENTROIDS} SELECT accuracy, macro_f1, accuracy AS micro_f1 FROM scores")
def classification_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return class_metrics.classification_metrics(I.centroid_predictions(spark, sf))


_MULTI = """m AS (SELECT doc_id, [quality, toxic] AS y, [(n_chars - 1500) / 1000, (800 - n_chars) / 500] AS x
  FROM labels JOIN documents USING (doc_id)),
p AS (SELECT doc_id, y, x, [CASE WHEN 1 / (1 + exp(-v)) > 0.5 THEN 1 ELSE 0 END FOR v IN x] AS g FROM m)"""


def multilabel_scored(spark: SparkSession, sf: str) -> DataFrame:
    rows = I.multilabel(spark, sf)
    probabilities = F.transform("logits", lambda x: 1 / (1 + F.exp(-x)))
    return rows.select(
        "doc_id",
        shaping.multilabel_binarize(F.col("label_ids"), 2).alias("label"),
        class_metrics.multilabel_predict(probabilities).alias("prediction"),
        "logits",
    )


@query("multilabel_predict", f"WITH {_MULTI} SELECT doc_id, array_to_string(g, '|') AS prediction FROM p")
def multilabel_predict(spark: SparkSession, sf: str) -> DataFrame:
    return multilabel_scored(spark, sf).select("doc_id", bars(F.col("prediction").cast("array<string>")).alias("prediction"))


@query(
    "multilabel_f1",
    f"""WITH {_MULTI}, c AS (SELECT i, y[i] AS a, g[i] AS b FROM (SELECT y, g, unnest([1, 2]) AS i FROM p)),
    f AS (SELECT ['quality', 'toxic'][i] AS class, sum(a) AS support, CASE WHEN 2 * sum(a * b) + sum((1 - a) * b) + sum(a * (1 - b)) > 0
      THEN 2 * sum(a * b) / (2 * sum(a * b) + sum((1 - a) * b) + sum(a * (1 - b))) ELSE 0 END AS f1 FROM c GROUP BY i)
    SELECT class, round(CAST(f1 AS DOUBLE), 6) AS f1, CAST(support AS BIGINT) AS support FROM f
    UNION ALL SELECT 'macro', round(avg(CAST(f1 AS DOUBLE)), 6), CAST(sum(support) AS BIGINT) FROM f""",
)
def multilabel_f1(spark: SparkSession, sf: str) -> DataFrame:
    report = class_metrics.multilabel_f1(multilabel_scored(spark, sf), ["quality", "toxic"])
    return report.withColumn("f1", F.round("f1", 6))


@query(
    "bce_loss",
    f"""WITH {_MULTI} SELECT round(avg(greatest(v, 0) - v * a + ln(1 + exp(-abs(v)))), 6) AS loss
    FROM (SELECT x[i] AS v, y[i] AS a FROM (SELECT x, y, unnest([1, 2]) AS i FROM p))""",
)
def bce_loss(spark: SparkSession, sf: str) -> DataFrame:
    return class_metrics.bce_loss(multilabel_scored(spark, sf)).withColumn("loss", F.round("loss", 6))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per document source: the share of good documents as its score, its number as epoch."""
    docs = I.table(spark, sf, "documents", "doc_id", "source").join(I.table(spark, sf, "labels"), "doc_id")
    epoch = F.regexp_extract("source", "[0-9]+", 0).cast("int")
    return docs.groupBy(epoch.alias("epoch")).agg(F.round(F.avg("quality"), 6).alias("f1"), F.count("*").alias("n"))


@query(
    "best_run",
    """SELECT CAST(regexp_extract(source, '[0-9]+') AS INT) AS epoch, round(avg(quality), 6) AS f1, count(*) AS n
    FROM documents JOIN labels USING (doc_id) GROUP BY 1 HAVING f1 > 0 ORDER BY f1 DESC, epoch LIMIT 1""",
)
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    return class_metrics.best_run(runs(spark, sf))


@query(
    "compare_runs",
    """WITH m AS (SELECT lang, source AS dataset, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
      round(avg(quality), 6) AS v FROM documents JOIN labels USING (doc_id) GROUP BY ALL)
    SELECT dataset, split, max(v) FILTER (lang = 'de') AS de, max(v) FILTER (lang = 'en') AS en, max(v) FILTER (lang = 'es') AS es,
      max(v) FILTER (lang = 'fr') AS fr FROM m GROUP BY ALL""",
)
def compare_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = I.table(spark, sf, "documents", "doc_id", "lang", "source").join(I.table(spark, sf, "labels"), "doc_id")
    split = F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train")
    store = docs.groupBy(F.col("lang").alias("model"), F.col("source").alias("dataset"), split.alias("split")).agg(
        F.round(F.avg("quality"), 6).alias("macro_f1")
    )
    return class_metrics.compare_runs(store, ["de", "en", "es", "fr"])
