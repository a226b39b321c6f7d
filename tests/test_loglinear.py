"""Vectors of the classifier against the weights of the operator, and its predictions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from textloom.operators import features

ROWS = [(1, "red red apple tree", 0), (2, "green apple", 0), (3, "blue sky, red sky", 1), (4, None, 1), (5, "", 0), (6, "sky sky sky", 1), (None, "red apple", 0)]


def test_vectors_have_the_weights_of_tfidf(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, label int")
    counts = features.term_counts(docs, F.col("text"))
    vocabulary = features.term_vocabulary(counts, 6)
    numbers = vocabulary.select("term", (F.row_number().over(Window.orderBy("term")) - 1).alias("i"))
    weights = features.tfidf(counts, vocabulary, F.lit(7.0)).join(numbers, "term").where("doc_id is not null")
    want = sorted((r.doc_id, r.i, round(r.weight, 9)) for r in weights.collect())
    listed = sorted((r.term, r.df) for r in vocabulary.collect())
    rows = features.tfidf_vectors(docs, listed, 7).collect()
    got = sorted((r.doc_id, int(i), round(float(w), 9)) for r in rows for i, w in zip(r.features.indices, r.features.values))
    assert got == want and len(rows) == 7 and all(r.features.size == 6 for r in rows)
    assert [r.features.size for r in features.tfidf_vectors(docs, [], 7).collect()] == [0] * 7


def test_documents_are_not_shuffled_for_their_vectors(spark):
    docs = spark.createDataFrame([r for r in ROWS if r[0] is not None], "doc_id long, text string, label int")
    predicted = features.loglinear(docs, docs.where("doc_id < 4"))
    plan = predicted._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert sorted((r.doc_id, r.prediction) for r in predicted.where("split = 'test'").collect()) == [(1, 0), (2, 0), (3, 1)]
