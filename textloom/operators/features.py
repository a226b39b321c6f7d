"""TF-IDF features, class weights and the log-linear classifier."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions import text as T
from textloom.session import fits_broadcast, small_side


def feature_words(text: Column, stop_words: list[str] | None = None) -> Column:
    """Lowered tokens of two or more word characters, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(C.STOP_WORDS if stop_words is None else stop_words))


def _terms(words: str) -> Column:
    """A column of words with their neighbouring pairs after them."""
    pairs = F.zip_with(
        F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.size(words) + 1), lambda a, b: F.concat_ws(" ", a, b)
    )
    return F.concat(words, pairs)


def term_counts(docs: DataFrame, text: Column, id_col: str = "doc_id", stop_words: list[str] | None = None) -> DataFrame:
    """``(doc_id, term, tf)`` of unigrams and bigrams, counted inside each row."""
    words = docs.select(F.col(id_col).alias("doc_id"), feature_words(text, stop_words).alias("w"))
    ordered = words.select("doc_id", F.sort_array(_terms("w")).alias("ordered"))
    runs = ordered.select("doc_id", T.count_runs(F.col("ordered")).alias("runs"))
    rows = runs.select("doc_id", F.inline_outer("runs")).where(F.col("token").isNotNull())
    return rows.withColumnRenamed("token", "term")


def term_vocabulary(counts: DataFrame, max_features: int = 50000) -> DataFrame:
    """``(term, total, df)`` of the terms with the highest total count; equal counts in term order."""
    terms = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
    return terms.orderBy(F.desc("total"), "term").limit(max_features)


def tfidf(counts: DataFrame, vocabulary: DataFrame, n_docs: Column) -> DataFrame:
    """``(doc_id, term, weight)``: sublinear tf, smooth idf plus one, rows of unit length.

    ``vocabulary`` has at most ``max_features`` rows; it is broadcast once measured to fit.
    """
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    # Measured and then joined; at most max_features rows.
    weighted = vocabulary.select("term", idf.alias("idf")).persist()
    raw = counts.join(small_side(weighted), "term").select("doc_id", "term", ((F.log("tf") + 1) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.select("doc_id", "term", (F.col("w") / norm).alias("weight"))


def tfidf_features(docs: DataFrame, text: Column, max_features: int = 50000, id_col: str = "doc_id") -> DataFrame:
    counts = term_counts(docs, text, id_col)
    n_docs = docs.agg(F.count("*").cast("double")).scalar()
    return tfidf(counts, term_vocabulary(counts, max_features), n_docs)


def class_weights(labelled: DataFrame, label: str = "label") -> DataFrame:
    """``(label, weight)`` with ``n / (classes * count)``."""
    counts = labelled.groupBy(label).agg(F.count("*").alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    weight = totals.select("rows").scalar() / (totals.select("classes").scalar() * F.col("n"))
    return counts.select(label, weight.alias("weight"))


@F.udf(returnType=VectorUDT(), useArrow=False)
def _sparse(size: int, entries: list) -> object:
    return Vectors.sparse(size, [(e["i"], e["w"]) for e in entries])


def assemble(weights: DataFrame, term_ids: DataFrame, size: int) -> DataFrame:
    """``(doc_id, features)`` sparse vectors; ``term_ids`` is ``(term, i)``."""
    rows = weights.join(small_side(term_ids), "term")
    return rows.groupBy("doc_id").agg(
        _sparse(F.lit(size), F.array_sort(F.collect_list(F.struct("i", F.col("weight").alias("w"))))).alias("features")
    )


def tfidf_vectors(docs: DataFrame, vocabulary: list[tuple[str, int]], n_docs: int) -> DataFrame:
    """``(doc_id, label, features)`` of ``(doc_id, text, label)``: the weights of ``tfidf``, made where the documents lie.

    ``vocabulary`` is ``(term, df)`` in order. A document with a null id has no features.
    """
    if not vocabulary:
        return docs.select("doc_id", "label", _sparse(F.lit(0), F.array().cast("array<struct<i:int,w:double>>")).alias("features"))
    idf = np.log((n_docs + 1) / (np.array([df for _, df in vocabulary], float) + 1)) + 1

    @F.udf(returnType=VectorUDT(), useArrow=False)
    def weighted(counts: SparseVector) -> SparseVector:
        weights = (np.log(counts.values) + 1) * idf[counts.indices]
        return SparseVector(counts.size, counts.indices, weights / np.sqrt(weights @ weights) if len(weights) else weights)

    words = docs.select("doc_id", "label", F.when(F.col("doc_id").isNotNull(), feature_words(F.col("text"))).alias("w"))
    terms = words.select("doc_id", "label", F.coalesce(_terms("w"), T.no_tokens()).alias("terms"))
    counter = CountVectorizerModel.from_vocabulary([term for term, _ in vocabulary], "terms", "counts")
    return counter.transform(terms).select("doc_id", "label", weighted("counts").alias("features"))


def loglinear_fit(train: DataFrame, c: float = 4.0, max_iter: int = 1000, tol: float = 1e-4) -> LogisticRegressionModel:
    """Balanced multinomial logistic regression on ``(features, label)``.

    Balanced weights sum to the row count, so ``regParam = 1 / (c * rows)`` states the same objective.
    """
    weights = class_weights(train)
    weighted = train.join(F.broadcast(weights) if fits_broadcast(weights) else weights, "label")
    model = LogisticRegression(
        family="multinomial",
        regParam=1.0 / (c * train.count()),
        elasticNetParam=0.0,
        standardization=False,
        weightCol="weight",
        maxIter=max_iter,
        tol=tol,
    )
    return model.fit(weighted)


def loglinear(train_docs: DataFrame, test_docs: DataFrame, max_features: int = 50000, c: float = 4.0, max_iter: int = 1000) -> DataFrame:
    """Fit on ``(doc_id, text, label)`` and predict both sets: ``(doc_id, split, label, prediction)``."""
    # At most max_features rows, numbered in the order of the terms.
    vocabulary = term_vocabulary(term_counts(train_docs, F.col("text")), max_features).select("term", "df").collect()
    vocabulary = sorted((r.term, r.df) for r in vocabulary)
    n_train = train_docs.count()
    train = tfidf_vectors(train_docs, vocabulary, n_train).persist()
    model = loglinear_fit(train, c, max_iter)
    test = tfidf_vectors(test_docs, vocabulary, n_train)
    sets = train.select(F.lit("train").alias("split"), "*").unionByName(test.select(F.lit("test").alias("split"), "*"))
    return model.transform(sets).select("doc_id", "split", "label", F.col("prediction").cast("int").alias("prediction"))
