"""Single-label and multi-label classification metrics, run selection and comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    bottom = 2 * tp + fp + fn
    return F.when(bottom > 0, 2 * tp / bottom).otherwise(0.0)


def classification_metrics(predicted: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy, macro F1 and micro F1, 4 digits, per group ``by``; ``predicted`` is ``(label, prediction)``.

    Macro F1 is the mean over classes that occur as label or prediction. Everything after the first aggregate is as
    small as the confusion matrix.
    """
    by = by or []
    confusion = predicted.groupBy(*by, "label", "prediction").agg(F.count("*").alias("n"))
    hit = F.col("label") == F.col("prediction")
    zero = F.lit(0)
    as_label = F.struct(
        F.col("label").alias("cls"), F.when(hit, F.col("n")).otherwise(0).alias("tp"), zero.cast("long").alias("fp"),
        F.when(hit, 0).otherwise(F.col("n")).alias("fn"),
    )
    as_guess = F.struct(
        F.col("prediction").alias("cls"), zero.cast("long").alias("tp"), F.when(hit, 0).otherwise(F.col("n")).alias("fp"),
        zero.cast("long").alias("fn"),
    )
    sides = confusion.select(*by, F.inline(F.array(as_label, as_guess)))
    classes = sides.groupBy(*by, "cls").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    rate = F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))
    return classes.groupBy(*by).agg(
        F.bround(rate, 4).alias("accuracy"),
        F.bround(F.avg(_f1(F.col("tp"), F.col("fp"), F.col("fn"))), 4).alias("macro_f1"),
        F.bround(rate, 4).alias("micro_f1"),
    )


def multilabel_predict(probabilities: Column, threshold: float = 0.5) -> Column:
    """0/1 predictions, strictly above the threshold."""
    return F.transform(probabilities, lambda p: (p > threshold).cast("int"))


def multilabel_f1(predicted: DataFrame, class_names: list[str]) -> DataFrame:
    """F1 per class and, as class ``macro``, their mean; ``predicted`` is ``(label, prediction)`` 0/1 arrays."""
    cells = predicted.select(F.posexplode(F.arrays_zip("label", "prediction")).alias("class_id", "cell"))
    y, p = F.col("cell.label"), F.col("cell.prediction")
    classes = cells.groupBy("class_id").agg(
        F.sum(y * p).alias("tp"), F.sum((1 - y) * p).alias("fp"), F.sum(y * (1 - p)).alias("fn"), F.sum(y).alias("support")
    )
    name = F.get(F.array(*[F.lit(n) for n in class_names]), F.col("class_id"))
    scored = classes.select(name.alias("class"), _f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"), "support")
    macro = scored.agg(F.lit("macro").alias("class"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    return scored.unionByName(macro)


def bce_loss(scored: DataFrame, logits: str = "logits", labels: str = "label") -> DataFrame:
    """Mean binary cross-entropy over rows and classes, computed from logits without overflow."""
    cell = F.zip_with(logits, labels, lambda x, y: F.greatest(x, F.lit(0.0)) - x * y + F.log1p(F.exp(-F.abs(x))))
    row_sum = F.aggregate(cell, F.lit(0.0), lambda a, v: a + v)
    return scored.agg((F.sum(row_sum) / F.sum(F.size(logits))).alias("loss"))


def best_run(runs: DataFrame, f1: str = "f1", epoch: str = "epoch") -> DataFrame:
    """The run with the highest positive F1; the earliest of equals."""
    best = F.max_by(F.struct("*"), F.struct(F.col(f1), -F.col(epoch)))
    return runs.where(F.col(f1) > 0).agg(best.alias("r")).where("r is not null").select("r.*")


def compare_runs(store: DataFrame, models: list[str], metric: str = "macro_f1") -> DataFrame:
    """One row per dataset and split, one column per model."""
    return store.groupBy("dataset", "split").pivot("model", models).agg(F.max(metric))
