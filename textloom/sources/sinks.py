"""Writers for submissions, logs, vocabularies and the metrics store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_submission(df: DataFrame, path: str) -> None:
    """CSV ``id,translation`` with a header; fields may hold quotes and newlines."""
    df.select("id", "translation").write.mode("overwrite").option("header", True).options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def read_submission(spark: SparkSession, path: str) -> DataFrame:
    options = {"header": True, "escape": '"', "multiLine": True}
    return spark.read.schema("id string, translation string").options(**options).csv(path)


def write_log(df: DataFrame, path: str) -> None:
    """Result log as JSON lines in UTF-8; null fields are kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    """Token file in id order (``tokens``) and id map as JSON lines (``ids``)."""
    ordered = vocab.orderBy("token_id")
    ordered.select("token").write.mode("overwrite").text(f"{path}/tokens")
    ordered.select("token", "token_id").write.mode("overwrite").json(f"{path}/ids")


def upsert_metrics(store: DataFrame, new: DataFrame) -> DataFrame:
    """Replace the cells (model, dataset) present in ``new``, keep all others."""
    kept = store.join(F.broadcast(new.select("model", "dataset").distinct()), ["model", "dataset"], "left_anti")
    return kept.unionByName(new)


def write_metrics(new: DataFrame, path: str) -> None:
    """Upsert on disk: only the partitions (model, dataset) present in ``new`` are rewritten."""
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "dataset").parquet(path)
