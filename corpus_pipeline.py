"""A corpus from raw documents: quality, exact and near duplicates, secrets, packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textloom.llm import exact_dedup, near_dedup, packing, quality, secret_scan
from textloom.llm.support import filed, without_rows, written


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts, with the columns of ``docs``; each row is judged by its own text."""
    return quality.accepted(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the longest, then the least doc_id, null ids last, then one of the rest.

    Rows are told apart by where they lie, so null and repeated ids neither save a copy nor lose another text. Null
    and empty texts are equal. An empty table stays empty.
    """
    docs = filed(docs)
    return without_rows(docs, exact_dedup.spare_rows(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: the least doc_id, null ids last, then one of the rest.

    Rows are told apart by where they lie. Texts without words, null ones too, are in no group and stay.
    """
    docs = filed(docs)
    return without_rows(docs, near_dedup.spare_rows(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, with the secrets in its text replaced; null texts stay null."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; null texts count as empty."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify_quality),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
