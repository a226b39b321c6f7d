"""Readers for columnar, JSON and line-oriented inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from textloom.functions import constants as C

EXAMPLE = "struct<za:string,zh:string,related_words:map<string,string>>"
RULE_SCHEMA = f"rule_id bigint, grammar_description string, examples array<{EXAMPLE}>"
ITEM_SCHEMA = "id string, za string, zh string, source string, related_words map<string,string>"


def read_table(spark: SparkSession, path: str, *columns: str | Column) -> DataFrame:
    """Parquet scan of the named columns; a scan with fewer splits than cores is spread over the cores.

    A large table has more splits than cores, so its rows are never moved here.
    """
    df = spark.read.parquet(path)
    df = df.select(*columns) if columns else df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def scan_split(spark: SparkSession, path: str, split: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of one split of a table partitioned by ``split``; other partitions are not read."""
    return spark.read.parquet(path).where(F.col("split") == split).select(*(columns or ["text", "label"]))


def read_json_array(spark: SparkSession, path: str, schema: str | ty.StructType) -> DataFrame:
    """Files that each hold one JSON array of objects."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def in_file_order(rows: DataFrame, name: str, by_file: bool = False) -> DataFrame:
    """Adds ``name``: the position of each row of a file scan from 0, in its file or over files in order of their paths.

    Rows of one block of a file are read one after another, so a position is the number of rows in earlier blocks plus
    the place in the block. Only one row per block is gathered; the rows themselves do not move.
    """
    placed = rows.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"))
    placed = placed.withColumn("_seen", F.monotonically_increasing_id())
    blocks = placed.groupBy("_path", "_block").agg(F.count("*").alias("_rows"), F.min("_seen").alias("_first"))
    order = Window.partitionBy("_path").orderBy("_block") if by_file else Window.orderBy("_path", "_block")
    before = F.sum("_rows").over(order) - F.col("_rows")
    starts = blocks.select("_path", "_block", "_first", before.alias("_before"))
    position = (F.col("_before") + F.col("_seen") - F.col("_first")).alias(name)
    return placed.join(starts, ["_path", "_block"]).select(position, *rows.columns)


def read_parallel(spark: SparkSession, path: str, src_lang: str, tgt_lang: str, position: str | None = "line") -> DataFrame:
    """Parallel corpus ``(pair_id, src, tgt, source)`` from ``.jsonl``, ``.json`` or a folder of either.

    ``position`` names the field that holds the position of a pair; None numbers the pairs as the files have them.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1]
    if suffix not in ("json", "jsonl"):
        raise NotImplementedError(f"unsupported corpus format: {path}")
    numbered = f"`{position}` bigint, " if position else ""
    schema = f"{numbered}`{src_lang}` string, `{tgt_lang}` string, source string"
    raw = spark.read.schema(schema).option("multiLine", suffix == "json").json(path)
    source = F.coalesce("source", F.lit("n/a")) if suffix == "jsonl" else F.col("source")
    rows = raw if position else in_file_order(raw, "_position")
    return rows.select(
        F.col(position or "_position").alias("pair_id"),
        F.col(src_lang).alias("src"),
        F.col(tgt_lang).alias("tgt"),
        source.alias("source"),
    )


def load_dictionary(entries: DataFrame) -> DataFrame:
    """One row per word: the last entry's meanings and source, the first entry's position.

    ``entries`` is ``(word, meanings, source, entry_rank)``.
    """
    return entries.groupBy("word").agg(
        F.max_by(F.struct("meanings", "source"), "entry_rank").alias("last"), F.min("entry_rank").alias("entry_rank")
    ).select("word", "last.meanings", "last.source", "entry_rank")


def resolve_text_column(df: DataFrame, candidates: list[str] | None = None) -> DataFrame:
    """Rename the first known text column to ``text`` and drop its nulls."""
    for name in candidates or C.TEXT_COLUMNS:
        if name in df.columns:
            others = [c for c in df.columns if c not in (name, "text")]
            return df.select(*others, F.col(name).alias("text")).where(F.col("text").isNotNull())
    raise ValueError(f"no text column among {df.columns}")


def explode_examples(rules: DataFrame) -> DataFrame:
    """All examples of all rules, identified by rule and position."""
    return rules.select("rule_id", F.posexplode("examples").alias("pos", "example")).select("rule_id", "pos", "example.*")


def skip_empty(items: DataFrame, column: str = "za") -> DataFrame:
    """Drop items without a source sentence."""
    return items.where(F.length(column) > 0)
