"""Session helpers: shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES = 64 * 1024 * 1024
"""Largest side that is hinted for broadcast; anything above goes through a shuffle join."""

BROADCAST_MAX_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="textloom-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and not lost with an executor.

    A plan that reads it holds a scan, where a plan that reads a persisted table holds all that made it, once a use.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-distribute a compact table ahead of work that is heavy per row.

    Adaptive execution packs small shuffle outputs into few tasks; an explicit number of partitions stays as given.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` is measured to be small; reads at most ``max_rows + 1`` rows."""
    row_json_bytes = F.octet_length(F.to_json(F.struct("*")))
    rows, size = (
        df.select(row_json_bytes.alias("b")).limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum("b"), F.lit(0))).first()
    )
    return rows <= max_rows and size <= max_bytes


def small_side(df: DataFrame, **limits: int) -> DataFrame:
    """Hint ``df`` for broadcast only if it was measured to fit; otherwise leave the join to the optimizer."""
    return F.broadcast(df) if fits_broadcast(df, **limits) else df


def salted_join(big: DataFrame, other: DataFrame, on: list[str], spread_by: str, salts: int = 16) -> DataFrame:
    """Inner equi-join that survives hot keys in ``big``.

    A measured-small ``other`` is broadcast, so ``big`` is not moved at all. Beyond that size every key of
    ``big`` is spread over ``salts`` partitions by a hash of ``spread_by`` and ``other`` is repeated per salt.
    """
    if fits_broadcast(other):
        return big.join(F.broadcast(other), on)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, "_salt"]).drop("_salt")
