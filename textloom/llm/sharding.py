"""Sharding by a hierarchical weighted hash tree: region, rack and shard levels of weighted draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.support import written

Tree = dict[int, dict[int, dict[int, float]]]

# Region to rack to shard to weight.
EIGHT: Tree = {0: {0: {0: 1.0, 1: 1.0}, 1: {2: 1.0, 3: 1.0}}, 1: {0: {4: 1.0, 5: 1.0}, 1: {6: 1.0, 7: 1.0}}}


def grown(tree: Tree) -> Tree:
    """One more shard, in a region of its own: only draws against that region change, so it alone takes rows."""
    shards = [s for racks in tree.values() for rack in racks.values() for s in rack]
    return tree | {max(tree) + 1: {0: {max(shards) + 1: 1.0}}}


def _draw(key: Column, path: str, weights: dict[int, float]) -> Column:
    """The child with the largest ``ln(u) / weight``; ``u`` in (0, 1] is hashed from key and child alone.

    A child's draw does not depend on its siblings, so a changed weight moves keys only to or from that child.
    """
    draws = []
    for child, weight in weights.items():
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(f"{path}/{child}")), 11) + 1) / F.lit(float(2**53))
        draws.append(F.struct((F.log(u) / F.lit(weight)).alias("draw"), F.lit(child).alias("child")))
    return F.greatest(*draws)["child"] if len(draws) > 1 else draws[0]["child"]


def place(key: Column, tree: Tree) -> Column:
    """The shard of ``key``: a draw among regions, then among the racks of the region, then among its shards."""
    total = lambda node: sum(map(total, node.values())) if isinstance(node, dict) else node

    def choose(options: Column, results: dict[int, Column]) -> Column:
        out = F.lit(None).cast("int")
        for child, result in results.items():
            out = F.when(options == child, result).otherwise(out)
        return out

    by_region = {}
    for region, racks in tree.items():
        by_rack = {k: _draw(key, f"{region}/{k}", shards) for k, shards in racks.items()}
        by_region[region] = choose(_draw(key, f"{region}", {k: total(s) for k, s in racks.items()}), by_rack)
    return choose(_draw(key, "", {r: total(x) for r, x in tree.items()}), by_region)


def shard_documents(docs: DataFrame, tree: Tree | None = None, bucket_rows: int = 20_000) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row of ``docs``.

    Rows with a null id share one shard; null texts have size 1 and the checksum of no bytes. Repeated rows take slots
    of their own. Other columns are left out. Slots are numbered within buckets and shifted by the buckets before, so
    no task sees a whole shard; a bucket is a hash of the row's place, so equal ids spread too.
    """
    tree = tree or EIGHT
    key = F.col("doc_id").cast("long")
    data = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(data) + F.lit(1)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.lit("key").alias("law"),
        place(key, tree).alias("shard"),
        place(key, grown(tree)).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_place"),
    )
    rows = written(rows, "shards")
    buckets = max(8, -(-rows.count() // bucket_rows))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64("_place"), F.lit(buckets)))
    counts = rows.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    # One row for each bucket and shard.
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy("shard", "_bucket").orderBy("_place")
    numbered = rows.withColumn("_row", F.row_number().over(within) - 1)
    return numbered.join(starts, ["shard", "_bucket"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", (F.col("_start") + F.col("_row")).cast("long").alias("slot"), "grown_shard"
    )
