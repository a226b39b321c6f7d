"""Stages of the pipeline on odd rows, and the links that a tile of near copies gives."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import brute_near
from textloom.llm import near_dedup
from textloom.llm.support import filed, written

NEAR = " ".join(f"word{i}" for i in range(200))
ROWS = [
    (1, "same text"), (None, "same  text"), (None, "other text"), (2, "same\ttext"), (2, "another"), (2, "another"), (3, "anothe r"), (None, None), (4, ""),
    (None, NEAR), (5, NEAR + " a"), (5, NEAR + " b"), (None, NEAR + " c"), (6, "quite apart"), (6, "Quite apart"),
]
COLUMNS = "doc_id bigint, text string, row string, file string, place int, whole string, node string, root string, n int, `group` string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "r", "f", 1, "w", "n", "o", 2, "g") for i, t in rows], COLUMNS).repartition(3)


def kept(df):
    assert df.columns == ["doc_id", "text", "row", "file", "place", "whole", "node", "root", "n", "group"]
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_exact_stage_keeps_one_row_of_each_text(spark):
    import corpus_pipeline

    left = kept(corpus_pipeline.drop_exact_copies(spark, table(spark, ROWS), ""))
    texts = Counter("".join((t or "").split()) for _, t in left.elements())
    assert texts == Counter({"".join((t or "").split()) for _, t in ROWS})
    assert left[None, "same  text"] == 1 and left[3, "anothe r"] == 1 and left[4, ""] == 1


def test_near_stage_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    left = kept(corpus_pipeline.drop_near_copies(spark, table(spark, ROWS), ""))
    assert sum(n for (_, t), n in left.items() if t and t.startswith(NEAR)) == 1
    assert left[5, NEAR + " a"] + left[5, NEAR + " b"] == 1
    assert left[2, "another"] == 1 and left[1, "same text"] == 1 and left[None, "same  text"] == 0
    assert left[6, "quite apart"] + left[6, "Quite apart"] == 1 and left[None, "other text"] == 1
    assert left[None, None] == 1 and left[4, ""] == 1


def test_stages_on_an_empty_table(spark):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, []), "").collect() == []


@pytest.mark.parametrize("blocks", [1, 2])
def test_a_tile_gives_fewer_links_than_members(spark, blocks):
    rows = [(i, f"{NEAR} end{i}") for i in range(400)]
    docs = filed(spark.createDataFrame(rows, "doc_id bigint, text string"))
    nodes = written(near_dedup._described(docs, 5), "nodes")
    place = F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")
    key = [F.lit(1).cast("long").alias("value"), F.lit(0).alias("low"), F.lit(blocks - 1).alias("high")]
    tiles = nodes.select(*key, place.alias("block"), "node", F.col("node").alias("root"))
    links = near_dedup._tile_links(tiles, docs, nodes.select("node", "row"), 5, 80)
    assert links.count() == 399
    assert near_dedup.components(nodes, links).select("root").distinct().count() == 1
    assert len({c for _, _, c, _ in brute_near(rows, 5, 80)}) == 1
