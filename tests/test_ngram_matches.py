"""Clipped n-gram matches of many rows at a time against counters, and what the plans of the metrics are made of."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textloom.operators import translation_metrics as M


def counted(pred, ref, n):
    p, r = (Counter(tuple(side[i : i + n]) for i in range(len(side) - n + 1)) for side in (pred, ref))
    return sum((p & r).values()), sum(p.values()), sum(r.values())


@pytest.mark.parametrize("at_once", [1, 40, 1 << 19])
def test_matches_are_those_of_counters(spark, monkeypatch, at_once):
    monkeypatch.setattr(M, "TOKENS_AT_ONCE", at_once)
    draw = random.Random(5)
    text = lambda: "".join(draw.choices("abé日\U0001f600", k=draw.randint(0, 14)))
    rows = [(i, text(), text(), text().split("b"), text().split("b")) for i in range(60)] + [(60, "", "", [], []), (None, "aaaa", "aa", ["a"], [])]
    frame = spark.createDataFrame(rows, "id long, p string, r string, pw array<string>, rw array<string>").coalesce(1)
    got = M._with_matches(frame, [("p", "r", 6), ("pw", "rw", 2)])
    assert got.columns[0] == "id" and not {"p", "r", "pw", "rw"} & set(got.columns)
    want = [(i, *(x for n in range(1, 7) for x in counted(p, r, n)), *(x for n in (1, 2) for x in counted(pw, rw, n))) for i, p, r, pw, rw in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_no_row_is_taken_apart_by_interpreted_functions(spark):
    rows = spark.createDataFrame([("a b", "a c", "easy")], "pred string, gold string, source string")
    for found in (M.char_bleu(rows), M.chrf(rows), M.chrf(rows, word_order=2), M.metrics_by_level(rows)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "array_intersect" not in plan and "MapInArrow" in plan


def test_a_long_row_counts_whole(spark):
    pred, gold = "ab" * 150_000, "ba" * 150_000
    rows = spark.createDataFrame([(pred, gold)], "pred string, gold string")
    matches = M._with_matches(rows.select(F.col("pred").alias("p"), F.col("gold").alias("r")), [("p", "r", 2)]).first()
    assert matches.m_0 == 300_000 and matches.m_1 == 299_998 and matches.p_1 == 299_999
