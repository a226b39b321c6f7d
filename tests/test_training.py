"""Merge training in rounds against one merge at a time, and the numbers it keeps in between."""

import random
from collections import defaultdict

import numpy as np
import pytest

from textloom.functions import constants as C
from textloom.operators import training, vocabulary


def one_by_one(words, size, likelihood, least):
    """``words``: ``(word, freq)`` in order of first use."""
    splits = [([c if i == 0 else f"##{c}" for i, c in enumerate(w)], n) for w, n in words]
    vocab = sorted({u for units, _ in splits for u in units})
    while len(vocab) < size:
        pairs, uses = defaultdict(int), defaultdict(int)
        for units, n in splits:
            for u in units:
                uses[u] += n
            for pair in zip(units, units[1:]):
                pairs[pair] += n
        pairs = {p: n for p, n in pairs.items() if n >= least}
        if not pairs:
            break
        a, b = max(pairs, key=lambda p: pairs[p] / (uses[p[0]] * uses[p[1]]) if likelihood else pairs[p])
        vocab.append(a + b.removeprefix("##"))
        for units, _ in splits:
            i = 0
            while i < len(units) - 1:
                if (units[i], units[i + 1]) == (a, b):
                    units[i : i + 2] = [vocab[-1]]
                i += 1
    return vocab


def table(spark, words):
    rows = [(w, n, (i // 7, i % 7)) for i, (w, n) in enumerate(words)]
    return spark.createDataFrame(rows, "word string, freq bigint, first_seen struct<doc:bigint,pos:int>").repartition(5)


def drawn(seed, letters, count, longest, most):
    draw = random.Random(seed)
    words = {"".join(draw.choices(letters, k=draw.randint(1, longest))): draw.randint(1, most) for _ in range(count)}
    return list(words.items())


@pytest.mark.parametrize("score", ["frequency", "likelihood"])
@pytest.mark.parametrize(("tracked", "rare"), [(training.TRACKED, training.RARE), (training.TRACKED, 3), (training.TRACKED, 0), (5, training.RARE)])
def test_rounds_equal_one_merge_at_a_time(spark, monkeypatch, score, tracked, rare):
    monkeypatch.setattr(training, "TRACKED", tracked)
    monkeypatch.setattr(training, "RARE", rare)
    for seed, (letters, count, longest, most) in enumerate([("ab", 12, 9, 3), ("abcdefgh", 60, 8, 4), ("aé日#\U0001f600", 30, 7, 1), ("abcdefghijklmnopqrstuvwxyz", 80, 10, 50)]):
        words = drawn(seed, letters, count, longest, most)
        least = 2 if score == "frequency" else 1
        size = len({u for w, _ in words for u in [w[0], *("##" + c for c in w[1:])]}) + (25 if tracked == 5 else 60)
        want = C.SPECIALS_LIKELIHOOD + one_by_one(words, size, score == "likelihood", least)
        got = vocabulary.train_merges(table(spark, words), size + 5, score, min_frequency=least, checkpoint_every=9)
        assert [r.token for r in got.orderBy("token_id").collect()] == want


def test_no_words_and_no_pairs(spark):
    none = spark.createDataFrame([], "word string, freq bigint, first_seen struct<doc:bigint,pos:int>")
    for words in (none, table(spark, [("a", 3), ("b", 1)])):
        for train in (vocabulary.train_wordpiece, vocabulary.train_wordpiece_freq):
            got = train(words, 100)
            assert got.columns == ["token", "token_id"]
            assert got.count() == 5 + words.count()


def test_block_merges_runs_from_the_left():
    block = training.Block(np.array([0, 0, 0, 1, 0, 0, 1, 0], np.int32), np.array([4, 6, 8]), np.array([2, 3, 5]), np.array([10, 11, 12]))
    assert [(r["lhs"], r["rhs"], r["n"]) for r in block.merge([(0, 0, 2)], 3)] == [(0, -1, 5)]
    assert block.units.tolist() == [2, 0, 1, 2, 1, 0] and block.ends.tolist() == [3, 4, 6]
    block.drop_whole_words()
    assert block.ranks.tolist() == [10, 12]
    stats = block.stats(np.array([1, 1, 2]), np.array([True, False, False]), np.empty(0, np.int64))
    assert sorted((s["lhs"], s["rhs"], s["n"], s["rank"], s["pos"]) for s in stats) == [(0, 1, 2, 10, 2), (1, 0, 5, 12, 0), (2, 0, 2, 10, 0)]
    assert block.words_with(np.array([1 << 32])) == [{"rank": 12, "freq": 5, "units": [1, 0]}]
    block.update(np.array([9, 10, 11]), [[7], [2, 2, 2, 1], [7]])
    assert block.units.tolist() == [2, 2, 2, 1, 1, 0] and block.ends.tolist() == [4, 6]


def long_chains():
    """Words in which the best pairs share units, so that no two of the first merges can be made at once alone."""
    return drawn(11, "abcde", 150, 14, 900) + [("a" * 30, 7), ("ab" * 20, 5), ("#a##b", 900)]


@pytest.mark.parametrize(("chains", "pairs", "most"), [(10_000, 8_192, 20), (40, 8_192, None), (10_000, 2, None)])
def test_passes_by_frequency_are_few_and_whole(spark, monkeypatch, chains, pairs, most):
    monkeypatch.setattr(training, "CHAINS", chains, raising=False)
    monkeypatch.setattr(training, "PAIRS", pairs)
    monkeypatch.setattr(training, "RARE", 0)
    words = long_chains()
    passes = []
    run = type(table(spark, words)).mapInArrow
    monkeypatch.setattr(type(table(spark, words)), "mapInArrow", lambda df, *args, **more: passes.append(1) or run(df, *args, **more))
    got = vocabulary.train_merges(table(spark, words), 105, "frequency", min_frequency=2, batch=50)
    want = C.SPECIALS_LIKELIHOOD + one_by_one(words, 100, False, 2)
    assert [r.token for r in got.orderBy("token_id").collect()] == want
    assert most is None or len(passes) <= most


def test_block_chains_and_their_merges():
    block = training.Block(np.array([0, 1, 2, 0, 1, 1, 0, 1, 2], np.int32), np.array([3, 4, 9]), np.array([2, 1, 5]), np.array([10, 11, 12]))
    some = np.array([0 << 32 | 1, 1 << 32 | 2])
    rows = block.chains(np.ones(3, np.int64), some).to_pylist()
    assert sorted((np.frombuffer(r["chain"], "<i4").tolist(), r["n"], r["rank"], r["pos"]) for r in rows) == [([0, 1, 2], 7, 10, 0)]
    block.merge_chains(some, [[(0, 1, 3)], [(3, 2, 4)]], 5)
    assert block.units.tolist() == [4, 0, 1, 1, 4] and block.ends.tolist() == [1, 2, 5]


def test_statistics_are_columns():
    block = training.Block(np.arange(1000, dtype=np.int32), np.array([1000]), np.array([1]), np.array([0]))
    stats = block.stats(np.ones(1000, np.int64), None, np.empty(0, np.int64))
    assert stats.nbytes <= 28 * len(stats) and block.row(stats, [])["stats"][0].as_py()[7] == {"lhs": 7, "rhs": 8, "n": 1, "rank": 0, "pos": 7}
