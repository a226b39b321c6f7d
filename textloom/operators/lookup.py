"""Dictionary lookup: exact, longest prefix, longest suffix, closest spelling, and the combined rule."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.lexical import TIE_DIGITS, top_k
from textloom.operators.tiles import grid, tiles
from textloom.session import fits_broadcast, salted_join, written

FULL_SCORE = 100.0
EDITS = (2,)
"""Edit distances up to which candidates come from shared segments, rising."""

BLOCK_WORDS = 2_048
BLOCK_ENTRIES = 4_096
"""Words and entries of a pair of blocks."""

COMPARED = 256
"""Entries compared at a time, best bound first."""

BUCKETS = 64
"""Classes of characters, by code point, that are counted for the bound."""


def choices(dictionary: DataFrame, min_chars: int = 1, fold_case: bool = False) -> DataFrame:
    """Dictionary words open to approximate lookup; short ones can be left out."""
    key = F.lower("word") if fold_case else F.col("word")
    return dictionary.where(F.length("word") >= min_chars).select(key.alias("match"), "entry_rank")


def dict_exact(words: DataFrame, dictionary: DataFrame, max_meanings: int | None = None) -> DataFrame:
    """``(word, meanings, source)``; null where the word is not in the dictionary."""
    found = words.join(dictionary.select("word", "meanings", "source"), "word", "left")
    return found if max_meanings is None else found.withColumn("meanings", F.slice("meanings", 1, max_meanings))


def _affixes(words: DataFrame, *cuts: Column) -> DataFrame:
    """``(word, n, match)``: every affix of every word."""
    sized = words.withColumn("n", F.explode(F.sequence(F.lit(1), F.length("word"))))
    return sized.withColumn("match", cuts[0] if len(cuts) == 1 else F.explode(F.array(*cuts)))


def _longest(words: DataFrame, pool: DataFrame, cut: Column, skip: Column | None) -> DataFrame:
    """Longest affix of each word that is a pool entry, by equi-join on all its affixes.

    Affixes of a measured size go to the pool, which is then read once.
    """
    affixes = _affixes(words, cut)
    if skip is not None:
        affixes = affixes.where(F.coalesce(F.col("match") != skip, F.lit(True)))
    asked = affixes.select("match").distinct()
    if fits_broadcast(asked):
        # Not more entries than there are affixes.
        entries = pool.select("match").join(F.broadcast(asked), "match", "left_semi").distinct()
        hits = affixes.join(F.broadcast(entries), "match")
    else:
        hits = salted_join(affixes.select("word", "n", "match"), pool.select("match"), ["match"], "word")
    return hits.groupBy("word").agg(F.max("n").alias("n"))


def affix_entries(words: DataFrame, pool: DataFrame) -> DataFrame:
    """``(match)``: the pool entries that start or end a word; as a pool they serve both ``dict_prefix`` and ``dict_suffix``."""
    asked = _affixes(words.select("word"), *_cuts()).select("match").distinct()
    entries = pool.select("match")
    return entries.join(F.broadcast(asked) if fits_broadcast(asked) else asked, "match", "left_semi").distinct()


def _cuts() -> tuple[Column, Column]:
    """The first and the last ``n`` characters of a word."""
    head = F.substring(F.col("word"), F.lit(1), F.col("n"))
    return head, F.substring(F.col("word"), F.length("word") - F.col("n") + 1, F.col("n"))


def dict_prefix(words: DataFrame, pool: DataFrame) -> DataFrame:
    """``(word, match, score)``: the longest pool entry that starts the word."""
    head, _ = _cuts()
    best = _longest(words.select("word"), pool, head, None)
    return best.select("word", head.alias("match"), F.lit(FULL_SCORE).alias("score"))


def dict_suffix(words: DataFrame, pool: DataFrame, prefixes: DataFrame) -> DataFrame:
    """As ``dict_prefix`` at the end of the word; the entry already found as prefix is passed over."""
    known = words.select("word").join(prefixes.select("word", F.col("match").alias("prefix")), "word", "left")
    _, tail = _cuts()
    best = _longest(known, pool, tail, F.col("prefix"))
    return best.select("word", tail.alias("match"), F.lit(FULL_SCORE).alias("score"))


def edit_similarity(a: Column, b: Column) -> Column:
    return 100 * (1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def _segments(pool: DataFrame, edits: int) -> DataFrame:
    """``(size, part, piece, match, entry_rank)``: every entry longer than ``edits`` in ``edits + 1`` even segments."""
    parts = edits + 1
    cut = pool.where(F.length("match") > edits).withColumn("size", F.length("match"))
    cut = cut.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(edits))))
    begin, end = _segment(F.col("size"), F.col("part"), parts)
    return cut.select("size", "part", F.substring("match", begin + 1, end - begin).alias("piece"), "match", "entry_rank")


def _segment(size: Column, part: Column, parts: int) -> tuple[Column, Column]:
    return tuple(F.floor((part + i) * size / parts).cast("int") for i in (0, 1))


def _probes(words: DataFrame, edits: int) -> DataFrame:
    """``(word, size, part, piece)``: where a segment of an entry within ``edits`` can stand in the word."""
    length = F.length("word")
    sized = words.withColumn("size", F.explode(F.sequence(F.greatest(length - edits, F.lit(edits + 1)), F.greatest(length + edits, F.lit(edits + 1)))))
    sized = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(edits))))
    begin, end = _segment(F.col("size"), F.col("part"), edits + 1)
    placed = sized.withColumn("begin", begin).withColumn("n", end - begin).where(F.col("n") <= length)
    first = F.least(F.greatest(F.col("begin") - edits, F.lit(0)), length - F.col("n"))
    last = F.greatest(F.least(F.col("begin") + edits, length - F.col("n")), first)
    at = placed.withColumn("at", F.explode(F.sequence(first, last)))
    return at.select("word", "size", "part", F.substring("word", F.col("at") + 1, F.col("n")).alias("piece")).distinct()


def _near(words: DataFrame, pool: DataFrame, edits: int) -> DataFrame:
    """All pool entries longer than ``edits`` within that distance: one of their segments stands in the word unchanged."""
    hits = salted_join(_segments(pool, edits), _probes(words, edits), ["size", "part", "piece"], "match")
    pairs = hits.select("word", "match", "entry_rank").distinct()
    close = pairs.where(F.levenshtein("word", "match", edits) >= 0)
    return close.withColumn("score", edit_similarity(F.col("word"), F.col("match")))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of a zero-padded matrix of code points, and their lengths."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    width = max(int(sizes.max(initial=0)), 1)
    return np.array(words, f"U{width}").view(np.uint32).reshape(len(words), width), sizes


def _histograms(grid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many characters of each word fall in each of ``BUCKETS`` classes."""
    rows, columns = np.nonzero(np.arange(grid.shape[1]) < sizes[:, None])
    cells = rows * BUCKETS + grid[rows, columns] % BUCKETS
    return np.bincount(cells, minlength=len(grid) * BUCKETS).reshape(len(grid), BUCKETS).astype(np.int32)


def _distances(word: str, grid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Edit distances of one word to all rows of the grid: bits of a machine word, or of a long integer, per column."""
    if len(word) > 64:
        return np.array([_long_distance(word, row[:n].tolist()) for row, n in zip(grid, sizes.tolist())], np.int64)
    ones, size = np.uint64(1), len(word)
    places: dict[int, int] = {}
    for i, c in enumerate(word):
        places[ord(c)] = places.get(ord(c), 0) | 1 << i
    known = np.array(sorted(places), np.uint32)
    masks = np.array([*(places[c] for c in known.tolist()), 0], np.uint64)
    index = np.minimum(np.searchsorted(known, grid), len(known) - 1)
    index[known[index] != grid] = len(known)
    equal = masks[index]
    top = np.uint64(size - 1)
    plus, minus = np.full(len(grid), (1 << size) - 1, np.uint64), np.zeros(len(grid), np.uint64)
    now = np.full(len(grid), size, np.int64)
    out = now.copy()
    for j in range(int(sizes.max(initial=0))):
        eq = equal[:, j]
        across = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(across | plus), plus & across
        now += ((up >> top) & ones).astype(np.int64) - ((down >> top) & ones).astype(np.int64)
        up, down, lower = up << ones | ones, down << ones, eq | minus
        plus, minus = down | ~(lower | up), up & lower
        out = np.where(sizes == j + 1, now, out)
    return out


def _long_distance(word: str, other: list[int]) -> int:
    places: dict[int, int] = {}
    for i, c in enumerate(word):
        places[ord(c)] = places.get(ord(c), 0) | 1 << i
    whole, top = (1 << len(word)) - 1, 1 << len(word) - 1
    plus, minus, now = whole, 0, len(word)
    for c in other:
        eq = places.get(c, 0)
        across = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | ~(across | plus) & whole, plus & across
        now += bool(up & top) - bool(down & top)
        up, down, lower = (up << 1 | 1) & whole, down << 1 & whole, eq | minus
        plus, minus = down | ~(lower | up) & whole, up & lower
    return now


class Entries:
    """Entries of a block in dictionary order, and the best of them for one word after another."""

    def __init__(self, entries: list[str]) -> None:
        self.grid, self.sizes = _codes(entries)
        self.bags = _histograms(self.grid, self.sizes)

    def best(self, word: str, k: int, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` most similar entries, first of equals first; below ``least`` they may be left out.

        Characters that one side lacks, counted by class, bound the distance from below. Entries are compared in the
        order of that bound until none left can reach the ``k``-th score.
        """
        longer = np.maximum(self.sizes, len(word))
        missing = self.bags - _histograms(*_codes([word]))
        fewest = np.maximum(np.maximum(missing, 0).sum(axis=1), np.maximum(-missing, 0).sum(axis=1))
        most = np.round(100 * (1 - fewest / longer), TIE_DIGITS)
        order = np.argsort(-most, kind="stable")
        order = order[: np.searchsorted(-most[order], -least, "right")]
        places, scores = np.empty(0, np.int64), np.empty(0)
        for at in range(0, len(order), COMPARED):
            chosen = order[at : at + COMPARED]
            if len(places) == k and most[chosen[0]] < np.round(scores[-1], TIE_DIGITS):
                break
            score = 100 * (1 - _distances(word, self.grid[chosen], self.sizes[chosen]) / longer[chosen])
            places, scores = np.concatenate([places, chosen]), np.concatenate([scores, score])
            kept = np.lexsort((places, -np.round(scores, TIE_DIGITS)))[:k]
            places, scores = places[kept], scores[kept]
        return places, scores


def _scan(words: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    """Exact search over the whole pool for ``(word, worst)``, ``worst`` being a score that ``k`` entries reach, or null.

    Blocks of words meet blocks of entries; each pair of blocks gives its own best ``k`` per word.
    """
    kind = pool.schema["entry_rank"].dataType.simpleString()
    blocks = lambda df, rows: df.agg(F.greatest(F.ceil(F.count("*") / rows), F.lit(1)).cast("int")).scalar()
    none = lambda name, of: F.lit(None).cast(of).alias(name)
    asked = words.select("word", "worst", none("match", "string"), none("entry_rank", kind))
    offered = pool.select(none("word", "string"), none("worst", "double"), "match", "entry_rank")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles(batches):
            asked, offered = tile.filter(tile["asked"]), tile.filter(pc.invert(tile["asked"])).combine_chunks()
            if not offered.num_rows:
                continue
            block = Entries(offered["match"].to_pylist())
            for word, worst in zip(asked["word"].to_pylist(), asked["worst"].to_pylist()):
                places, scores = block.best(word, k, -1.0 if worst is None else worst)
                if len(places):
                    taken = offered.select(["match", "entry_rank"]).take(pa.array(places)).combine_chunks()
                    columns = [pa.array([word] * len(places)), taken["match"].chunk(0), taken["entry_rank"].chunk(0), pa.array(scores)]
                    yield pa.RecordBatch.from_arrays(columns, ["word", "match", "entry_rank", "score"])

    counts = (blocks(words, BLOCK_WORDS), blocks(pool, BLOCK_ENTRIES))
    rows = grid(asked, offered, ("word", "match"), counts, ["entry_rank"])
    return rows.mapInArrow(scan, f"word string, match string, entry_rank {kind}, score double")


def dict_fuzzy_topk(words: DataFrame, pool: DataFrame, k: int) -> DataFrame:
    """``(word, match, score, rank)``: the ``k`` most similar entries, exact; equal scores in dictionary order.

    Entries within ``EDITS`` edits come from joins on segments, one after the other for the words that need more. Any
    other entry differs from a word of length L by d > ``EDITS`` edits and is at most L + d long, so its similarity is
    at most 100 * L / (L + d). A word whose k-th score beats that bound is finished. Only the others are compared with
    the pool, and there only with entries whose characters allow the k-th score.
    """
    order = [F.round("score", TIE_DIGITS).desc(), F.col("entry_rank").asc()]
    columns = ["word", "match", "score", "rank"]
    rest = words.select("word").where(F.col("word") != "").distinct().withColumn("worst", F.lit(None).cast("double"))
    parts = []
    for edits in EDITS:
        near = written(top_k(_near(rest.select("word"), pool, edits), k, "word", order).select(*columns), "near")
        found = near.groupBy("word").agg(F.count("*").alias("n"), F.min(F.round("score", TIE_DIGITS)).alias("kth"))
        found = rest.select("word").join(found.where(F.col("n") >= k), "word", "left").withColumnRenamed("kth", "worst")
        bound = 100 * F.length("word") / (F.length("word") + edits + 1)
        # Entries of at most ``edits`` characters have no segments, and are near words of up to twice that.
        finished = (F.length("word") > 2 * edits) & (F.col("worst") > bound + 1e-6)
        split = written(found.select("word", "worst", F.coalesce(finished, F.lit(False)).alias("finished")), "asked")
        parts.append(near.join(split.where("finished"), "word", "left_semi"))
        rest = split.where("not finished").select("word", "worst")
    parts.append(top_k(_scan(rest, pool, k), k, "word", order).select(*columns))
    return reduce(DataFrame.unionByName, parts)


def dict_lookup(
    words: DataFrame, dictionary: DataFrame, per_word: int = 2, max_meanings: int = 2, min_chars: int = 1
) -> DataFrame:
    """``(word, n, stage, match, score, meanings)``.

    The exact entry if there is one; else the first ``per_word`` of prefix, suffix and fuzzy matches. The fuzzy stage
    only sees words that the cheaper stages left short. What a stage finds is written, as later stages read it up to
    five times each, and their plans would hold its plan as often.
    """
    keyed = dictionary.select(F.col("word").alias("match"), F.slice("meanings", 1, max_meanings).alias("meanings"))
    asked = written(words.select("word").distinct(), "words")
    exact = asked.join(dictionary.select("word"), "word", "left_semi")
    missing = written(asked.join(dictionary.select("word"), "word", "left_anti"), "missing")
    pool = choices(dictionary, min_chars)
    near = written(affix_entries(missing, pool), "affixes")
    prefix = written(dict_prefix(missing, near), "prefix")
    suffix = written(dict_suffix(missing, near, prefix), "suffix")
    listed = prefix.withColumn("n", F.lit(1)).unionByName(suffix.withColumn("n", F.lit(2)))
    full = listed.groupBy("word").agg(F.count("*").alias("hits")).where(F.col("hits") >= per_word)
    fuzzy = dict_fuzzy_topk(missing.join(full, "word", "left_anti"), pool, per_word)
    fuzzy = fuzzy.join(listed, ["word", "match"], "left_anti").withColumn("n", F.col("rank") + 2).drop("rank")
    staged = listed.unionByName(fuzzy)
    picked = top_k(staged, per_word, "word", [F.col("n").asc()])
    stage = F.when(F.col("n") == 1, "prefix").when(F.col("n") == 2, "suffix").otherwise("fuzzy")
    approximate = picked.select("word", F.col("rank").alias("n"), stage.alias("stage"), "match", "score")
    direct = exact.select("word", F.lit(1).alias("n"), F.lit("exact").alias("stage"), F.col("word").alias("match"), F.lit(FULL_SCORE).alias("score"))
    return direct.unionByName(approximate).join(keyed, "match")
