"""Merge training in which a round sees again only the pairs that its merges touch.

Words are kept as blocks of unit numbers. A round is one narrow pass over the blocks: it applies a run of merges and
reports, for every pair with a touched unit, its count and first place. The driver keeps the best-ranked pairs, a
number of rows bounded by ``TRACKED``, and takes from them the longest run whose order no merge of the run can change.

Where the best pairs are rare, a pass instead looks up the words that hold them, a bounded number, and the driver
merges in those by itself: such a merge changes only words, counts and places that it has. The changed words go back
to their blocks with the next pass.

By frequency a merge never makes a pair that is more frequent than the pair it came from. So the driver takes the most
frequent pairs, the candidates, and the distinct chains of units that they link in the words, with their uses: down to
the frequency of the first pair outside, all that merges change lies in the chains (``_Chained``).
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import cut_lineage, spread

TRACKED = 400_000
"""Pairs that the driver ranks; pairs ranked below them are counted again when those are used up."""

RARE = 2_000
"""Uses up to which the words of a pair are looked up."""

PAIRS = 8_192
LOOKED_UP = 100_000
"""Pairs, and uses of them all, that a pass looks up; the driver holds a few times as many words at most."""

CHAINS = 50_000
"""Distinct chains that the driver merges in; with more, fewer candidates are taken."""

BLOCK_UNITS = 1 << 18
"""Units after which a block is closed; a word is never cut."""

Pair = tuple[int, int]

_STAT = np.dtype([("lhs", "<i4"), ("rhs", "<i4"), ("n", "<i8"), ("rank", "<i8"), ("pos", "<i4")])
_STATS = pa.list_(pa.struct([("lhs", pa.int32()), ("rhs", pa.int32()), ("n", pa.int64()), ("rank", pa.int64()), ("pos", pa.int32())]))
_FOUND = pa.list_(pa.struct([("rank", pa.int64()), ("freq", pa.int64()), ("units", pa.list_(pa.int32()))]))
_ARROW = pa.schema([("units", pa.binary()), ("ends", pa.binary()), ("freqs", pa.binary()), ("ranks", pa.binary()), ("stats", _STATS), ("found", _FOUND)])
_BLOCK = ["units", "ends", "freqs", "ranks"]
_SCHEMA = """units binary, ends binary, freqs binary, ranks binary, stats array<struct<lhs:int,rhs:int,n:bigint,rank:bigint,pos:int>>,
    found array<struct<rank:bigint,freq:bigint,units:array<int>>>"""

_COUNTED = pa.schema([(name, pa.binary()) for name in _BLOCK] + [("counts", pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())])))])
_COUNTED_SCHEMA = "units binary, ends binary, freqs binary, ranks binary, counts array<struct<pair:bigint,n:bigint>>"
_CHAIN = pa.schema([("chain", pa.binary()), ("n", pa.int64()), ("rank", pa.int64()), ("pos", pa.int64())])
_CHAIN_SCHEMA = "chain binary, n bigint, rank bigint, pos bigint"

_USES = -1
"""In place of a second unit: the row counts the uses, or the replaced uses, of the first."""


class Block:
    """Words as one array of unit numbers with the words' ends, frequencies and ranks."""

    def __init__(self, units: np.ndarray, ends: np.ndarray, freqs: np.ndarray, ranks: np.ndarray) -> None:
        self.units, self.ends, self.freqs, self.ranks = units, ends, freqs, ranks

    def weights(self) -> np.ndarray:
        return np.repeat(self.freqs, np.diff(self.ends, prepend=0))

    def inner(self) -> np.ndarray:
        """Whether a unit is followed by another of its word."""
        inside = np.ones(max(len(self.units) - 1, 0), bool)
        inside[self.ends[:-1] - 1] = False
        return inside

    def uses(self) -> np.ndarray:
        """Weighted uses of every unit."""
        return _summed(self.units, self.weights())

    def keys(self, at: np.ndarray) -> np.ndarray:
        return self.units[at].astype(np.int64) << 32 | self.units[at + 1]

    def update(self, ranks: np.ndarray, units: list[list[int]]) -> None:
        """Puts other units in place of those of the words of (ascending) ``ranks`` that are in this block."""
        place = np.searchsorted(ranks, self.ranks)
        changed = place < len(ranks)
        changed[changed] = ranks[place[changed]] == self.ranks[changed]
        if not changed.any():
            return
        sizes = np.diff(self.ends, prepend=0)
        fresh = [units[i] for i in place[changed].tolist()]
        kept = self.units[~np.repeat(changed, sizes)]
        sizes[changed] = [len(x) for x in fresh]
        new = np.repeat(changed, sizes)
        self.units = np.empty(len(new), self.units.dtype)
        self.units[~new] = kept
        self.units[new] = [u for x in fresh for u in x]
        self.ends = np.cumsum(sizes)

    def merge(self, merges: list[tuple[int, int, int]], known: int) -> np.ndarray:
        """Replaces pairs of disjoint units from left to right; returns the weighted number of replacements by left unit."""
        partner, made = np.full(known, -1, np.int32), np.zeros(known, np.int32)
        for a, b, new in merges:
            partner[a], made[a] = b, new
        at = np.flatnonzero((partner[self.units[:-1]] == self.units[1:]) & self.inner())
        if not len(at):
            return np.empty(0, _STAT)
        # A unit paired with itself: every other hit of a run, from the left.
        begins = np.diff(at, prepend=-2) != 1
        since = np.arange(len(at)) - np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
        at = at[(since % 2 == 0) | (partner[self.units[at]] != self.units[at])]
        left = self.units[at]
        replaced = _summed(left, self.weights()[at])
        keep = np.ones(len(self.units), bool)
        keep[at + 1] = False
        units = self.units.copy()
        units[at] = made[left]
        self.units, self.ends = units[keep], self.ends - np.searchsorted(at, self.ends)
        return replaced

    def drop_whole_words(self) -> None:
        """Words of one unit have no pairs and never get one."""
        sizes = np.diff(self.ends, prepend=0)
        kept = sizes > 1
        if not kept.all():
            self.units = self.units[np.repeat(kept, sizes)]
            self.ends, self.freqs, self.ranks = np.cumsum(sizes[kept]), self.freqs[kept], self.ranks[kept]

    def stats(self, sizes: np.ndarray, touched: np.ndarray | None, also: np.ndarray) -> np.ndarray:
        """Count and first place of the pairs with a touched unit and of the pairs ``also`` (ascending keys); None: of all.

        Places are counted in characters, which merges do not change.
        """
        use = self.inner()
        if touched is not None:
            either = touched[self.units[:-1]] | touched[self.units[1:]]
            if len(also):
                either |= _among(self.keys(np.arange(len(use))), also)
            use &= either
        at = np.flatnonzero(use)
        if not len(at):
            return np.empty(0, _STAT)
        found, first, place = np.unique(self.keys(at), return_index=True, return_inverse=True)
        totals = np.zeros(len(found), np.int64)
        np.add.at(totals, place, self.weights()[at])
        first = at[first]
        word = np.searchsorted(self.ends, first, "right")
        before = np.cumsum(sizes[self.units]) - sizes[self.units]
        begin = np.where(word > 0, self.ends[word - 1], 0)
        return _stats(found >> 32, found & 0xFFFFFFFF, totals, self.ranks[word], before[first] - before[begin])

    def linked(self, pairs: np.ndarray) -> np.ndarray:
        """``(begins, ends)`` of the longest chains in which each two neighbours are one of ``pairs`` (ascending keys)."""
        links = np.zeros(len(self.units) + 1, np.int8)
        at = np.flatnonzero(self.inner())
        links[at[_among(self.keys(at), pairs)] + 1] = 1
        steps = np.diff(links, append=0)
        return np.stack([np.flatnonzero(steps == 1), np.flatnonzero(steps == -1) + 1])

    def chains(self, sizes: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
        """The distinct chains with their uses and first places; words, and so places, ascend in a block."""
        begins, ends = self.linked(pairs)
        word = np.searchsorted(self.ends, begins, "right")
        before = np.cumsum(sizes[self.units]) - sizes[self.units]
        pos = before[begins] - before[np.where(word > 0, self.ends[word - 1], 0)]
        names, rows = [], []
        lengths = ends - begins
        for length in np.unique(lengths).tolist():
            some = np.flatnonzero(lengths == length)
            rows_of = np.ascontiguousarray(self.units[begins[some][:, None] + np.arange(length)].astype("<i4"))
            found, first, place = np.unique(rows_of.view(np.dtype((np.void, 4 * length))).ravel(), return_index=True, return_inverse=True)
            totals = np.zeros(len(found), np.int64)
            np.add.at(totals, place, self.freqs[word[some]])
            names += [x.tobytes() for x in found]
            rows.append(np.stack([totals, self.ranks[word[some[first]]], pos[some[first]]]))
        columns = np.concatenate(rows, axis=1) if rows else np.empty((3, 0), np.int64)
        return pa.record_batch([pa.array(names, pa.binary()), *map(pa.array, columns)], schema=_CHAIN)

    def merge_chains(self, pairs: np.ndarray, groups: list[list[tuple[int, int, int]]], known: int) -> None:
        """Groups of merges one after another, all of them within the chains of ``pairs``."""
        begins, ends = self.linked(pairs)
        if not len(begins):
            return
        lengths = ends - begins
        inside = np.repeat(begins - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        part = Block(self.units[inside], np.cumsum(lengths), np.ones(len(begins), np.int64), np.arange(len(begins)))
        for group in groups:
            part.merge(group, known)
        counts = np.ones(len(self.units), np.int64)
        counts[inside] = 0
        counts[begins] = np.diff(part.ends, prepend=0)
        changed = np.zeros(len(self.units), bool)
        changed[begins] = True
        place = np.repeat(changed, counts)
        units = np.empty(len(place), self.units.dtype)
        units[place] = part.units
        changed[inside] = True
        units[~place] = self.units[~changed]
        self.units, self.ends = units, np.cumsum(counts)[self.ends - 1]

    def words_with(self, pairs: np.ndarray) -> list[dict]:
        """The words that hold one of the pairs (ascending keys)."""
        if not len(pairs):
            return []
        at = np.flatnonzero(self.inner())
        hits = np.unique(np.searchsorted(self.ends, at[_among(self.keys(at), pairs)], "right"))
        return [
            {"rank": int(self.ranks[w]), "freq": int(self.freqs[w]), "units": self.units[self.ends[w - 1] if w else 0 : self.ends[w]].tolist()}
            for w in hits.tolist()
        ]

    def blobs(self) -> list[bytes]:
        return [b.tobytes() for b in (self.units.astype("<i4"), self.ends.astype("<i8"), self.freqs.astype("<i8"), self.ranks.astype("<i8"))]

    def row(self, stats: np.ndarray, found: list[dict]) -> pa.RecordBatch:
        fields = [pa.array(np.ascontiguousarray(stats[name])) for name in _STAT.names]
        listed = pa.ListArray.from_arrays(pa.array([0, len(stats)], pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_STATS.value_type)))
        columns = [pa.array([x], f.type) for x, f in zip(self.blobs(), _ARROW)]
        return pa.record_batch([*columns, listed, pa.array([found], _FOUND)], schema=_ARROW)


def _stats(*columns: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(columns[0]), _STAT)
    for name, column in zip(_STAT.names, columns):
        out[name] = column
    return out


def _summed(units: np.ndarray, weights: np.ndarray) -> np.ndarray:
    found, place = np.unique(units, return_inverse=True)
    totals = np.zeros(len(found), np.int64)
    np.add.at(totals, place, weights)
    return _stats(found, _USES, totals, 0, 0)


def _read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """One block at a time, in the memory of its batch."""
    for batch in batches:
        for i in range(batch.num_rows):
            blobs = [batch.column(c)[i].as_buffer() for c in range(len(_BLOCK))]
            yield Block(*(np.frombuffer(x, kind) for x, kind in zip(blobs, ("<i4", "<i8", "<i8", "<i8"))))


def _among(keys: np.ndarray, some: np.ndarray) -> np.ndarray:
    if not len(some):
        return np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(some, keys), len(some) - 1)
    return some[place] == keys


def _blocks(numbers: dict[str, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ``(word_rank, freq, units)`` with the uses of all units and the statistics of all pairs."""
    letters = np.ones(len(numbers), np.int64)

    def closed(units: list[int], ends: list[int], freqs: list[int], ranks: list[int]) -> pa.RecordBatch:
        block = Block(np.array(units, np.int32), np.array(ends, np.int64), np.array(freqs, np.int64), np.array(ranks, np.int64))
        uses = block.uses()
        block.drop_whole_words()
        return block.row(np.concatenate([uses, block.stats(letters, None, np.empty(0, np.int64))]), [])

    held: tuple[list, list, list, list] = ([], [], [], [])
    for batch in batches:
        for rank, freq, units in zip(*(c.to_pylist() for c in batch.columns)):
            if not units:
                continue
            held[0].extend(map(numbers.__getitem__, units))
            held[1].append(len(held[0]))
            held[2].append(freq)
            held[3].append(rank)
            if len(held[0]) >= BLOCK_UNITS:
                yield closed(*held)
                held = ([], [], [], [])
    if held[0]:
        yield closed(*held)


class Step:
    """What a pass over the blocks does: changed words, then merges; what it reports: pairs and words."""

    def __init__(self, sizes: list[int], merges: list[tuple[int, int, int]], changed: dict[int, list[int]], also: list[Pair], wanted: list[Pair], whole: bool) -> None:
        self.sizes, self.merges, self.whole = np.array(sizes, np.int64), merges, whole
        self.ranks = np.array(sorted(changed), np.int64)
        self.units = [changed[r] for r in self.ranks.tolist()]
        self.also, self.wanted = (np.array(sorted(a << 32 | b for a, b in pairs), np.int64) for pairs in (also, wanted))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched = None
        if not self.whole:
            touched = np.zeros(len(self.sizes), bool)
            touched[[u for row in self.merges for u in row]] = True
        for block in _read_blocks(batches):
            block.update(self.ranks, self.units)
            replaced = block.merge(self.merges, len(self.sizes)) if self.merges and len(block.units) else np.empty(0, _STAT)
            block.drop_whole_words()
            yield block.row(np.concatenate([replaced, block.stats(self.sizes, touched, self.also)]), block.words_with(self.wanted))


class Words:
    """Words at the driver, with the pairs of which it holds all words (``covered``)."""

    def __init__(self, sizes: list[int]) -> None:
        self.sizes = sizes
        self.words: dict[int, tuple[int, list[int]]] = {}
        self.holding: dict[Pair, set[int]] = defaultdict(set)
        self.covered: set[Pair] = set()
        self.changed: set[int] = set()

    def add(self, rank: int, freq: int, units: list[int]) -> None:
        if rank not in self.words:
            self.words[rank] = (freq, units)
            for pair in zip(units, units[1:]):
                self.holding[pair].add(rank)

    def first(self, pair: Pair) -> tuple[int, int]:
        """First place of a covered pair."""
        rank = min(self.holding[pair])
        pos = 0
        for u, v in zip(self.words[rank][1], self.words[rank][1][1:]):
            if (u, v) == pair:
                return rank, pos
            pos += self.sizes[u]
        raise KeyError(pair)

    def merge(self, a: int, b: int, new: int) -> tuple[dict[Pair, int], int, set[tuple[Pair, int]]]:
        """Changes of pair counts, weighted replacements, and ``(pair, rank)`` of the words in which a pair became rarer.

        ``new`` is a fresh unit, so its pairs are in no other words.
        """
        change: dict[Pair, int] = defaultdict(int)
        left: set[tuple[Pair, int]] = set()
        replaced = 0
        for rank in list(self.holding[a, b]):
            freq, units = self.words[rank]
            out: list[int] = []
            i = 0
            while i < len(units):
                if units[i] == a and i + 1 < len(units) and units[i + 1] == b:
                    out.append(new)
                    replaced += freq
                    i += 2
                else:
                    out.append(units[i])
                    i += 1
            before, after = Counter(zip(units, units[1:])), Counter(zip(out, out[1:]))
            for pair, n in before.items():
                change[pair] += (after[pair] - n) * freq
                if after[pair] < n:
                    left.add((pair, rank))
                if not after[pair]:
                    self.holding[pair].discard(rank)
            for pair, n in after.items():
                if pair not in before:
                    change[pair] += n * freq
                    self.holding[pair].add(rank)
                    self.covered.add(pair)
            self.words[rank] = (freq, out)
            self.changed.add(rank)
        return {pair: n for pair, n in change.items() if n}, replaced, left

    def take_changed(self) -> dict[int, list[int]]:
        """The units of the words changed since the last call."""
        out = {rank: self.words[rank][1] for rank in self.changed}
        self.changed = set()
        return out


class Frontier:
    """The best-ranked pairs at the driver: a heap whose outdated entries are skipped, and the pairs of each unit."""

    def __init__(self, likelihood: bool, least: int, uses: dict[int, int]) -> None:
        self.likelihood, self.least, self.uses = likelihood, least, uses
        #: key and count of each pair; the place in the key of a stale pair is one that the first place cannot precede
        self.pairs: dict[Pair, tuple] = {}
        self.stale: set[Pair] = set()
        self.touching: dict[int, set] = defaultdict(set)
        self.heap: list[tuple] = []
        self.cut: tuple | None = None

    def rank(self, a: int, b: int, n: int, rank: int, pos: int) -> tuple:
        score = n / (self.uses[a] * self.uses[b]) if self.likelihood else n
        return -score, rank, pos

    def put(self, a: int, b: int, n: int, rank: int, pos: int) -> None:
        self.stale.discard((a, b))
        key = self.rank(a, b, n, rank, pos)
        if n >= self.least and (self.cut is None or key < self.cut):
            self.pairs[a, b] = (key, n)
            self.touching[a].add((a, b))
            self.touching[b].add((a, b))
            heapq.heappush(self.heap, (key, a, b))

    def drop_touching(self, units: set[int]) -> None:
        for unit in units:
            for a, b in self.touching.pop(unit, ()):
                self.stale.discard((a, b))
                if self.pairs.pop((a, b), None) is not None:
                    self.touching[b if a == unit else a].discard((a, b))

    def drop(self, a: int, b: int) -> None:
        if self.pairs.pop((a, b), None) is not None:
            self.touching[a].discard((a, b))
            self.touching[b].discard((a, b))

    def top(self) -> tuple | None:
        """The best pair, ``(key, a, b)``, taken from the heap."""
        while self.heap:
            key, a, b = heapq.heappop(self.heap)
            if self.pairs.get((a, b), (None,))[0] == key:
                return key, a, b
        return None

    def best(self, count: int) -> list[Pair]:
        """The ``count`` best pairs, which stay in the heap."""
        taken = []
        while len(taken) < count and (top := self.top()) is not None:
            taken.append(top)
        for top in taken:
            heapq.heappush(self.heap, top)
        return [(a, b) for _, a, b in taken]

    def certain_top(self) -> Pair | None:
        """The best pair, unless its place is not known and another has the same score."""
        best = self.best(2)
        if not best or (best[0] in self.stale and len(best) > 1 and self.pairs[best[0]][0][0] == self.pairs[best[1]][0][0]):
            return None
        return best[0]

    def shift(self, words: Words, a: int, b: int, new: int) -> None:
        """Merges a pair in the words that hold it, all of them at the driver, and ranks what that changes."""
        change, replaced, left = words.merge(a, b, new)
        for unit, n in ((a, -replaced), (b, -replaced), (new, replaced)):
            self.uses[unit] = self.uses.get(unit, 0) + n
        moved = set(change)
        if self.likelihood:
            moved |= self.touching[a] | self.touching[b]
        for pair in moved:
            key, n = self.pairs.pop(pair, (None, 0))
            if key is None and new not in pair:
                continue  # ranked too low to be kept, and now lower
            n += change.get(pair, 0)
            stale = pair in self.stale
            if key is not None:
                for unit in pair:
                    self.touching[unit].discard(pair)
            if n <= 0:
                self.stale.discard(pair)
            elif pair in words.covered:
                self.put(*pair, n, *words.first(pair))
            else:
                self.put(*pair, n, *key[1:])
                if pair in self.pairs and (stale or (pair, key[1]) in left):
                    self.stale.add(pair)

    def run(self, limit: int, token_of: Callable[[int, int], str], numbers: dict[str, int]) -> list[tuple[int, int, str]]:
        """The longest known run of best pairs, in order, whose merges one after another give the same as at once.

        No two share a unit. By frequency the ranking above the first pair that shares a unit stays valid: a merge
        leaves the pairs without its units as they were, and a new pair is at most as frequent as the pair it came
        from, and seen no earlier. By likelihood a merge can raise the pairs of its units; a pair is taken only while
        it scores above a bound of all of those. A pair of equal units, which can follow itself, or a token that is a
        unit already, whose pairs get more uses, ends the run.
        """
        taken: list[tuple[int, int, str]] = []
        used: set[int] = set()
        raised = _Raised(self)
        while len(taken) < limit and (best := self.top()) is not None:
            key, a, b = best
            if taken and (a in used or b in used or (self.likelihood and (self.cut is not None or -key[0] <= raised.bound))):
                heapq.heappush(self.heap, best)
                break
            token = token_of(a, b)
            taken.append((a, b, token))
            if a == b or token in numbers or any(token == t for _, _, t in taken[:-1]):
                break
            used |= {a, b}
            if self.likelihood and self.cut is None and len(taken) < limit:
                raised.add(a, b)
        return taken


class _Raised:
    """An upper bound on the likelihood score of every pair that merges of a run have touched or made."""

    def __init__(self, frontier: Frontier) -> None:
        self.frontier = frontier
        self.uses: dict[int, int] = {}
        self.as_left: dict[int, int] = {}
        self.as_right: dict[int, int] = {}
        self.bound = 0.0

    def add(self, a: int, b: int) -> None:
        old, now = self.frontier.uses, self.uses
        n = self.frontier.pairs[a, b][1]
        now[a], now[b] = old[a] - n, old[b] - n
        self.as_left[a] = self.as_right[b] = n
        for u, v in self.frontier.touching[a] | self.frontier.touching[b]:
            together = self.frontier.pairs[u, v][1]
            # What is left of u, or the token that ends in u; what is left of v, or the token that begins with v.
            for left in (now.get(u, old[u]), self.as_right.get(u, 0)):
                for right in (now.get(v, old[v]), self.as_left.get(v, 0)):
                    if left > 0 and right > 0 and (u, v) != (a, b):
                        self.bound = max(self.bound, min(together, left, right) / (left * right))


def _totals(state: DataFrame) -> DataFrame:
    rows = state.select(F.explode("stats").alias("s")).select("s.*")
    return rows.groupBy("lhs", "rhs").agg(F.sum("n").alias("n"), F.min(F.struct("rank", "pos")).alias("first")).select("lhs", "rhs", "n", "first.*")


def _ranked(frontier: Frontier, state: DataFrame) -> None:
    """Fills the frontier with the best ``TRACKED`` pairs of all; ``state`` holds the statistics of every pair."""
    pairs = _totals(state).where((F.col("n") >= frontier.least) & (F.col("rhs") != _USES))
    score = F.col("n").cast("double")
    if frontier.likelihood:
        # One row per unit: bounded by the characters and the size of the vocabulary.
        uses = state.sparkSession.createDataFrame([*frontier.uses.items()], "unit int, uses bigint")
        for side in ("lhs", "rhs"):
            pairs = pairs.join(F.broadcast(uses.toDF(side, f"{side}_uses")), side)
        score = F.col("n").cast("double") / (F.col("lhs_uses").cast("double") * F.col("rhs_uses"))
    best = pairs.orderBy(score.desc(), "rank", "pos").select("lhs", "rhs", "n", "rank", "pos").limit(TRACKED + 1).toArrow()
    rows = [*zip(*(c.to_pylist() for c in best.columns))]
    frontier.pairs, frontier.touching, frontier.heap, frontier.stale, frontier.cut = {}, defaultdict(set), [], set(), None
    if len(rows) > TRACKED:
        # Pairs outside rank no better, whatever the order of equal doubles is.
        frontier.cut = min(frontier.rank(*rows[-1]), frontier.rank(*rows[-2]))
    for row in rows[:TRACKED]:
        frontier.put(*row)


def merges(
    ordered: DataFrame, letters: list[str], size: int, token_of: Callable[[str, str], str], likelihood: bool, least: int, batch: int, checkpoint_every: int
) -> Iterator[str]:
    """Merged tokens in order, at most ``size``, from ``(word_rank, freq, units)`` whose units are all in ``letters``.

    Ranks are by score, then by first place (word rank, position). ``token_of(lhs, rhs)`` names the token of a pair.
    The blocks are kept in the shared folder after every ``checkpoint_every`` rounds of at most ``batch`` merges.
    """
    if not likelihood:
        return _Chained(ordered, letters, token_of, least, batch, checkpoint_every).tokens(size)
    return _Training(ordered, letters, token_of, Frontier(likelihood, least, {}), batch, checkpoint_every).tokens(size)


class _Training:
    """The blocks, the frontier and the words at the driver through the passes."""

    def __init__(self, ordered: DataFrame, letters: list[str], token_of: Callable[[str, str], str], frontier: Frontier, batch: int, checkpoint_every: int) -> None:
        self.numbers = {unit: i for i, unit in enumerate(letters)}
        self.names, self.sizes = list(letters), [1] * len(letters)
        self.token_of, self.frontier, self.batch, self.checkpoint_every = token_of, frontier, batch, checkpoint_every
        words = spread(ordered.select("word_rank", "freq", "units"), "word_rank").sortWithinPartitions("word_rank")
        self.state = cut_lineage(words.mapInArrow(partial(_blocks, self.numbers), _SCHEMA))
        self.older: DataFrame | None = None
        self.passes = 0
        for row in _totals(self.state).where(F.col("rhs") == _USES).collect():
            frontier.uses[row.lhs] = row.n
        _ranked(frontier, self.state)
        self.words = Words(self.sizes)

    def _name(self, a: int, b: int) -> str:
        return self.token_of(self.names[a], self.names[b])

    def _number(self, a: int, b: int, token: str) -> int:
        if token not in self.numbers:
            self.numbers[token] = len(self.names)
            self.names.append(token)
            self.sizes.append(self.sizes[a] + self.sizes[b])
        return self.numbers[token]

    def _pass(self, merges: list[tuple[int, int, int]], also: list[Pair], wanted: list[Pair], whole: bool = False) -> None:
        """One pass over the blocks; the state before it stays until the next, so that a lost part is made again."""
        step = Step(self.sizes, merges, self.words.take_changed(), also, wanted, whole)
        following = self.state.select(*_BLOCK).mapInArrow(step, _SCHEMA).persist()
        self.passes += 1
        if self.passes % self.checkpoint_every == 0:
            kept = cut_lineage(following)
            following.unpersist()
            following = kept
        if self.older is not None:
            self.older.unpersist()
        self.older, self.state = self.state, following

    def _here(self) -> str | None:
        """A merge in words that the driver holds, if the best pair allows it."""
        best = self.frontier.certain_top()
        if best is None or best not in self.words.covered or self._name(*best) in self.numbers:
            return None
        token = self._name(*best)
        self.frontier.shift(self.words, *best, self._number(*best, token))
        return token

    def _look_up(self) -> bool:
        """Brings the words of the best rare pairs to the driver; False if the best pair is not rare or its words are there."""
        if len(self.words.words) > 4 * LOOKED_UP:
            self._refresh([])
            self.words = Words(self.sizes)
        best = self.frontier.best(PAIRS)
        if not best or best[0] in self.words.covered or self.frontier.pairs[best[0]][1] > RARE:
            return False
        wanted, total = [], 0
        for pair in best:
            n = self.frontier.pairs[pair][1]
            if n <= RARE and pair not in self.words.covered and total < LOOKED_UP:
                wanted.append(pair)
                total += n
        self._refresh(wanted)
        for row in self.state.select(F.explode("found").alias("w")).select("w.*").collect():
            self.words.add(row.rank, row.freq, list(row.units))
        self.words.covered.update(wanted)
        return True

    def _refresh(self, wanted: list[Pair]) -> None:
        """A pass that brings changed words back and finds the first places that the driver does not know."""
        stale = list(self.frontier.stale)
        self._pass([], stale, wanted)
        if stale:
            for row in _totals(self.state).where(F.col("rhs") != _USES).collect():
                self.frontier.drop(row.lhs, row.rhs)
                self.frontier.put(row.lhs, row.rhs, row.n, row.rank, row.pos)

    def _round(self, limit: int) -> list[str] | None:
        """A run of merges in all blocks; None if no pair is left."""
        frontier = self.frontier
        if frontier.stale or self.words.changed:
            self._refresh([])
        self.words = Words(self.sizes)
        chosen = frontier.run(min(self.batch, limit), self._name, self.numbers)
        if not chosen and frontier.cut is None:
            return None
        merges = [(a, b, self._number(a, b, token)) for a, b, token in chosen]
        self._pass(merges, [], [])
        rows = _totals(self.state).collect() if merges else []
        replaced = {r.lhs: r.n for r in rows if r.rhs == _USES}
        for a, b, new in merges:
            n = replaced.get(a, 0)
            for unit, sign in ((a, -1), (b, -1), (new, 1)):
                frontier.uses[unit] = frontier.uses.get(unit, 0) + sign * n
        if not chosen or len(frontier.pairs) > 2 * TRACKED:
            self._pass([], [], [], whole=True)
            _ranked(frontier, self.state)
            if not chosen and not frontier.pairs:
                return None
        else:
            frontier.drop_touching({u for row in merges for u in row})
            for row in rows:
                if row.rhs != _USES:
                    frontier.put(*row)
        return [token for _, _, token in chosen]

    def tokens(self, size: int) -> Iterator[str]:
        made = 0
        while made < size:
            # A cut frontier does not see the pairs outside that a merge raises by likelihood.
            local = not (self.frontier.likelihood and self.frontier.cut is not None)
            token = self._here() if local else None
            if token is None and local and self._look_up():
                token = self._here()
            if token is not None:
                made += 1
                yield token
                continue
            done = self._round(size - made)
            if done is None:
                break
            made += len(done)
            yield from done
        for kept in (self.older, self.state):
            if kept is not None:
                kept.unpersist()


class _MergeChains:
    """A pass by frequency: merges in the chains of ``pairs``, then the counts of all pairs."""

    def __init__(self, known: int, pairs: np.ndarray, groups: list[list[tuple[int, int, int]]]) -> None:
        self.known, self.pairs, self.groups = known, pairs, groups

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read_blocks(batches):
            block.merge_chains(self.pairs, self.groups, self.known)
            block.drop_whole_words()
            at = np.flatnonzero(block.inner())
            found, place = np.unique(block.keys(at), return_inverse=True)
            totals = np.zeros(len(found), np.int64)
            np.add.at(totals, place, block.weights()[at])
            counts = pa.StructArray.from_arrays([pa.array(found), pa.array(totals)], ["pair", "n"])
            columns = [pa.array([x], pa.binary()) for x in block.blobs()]
            yield pa.record_batch([*columns, pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), counts)], schema=_COUNTED)


class _FindChains:
    def __init__(self, sizes: list[int], pairs: np.ndarray) -> None:
        self.sizes, self.pairs = np.array(sizes, np.int64), pairs

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _read_blocks(batches):
            yield block.chains(self.sizes, self.pairs)


class _Chains:
    """Chains at the driver, in the order of their first places, with the counts of their pairs."""

    def __init__(self, sizes: list[int], rows: list[tuple[bytes, int, int, int]]) -> None:
        self.sizes = sizes
        self.places = [(rank, pos) for _, _, rank, pos in rows]
        self.words = [np.frombuffer(chain, "<i4").tolist() for chain, *_ in rows]
        self.freqs = [n for _, n, *_ in rows]
        self.counts: dict[Pair, int] = defaultdict(int)
        self.holding: dict[Pair, set[int]] = defaultdict(set)
        for i, (units, n) in enumerate(zip(self.words, self.freqs)):
            for pair in zip(units, units[1:]):
                self.counts[pair] += n
                self.holding[pair].add(i)
        #: by falling count; a pair that reaches the top gets its place, and one whose count has changed is passed over
        self.heap: list[tuple] = [(-n, (-1,), pair) for pair, n in self.counts.items()]
        heapq.heapify(self.heap)

    def first(self, pair: Pair) -> tuple[int, int]:
        """First place of a pair; chains do not overlap, so it is in the first that holds the pair."""
        i = min(self.holding[pair])
        rank, pos = self.places[i]
        for left in zip(self.words[i], self.words[i][1:]):
            if left == pair:
                return rank, pos
            pos += self.sizes[left[0]]
        raise KeyError(pair)

    def top(self) -> tuple | None:
        """Key and pair of the best."""
        while self.heap:
            n, place, pair = self.heap[0]
            if self.counts[pair] != -n or not n:
                heapq.heappop(self.heap)
            elif place == (-1,):
                heapq.heapreplace(self.heap, (n, self.first(pair), pair))
            else:
                return (n, *place), pair
        return None

    def merge(self, a: int, b: int, new: int) -> None:
        changed: set[Pair] = set()
        for i in list(self.holding[a, b]):
            units, n = self.words[i], self.freqs[i]
            out: list[int] = []
            for unit in units:
                # The unit before may itself have been replaced, then it is ``new`` and starts no pair here.
                if out and unit == b and out[-1] == a:
                    out[-1] = new
                else:
                    out.append(unit)
            before, after = [*zip(units, units[1:])], [*zip(out, out[1:])]
            for pair in before:
                self.counts[pair] -= n
            for pair in after:
                self.counts[pair] += n
            for pair in set(before).difference(after):
                self.holding[pair].discard(i)
            for pair in set(after).difference(before):
                self.holding[pair].add(i)
            changed.update(before, after)
            self.words[i] = out
        for pair in changed:
            if self.counts[pair]:
                heapq.heappush(self.heap, (-self.counts[pair], (-1,), pair))


class _Chained:
    """Training by frequency, in passes that each make all merges down to the frequency of the first pair outside."""

    def __init__(self, ordered: DataFrame, letters: list[str], token_of: Callable[[str, str], str], least: int, batch: int, checkpoint_every: int) -> None:
        self.numbers = {unit: i for i, unit in enumerate(letters)}
        self.names, self.sizes = list(letters), [1] * len(letters)
        self.token_of, self.least, self.batch, self.checkpoint_every = token_of, max(least, 1), batch, checkpoint_every
        self.candidates = 16
        words = spread(ordered.select("word_rank", "freq", "units"), "word_rank").sortWithinPartitions("word_rank")
        self.state = cut_lineage(words.mapInArrow(partial(_blocks, self.numbers), _SCHEMA).select(*_BLOCK))
        self.older: DataFrame | None = None
        self.passes = 0
        self._pass(np.empty(0, np.int64), [])

    def _pass(self, pairs: np.ndarray, groups: list[list[tuple[int, int, int]]]) -> None:
        """One pass over the blocks; the state before it stays until the next, so that a lost part is made again."""
        following = self.state.select(*_BLOCK).mapInArrow(_MergeChains(len(self.names), pairs, groups), _COUNTED_SCHEMA).persist()
        self.passes += 1
        if self.passes % self.checkpoint_every == 0:
            kept = cut_lineage(following)
            following.unpersist()
            following = kept
        if self.older is not None:
            self.older.unpersist()
        self.older, self.state = self.state, following

    def _most_frequent(self) -> list[tuple[int, int]]:
        """``(pair, n)``, falling, of four times as many pairs as there are candidates, and one more."""
        rows = self.state.select(F.explode("counts").alias("c")).groupBy("c.pair").agg(F.sum("c.n").alias("n")).where(F.col("n") >= self.least)
        found = rows.orderBy(F.desc("n")).limit(4 * self.candidates + 1).toArrow()
        return [*zip(found["pair"].to_pylist(), found["n"].to_pylist())]

    def _by_place(self) -> tuple[np.ndarray, tuple]:
        """The best pairs by count and first place, with the key of the first outside; for more pairs of one count than a pass takes."""
        step = Step(self.sizes, [], {}, [], [], True)
        pairs = _totals(self.state.select(*_BLOCK).mapInArrow(step, _SCHEMA)).where((F.col("n") >= self.least) & (F.col("rhs") != _USES))
        rows = pairs.orderBy(F.desc("n"), "rank", "pos").limit(self.candidates + 1).collect()
        # With no pair outside, every pair of the least count may be taken.
        cut = (-rows[-1].n, rows[-1]["rank"], rows[-1].pos) if len(rows) > self.candidates else (0.5 - self.least,)
        return np.array(sorted(r.lhs << 32 | r.rhs for r in rows[: self.candidates]), np.int64), cut

    def _chosen(self, ranked: list[tuple[int, int]]) -> tuple[np.ndarray, tuple]:
        """Candidates, and a key before which all pairs are candidates or made from them."""
        if len(ranked) <= self.candidates:
            least = self.least
        else:
            least = ranked[self.candidates - 1][1]
            if len(ranked) > 4 * self.candidates and ranked[-1][1] == least:
                least += 1
            if ranked[0][1] < least:
                return self._by_place()
        return np.array(sorted(pair for pair, n in ranked if n >= least), np.int64), (0.5 - least,)

    def _round(self, limit: int) -> list[str]:
        """The tokens of one pass; none if no pair is left."""
        ranked = self._most_frequent()
        if not ranked:
            return []
        while True:
            pairs, cut = self._chosen(ranked)
            found = self.state.select(*_BLOCK).mapInArrow(_FindChains(self.sizes, pairs), _CHAIN_SCHEMA)
            totals = found.groupBy("chain").agg(F.sum("n").alias("n"), F.min(F.struct("rank", "pos")).alias("first"))
            rows = totals.select("chain", "n", "first.*").limit(CHAINS + 1).toArrow()
            if rows.num_rows <= CHAINS or self.candidates == 1:
                break
            self.candidates //= 2
            ranked = ranked[: 4 * self.candidates + 1]
        chains = _Chains(self.sizes, sorted(zip(*(rows[c].to_pylist() for c in rows.column_names)), key=lambda row: row[2:]))
        groups: list[list[tuple[int, int, int]]] = []
        lefts: set[int] = set()
        rights: set[int] = set()
        tokens: list[str] = []
        while len(tokens) < limit and (top := chains.top()) is not None and top[0] < cut:
            a, b = top[1]
            token = self.token_of(self.names[a], self.names[b])
            known = token in self.numbers
            if not known:
                self.numbers[token] = len(self.names)
                self.names.append(token)
                self.sizes.append(self.sizes[a] + self.sizes[b])
            new = self.numbers[token]
            # The merges of a group can be made at once: none overlaps another or needs its unit.
            if not groups or a == b or a in lefts or a in rights or b in lefts or len(groups[-1]) >= self.batch:
                groups.append([])
                lefts, rights = set(), set()
            groups[-1].append((a, b, new))
            lefts |= {a, new}
            rights |= {b, new}
            tokens.append(token)
            if a == b:
                lefts |= {a, b}
                rights |= {a, b}
            if known:
                break  # its pairs outside the chains may now be more frequent
            chains.merge(a, b, new)
        if 4 * rows.num_rows < CHAINS and len(ranked) > self.candidates:
            self.candidates = min(2 * self.candidates, 2 * PAIRS)
        self._pass(pairs, groups)
        return tokens

    def tokens(self, size: int) -> Iterator[str]:
        made = 0
        while made < size and (done := self._round(size - made)):
            made += len(done)
            yield from done
        for kept in (self.older, self.state):
            if kept is not None:
                kept.unpersist()
