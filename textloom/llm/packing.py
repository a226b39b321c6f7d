"""Packing of documents into sequences: best fit, then swap-based local search between underfull bins."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, in_batches, keyed_texts, written
from textloom.llm.tokens import packed_encoder

GROUP = 20_000
"""Pieces that one task packs."""

REOPEN = 0.98
"""Bins filled below this share go on to the next round, if a remaining piece would fit."""

SHRINK = 0.75
"""At most this share of a round's pieces goes on to the next one."""

PIECE = "doc_id bigint, piece int, start bigint, length bigint, ids binary"


def token_pieces(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: whole texts as ids and the end id, cut only beyond ``capacity``.

    Null and empty texts are the end id alone; repeated rows and null ids give pieces each; other columns are left out.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = packed_encoder(path)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for doc_id, data in zip(batch["doc_id"].to_pylist(), byte_list(batch["text"])):
                    ids = encode(data) + end
                    for n, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        yield doc_id, n, at // 4, len(part) // 4, part

        yield from in_batches(rows(), schema, lambda r: len(r[4]))

    return keyed_texts(docs).mapInArrow(run, PIECE)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of item numbers: largest items first, each into the open bin with the least sufficient gap."""
    bins: list[list[int]] = []
    gaps: list[tuple[int, int]] = []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = bisect_left(gaps, (sizes[item], -1))
        gap, b = gaps.pop(at) if at < len(gaps) else (capacity, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(item)
        if gap > sizes[item]:
            insort(gaps, (gap - sizes[item], b))
    return bins


class LocalSearch:
    """Fills underfull bins from emptier ones.

    Bins are taken fullest first. A step moves one document in, or exchanges one document of the bin for one or two
    others that fill it further. What a step takes comes from bins no fuller than the one that gains, so the sum of
    squared fills grows with each step and the search ends; bins left without documents are gone.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int) -> None:
        self.sizes, self.capacity = sizes, capacity
        self.bins = [set(b) for b in bins]
        self.fill = [sum(sizes[i] for i in b) for b in bins]
        self.bin_of = {i: n for n, b in enumerate(bins) for i in b}
        self.of_size: dict[int, set[int]] = defaultdict(set)
        self.present: list[int] = []

    def _offer(self, item: int) -> None:
        held = self.of_size[self.sizes[item]]
        if not held:
            insort(self.present, self.sizes[item])
        held.add(item)

    def _withdraw(self, item: int) -> None:
        held = self.of_size[self.sizes[item]]
        held.discard(item)
        if not held:
            self.present.pop(bisect_left(self.present, self.sizes[item]))

    def _largest(self, most: int) -> int:
        at = bisect_left(self.present, most + 1)
        return self.present[at - 1] if at else 0

    def _put(self, item: int, target: int) -> None:
        self.bins[self.bin_of[item]].discard(item)
        self.fill[self.bin_of[item]] -= self.sizes[item]
        self.bins[target].add(item)
        self.fill[target] += self.sizes[item]
        self.bin_of[item] = target

    def _take(self, size: int, skip: int | None = None) -> int:
        return next(i for i in self.of_size[size] if i != skip)

    def _home(self, out: int, taken: list[int], b: int) -> int | None:
        """The donor that gets the document of size ``out``: it fits there and the sum of squared fills grows."""
        donors = {self.bin_of[i]: 0 for i in taken}
        for i in taken:
            donors[self.bin_of[i]] += self.sizes[i]
        gained = sum(donors.values()) - out
        for home in sorted(donors, key=lambda n: -self.fill[n]):
            after = {n: self.fill[n] - lost + out * (n == home) for n, lost in donors.items()}
            growth = (self.fill[b] + gained) ** 2 - self.fill[b] ** 2 + sum(f**2 - self.fill[n] ** 2 for n, f in after.items())
            if after[home] <= self.capacity and growth > 0:
                return home
        return None

    def _step(self, b: int) -> bool:
        gap = self.capacity - self.fill[b]
        best, move = 0, None
        own = {self.sizes[i]: i for i in self.bins[b]}
        for out in (0, *own):
            one = self._largest(out + gap)
            if one - out > best:
                best, move = one - out, (out, one, 0)
            if best == gap:
                break
            # Two for one: the larger of the two from each size that could be it.
            room = out + gap
            for first in self.present[bisect_left(self.present, room // 2) : bisect_left(self.present, room)]:
                second = self._largest(room - first)
                if second == first and len(self.of_size[first]) < 2:
                    second = self._largest(first - 1)
                if second and first + second - out > best:
                    best, move = first + second - out, (out, first, second)
                    if best == gap:
                        break
            if best == gap:
                break
        if not move:
            return False
        out, first, second = move
        taken = [self._take(first)]
        if second:
            taken.append(self._take(second, taken[0]))
        home = self._home(out, taken, b)
        if home is None:
            # Two for one that leave no room for what goes out: the next best step.
            found = self._next_step(b, own)
            if not found:
                return False
            out, taken, home = found
        for item in taken:
            self._withdraw(item)
            self._put(item, b)
        if out:
            self._put(own[out], home)
            self._offer(own[out])
        return True

    def _pairs_of(self, out: int, first: int, second: int) -> Iterator[list[int]]:
        """Documents of the two sizes with most room and growth: a home as full as it may be, the other bin the emptiest."""
        for keep, other in ((first, second), (second, first)):
            homes = [i for i in self.of_size[keep] if self.fill[self.bin_of[i]] - keep + out <= self.capacity]
            if homes:
                held = max(homes, key=lambda i: self.fill[self.bin_of[i]])
                rest = [i for i in self.of_size[other] if i != held]
                if rest:
                    yield [held, min(rest, key=lambda i: self.fill[self.bin_of[i]])]
        # Both from one bin always leave room.
        bins = {self.bin_of[i]: i for i in self.of_size[first]}
        for i in self.of_size[second]:
            held = bins.get(self.bin_of[i], i)
            if held != i:
                yield [held, i]
                break

    def _next_step(self, b: int, own: dict[int, int]) -> tuple[int, list[int], int] | None:
        """``(out, taken, home)`` of the largest gain that is possible; single documents always are."""
        gap = self.capacity - self.fill[b]
        single = max(((self._largest(out + gap) - out, out) for out in (0, *own)), default=(0, 0))
        pairs = []
        for out in (0, *own):
            room = out + gap
            for first in self.present[bisect_left(self.present, room // 2) : bisect_left(self.present, room)]:
                least = max(out + max(single[0], 0) + 1 - first, 1)
                for second in self.present[bisect_left(self.present, least) : bisect_left(self.present, min(room - first, first) + 1)]:
                    pairs.append((first + second - out, out, first, second))
        for _, out, first, second in sorted(pairs, reverse=True):
            for taken in self._pairs_of(out, first, second):
                home = self._home(out, taken, b)
                if home is not None:
                    return out, taken, home
        if single[0] <= 0:
            return None
        taken = [self._take(single[0] + single[1])]
        home = self._home(single[1], taken, b)
        return None if home is None else (single[1], taken, home)

    def run(self) -> list[list[int]]:
        order = sorted((n for n, f in enumerate(self.fill) if f < self.capacity), key=lambda n: -self.fill[n])
        for n in order:
            for item in self.bins[n]:
                self._offer(item)
        # A bin that is done offers nothing; the ones after it are no fuller and only lose.
        for n in order:
            for item in self.bins[n]:
                self._withdraw(item)
            while self.bins[n] and self.fill[n] < self.capacity and self._step(n):
                pass
        return [sorted(b) for b in self.bins if b]


def pack_sizes(sizes: list[int], capacity: int) -> list[list[int]]:
    return LocalSearch(sizes, best_fit(sizes, capacity), capacity).run()


def _group_packer(capacity: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "at"], ascending=[False, True])
        at, sizes = frame["at"].tolist(), frame["length"].tolist()
        out = []
        bins = pack_sizes(sizes, capacity)
        fills = [sum(sizes[i] for i in b) for b in bins]
        least = min(range(len(bins)), key=lambda n: fills[n])
        for n, b in enumerate(bins):
            offset = 0
            for i in b:
                out.append((at[i], sizes[i], at[b[0]], offset, fills[n], n == least))
                offset += sizes[i]
        return pd.DataFrame(out, columns=["at", "length", "bin", "offset", "fill", "least"])

    return run


def pack(pieces: DataFrame, capacity: int = 4096, group: int = GROUP) -> DataFrame:
    """The rows of ``pieces`` (any columns, with ``length`` up to ``capacity``) with ``sequence_id`` and ``offset``.

    Full pieces are sequences by themselves. Others are dealt by place in the written table into groups of about
    ``group`` pieces, packed one group a task; pieces of bins that stay below ``REOPEN`` and have room for the shortest
    of these pieces meet again in fewer groups, until one group is left. Where that would leave more than ``SHRINK`` of
    a round's pieces, only the emptiest such bin of each group goes on, or none. An empty table gives an empty result.
    """
    names = [F.col(f"`{c}`") for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(F.struct(*names).alias("piece"), F.col("length").cast("long").alias("length"), F.monotonically_increasing_id().alias("at"))
    numbered = written(rows, "pieces")
    # A sequence is numbered by the place of its first piece, which is in no other.
    done = numbered.where(F.col("length") >= capacity).select("at", F.col("at").alias("bin"), F.lit(0).cast("long").alias("offset"))
    rest = numbered.where(F.col("length") < capacity).select("at", "length")
    parts, number = [done], 0
    count = rest.count()
    while count:
        groups = -(-count // group)
        dealt = rest.withColumn("_group", F.pmod(F.xxhash64("at", F.lit(number)), F.lit(groups)))
        packed = written(
            dealt.groupBy("_group").applyInPandas(_group_packer(capacity), "at bigint, length bigint, bin bigint, offset bigint, fill bigint, least boolean"), "packed"
        )
        again, most, count = F.lit(False), SHRINK * count, 0
        if groups > 1:
            under = F.col("fill") < REOPEN * capacity
            shortest = packed.where(under).agg(F.min("length")).first()[0]
            under &= F.col("fill") + F.lit(shortest) <= capacity
            for chosen, left in zip((under, under & F.col("least")), packed.agg(F.count_if(under), F.count_if(under & F.col("least"))).first()):
                if left <= most:
                    again, count = chosen, left
                    break
        parts.append(packed.where(~F.coalesce(again, F.lit(False))).select("at", "bin", "offset"))
        rest, number = packed.where(again).select("at", "length"), number + 1
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionByName(part)
    return numbered.join(placed, "at").select("piece.*", F.col("bin").alias("sequence_id"), "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)``: the packed ids of each sequence, of pieces that still have ``ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("ids"))))
    return packed.groupBy("sequence_id").agg(F.unhex(F.concat_ws("", F.transform(parts, lambda p: p["ids"]))).alias("ids"))


def pack_documents(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    pieces = token_pieces(docs, path, end_id, capacity)
    return pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")), capacity)
