"""Token-id files compressed by Re-Pair grammars, one grammar a shard, with random access by expansion length."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, in_batches, keyed_texts
from textloom.llm.tokens import packed_encoder

SHARD = 1 << 20
"""Ids after which a shard is closed; a document is never cut, so the longest one bounds memory."""

PAIRS = 512
"""Most pairs replaced in a round."""

LEAST = 16
"""Uses that a pair needs."""

GAIN = 0.02
"""A round that shortens the shard by less is the last."""

_HEAD = "<4sIIIII"
_HASH_BITS = 18


def _replace(seq: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """One round, in place: the most frequent pairs, found by hashed counts and confirmed pair by pair, become nonterminals."""
    key = seq[:-1].astype(np.uint64)
    key <<= np.uint64(32)
    key |= seq[1:]
    mixed = key * np.uint64(0x9E3779B97F4A7C15)
    mixed >>= np.uint64(64 - _HASH_BITS)
    bucket = mixed.view(np.int64)
    counts = np.bincount(bucket, minlength=1 << _HASH_BITS)
    top = np.argpartition(counts, -PAIRS)[-PAIRS:]
    top = top[counts[top] >= LEAST]
    none = np.empty((0, 2), np.uint32)
    if not len(top):
        return seq, none
    index = np.full(1 << _HASH_BITS, -1, np.int32)
    index[top[np.argsort(-counts[top], kind="stable")]] = np.arange(len(top), dtype=np.int32)
    slots = index[bucket]
    at = np.flatnonzero(slots >= 0)
    slot = slots[at]
    pair = np.zeros(len(top), np.uint64)
    pair[slot[::-1]] = key[at][::-1]
    same = key[at] == pair[slot]
    at, slot = at[same], slot[same]
    # Overlapping hits: every other one of a run, from the left.
    begins = np.concatenate([[True], np.diff(at) != 1])
    first = np.maximum.accumulate(np.where(begins, np.arange(len(at)), 0))
    free = (np.arange(len(at)) - first) % 2 == 0
    at, slot = at[free], slot[free]
    used = np.bincount(slot, minlength=len(top)) >= LEAST // 2
    at, slot = at[used[slot]], slot[used[slot]]
    number = (base + np.cumsum(used) - 1).astype(np.uint32)
    seq[at] = number[slot]
    keep = np.ones(len(seq), bool)
    keep[at + 1] = False
    rules = np.stack([pair[used] >> np.uint64(32), pair[used] & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32)
    return seq[keep], rules


def repair(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(sequence, rules, first nonterminal)``; rule ``i`` is the pair that nonterminal ``first + i`` stands for."""
    seq = ids.astype(np.uint32)
    first = int(seq.max()) + 1 if len(seq) else 0
    rules = [np.empty((0, 2), np.uint32)]
    while len(seq) > 1:
        shorter, found = _replace(seq, first + sum(map(len, rules)))
        rules.append(found)
        gain, seq = 1 - len(shorter) / len(seq), shorter
        if gain < GAIN:
            break
    return seq, np.concatenate(rules), first


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    lengths = np.ones(len(rules), np.uint32)
    for i, (a, b) in enumerate(rules.tolist()):
        lengths[i] = (lengths[a - first] if a >= first else 1) + (lengths[b - first] if b >= first else 1)
    return lengths


def pack_shard(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """Header, document table, rules, their expansion lengths, and the compressed ids of one shard."""
    ids = np.concatenate([x for _, x in docs])
    seq, rules, first = repair(ids)
    wide = first + len(rules) > 1 << 16
    head = struct.pack(_HEAD, b"RPR1", len(docs), first, len(rules), len(seq), wide)
    table = np.array([(i is not None, i or 0, len(x)) for i, x in docs], "<i8")
    lengths = expansion_lengths(rules, first)
    return b"".join([head, table.tobytes(), rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), seq.astype("<u4" if wide else "<u2").tobytes()])


class Shard:
    """Reads one shard; ``ids(n)`` expands only the symbols that cover document ``n``."""

    def __init__(self, data: bytes) -> None:
        magic, docs, self.first, rules, symbols, wide = struct.unpack_from(_HEAD, data)
        if magic != b"RPR1":
            raise ValueError("not a shard of compressed ids")
        at = struct.calcsize(_HEAD)
        self.table = np.frombuffer(data, "<i8", 3 * docs, at).reshape(-1, 3)
        at += self.table.nbytes
        self.rules = np.frombuffer(data, "<u4", 2 * rules, at).reshape(-1, 2)
        at += self.rules.nbytes
        self.lengths = np.frombuffer(data, "<u4", rules, at)
        at += self.lengths.nbytes
        self.seq = np.frombuffer(data, "<u4" if wide else "<u2", symbols, at)
        terminal = self.seq < self.first
        index = np.where(terminal, 0, self.seq.astype(np.int64) - self.first)
        sizes = np.where(terminal, 1, self.lengths[index] if rules else 1)
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.starts = np.cumsum(self.table[:, 2]) - self.table[:, 2]
        self.flat, self.offsets = self._expansions()

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        made: list[np.ndarray] = []
        for a, b in self.rules.tolist():
            made.append(np.concatenate([made[x - self.first] if x >= self.first else np.array([x], np.uint32) for x in (a, b)]))
        offsets = np.cumsum(self.lengths, dtype=np.int64) - self.lengths
        return (np.concatenate(made) if made else np.empty(0, np.uint32)), offsets

    def _expanded(self, low: int, high: int) -> np.ndarray:
        """Ids of the symbols from ``low`` to ``high``."""
        symbols = self.seq[low:high].astype(np.int64)
        sizes = np.diff(self.ends[low:high], prepend=self.ends[low - 1] if low else 0)
        place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        each = np.repeat(symbols, sizes)
        rule = each >= self.first
        out = each.astype(np.uint32)
        out[rule] = self.flat[self.offsets[each[rule] - self.first] + place[rule]]
        return out

    def ids(self, n: int) -> np.ndarray:
        """Ids of document ``n``, from the symbols that cover it."""
        start, length = int(self.starts[n]), int(self.table[n, 2])
        if not length:
            return np.empty(0, np.uint32)
        low = int(np.searchsorted(self.ends, start, "right"))
        high = int(np.searchsorted(self.ends, start + length, "left")) + 1
        before = int(self.ends[low - 1]) if low else 0
        return self._expanded(low, high)[start - before : start - before + length]

    def documents(self) -> Iterator[np.ndarray]:
        """Ids of one document after another, expanded together."""
        whole = self._expanded(0, len(self.seq))
        for start, length in zip(self.starts.tolist(), self.table[:, 2].tolist()):
            yield whole[start : start + length]


def write(docs: DataFrame, tokenizer_path: str, target: str, end_id: int = 2) -> None:
    """Writes whole texts as compressed ids in ascending doc_id order, null ids first, each followed by ``end_id``.

    The table at ``target`` has a row per shard: ``part, shard, first, n_ids, payload``. Documents of one id follow
    each other by a hash of the text and by place, so a frequent id spreads over parts. Null and empty texts are the
    end id alone; other columns are left out; an empty table writes no shard.
    """
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = packed_encoder(tokenizer_path), TaskContext.get().partitionId()

        def rows() -> Iterator[tuple]:
            held, size, first, shard = [], 0, 0, 0
            for batch in batches:
                for doc_id, data in zip(batch["doc_id"].to_pylist(), byte_list(batch["text"])):
                    held.append((doc_id, np.frombuffer(encode(data) + end, "<u4")))
                    size += len(held[-1][1])
                    if size >= SHARD:
                        yield part, shard, first, size, pack_shard(held)
                        held, first, size, shard = [], first + size, 0, shard + 1
            if held:
                yield part, shard, first, size, pack_shard(held)

        yield from in_batches(rows(), schema, lambda r: len(r[4]))

    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("_place")]
    placed = keyed_texts(docs).withColumn("_place", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ranged.mapInArrow(run, "part int, shard int, first bigint, n_ids bigint, payload binary").write.parquet(target)


def read(spark: SparkSession, target: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files; ``start`` counts the ids of all documents before."""
    shards = spark.read.parquet(target)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per task of the write, far fewer than documents.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for first, payload in zip(batch["first"].to_pylist(), batch["payload"].to_pylist()):
                    shard = Shard(payload)
                    for (known, doc_id, length), start, ids in zip(shard.table.tolist(), shard.starts.tolist(), shard.documents()):
                        yield doc_id if known else None, first + start, length, ids.astype("<u4").tobytes()

        yield from in_batches(rows(), schema, lambda r: len(r[3]))

    return (
        shards.join(F.broadcast(bases), "part")
        .select((F.col("first") + F.col("base")).alias("first"), "payload")
        .mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
    )

