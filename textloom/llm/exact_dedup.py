"""Exact deduplication by composable polynomial fingerprints and chunkwise comparison."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.support import SPACES, byte_list, filed, in_batches, named_rows, spread_join, written

CHUNK = 1 << 16
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
KEY = ["fp1", "fp2", "n_bytes"]
_POWERS: dict[tuple[int, int], np.ndarray] = {}


def _powers(base: int, prime: int) -> np.ndarray:
    """``base ** (CHUNK - 1 - i) mod prime`` for each position of a chunk."""
    if (base, prime) not in _POWERS:
        out, x = np.empty(CHUNK, np.uint64), 1
        for i in range(CHUNK - 1, -1, -1):
            out[i] = x
            x = x * base % prime
        _POWERS[base, prime] = out
    return _POWERS[base, prime]


def chunk_hash(data: bytes, base: int, prime: int) -> int:
    """Polynomial hash of at most one chunk; sums stay below 2**56."""
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    return int(np.dot(values, _powers(base, prime)[CHUNK - len(values) :])) % prime if len(values) else 0


def combine(left: int, right: int, right_bytes: int, base: int, prime: int) -> int:
    """Hash of two strings one after the other: the left one is shifted by the right one's length."""
    return (left * pow(base, right_bytes, prime) + right) % prime


def fingerprint(data: bytes, base: int, prime: int) -> int:
    total = 0
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK]
        total = combine(total, chunk_hash(part, base, prime), len(part), base, prime)
    return total


def same(a: bytes, b: bytes) -> bool:
    """Chunk by chunk, ending at the first difference."""
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def _fingerprints(docs: DataFrame, primes: tuple[int, int], with_text: bool) -> DataFrame:
    fields = [("row", pa.string()), ("doc_id", pa.int64()), ("chars", pa.int64()), ("fp1", pa.int64()), ("fp2", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string())]
    schema = pa.schema(fields + [("body", pa.binary())] * with_text)

    def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
        for name, doc_id, data in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), byte_list(batch["text"])):
            body = data.translate(None, SPACES)
            chars = len(data) - np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)
            prints = [fingerprint(body, b, p) for b, p in zip(BASES, primes)]
            row = (name, doc_id, int(chars), *prints, len(body), hashlib.sha256(body).hexdigest())
            yield (*row, body) if with_text else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches((r for b in batches for r in rows(b)), schema, lambda r: len(r[-1]))

    spec = "row string, doc_id bigint, chars bigint, fp1 bigint, fp2 bigint, n_bytes bigint, text_sha256 string" + ", body binary" * with_text
    named = named_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.select("row", "doc_id", "text").mapInArrow(run, spec)


def _compared(pairs: DataFrame) -> DataFrame:
    """``(*KEY, text_sha256, equal)`` of ``(*KEY, text_sha256, body, pivot)``."""
    schema = pa.schema([(k, pa.int64()) for k in KEY] + [("text_sha256", pa.string()), ("equal", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (*keys, sha, same(body, pivot))
            for batch in batches
            for *keys, sha, body, pivot in zip(*(batch[c].to_pylist() for c in [*KEY, "text_sha256", "body", "pivot"]))
        )
        yield from in_batches(rows, schema)

    return pairs.select(*KEY, "text_sha256", "body", "pivot").mapInArrow(run, "fp1 bigint, fp2 bigint, n_bytes bigint, text_sha256 string, equal boolean")


def _classified(docs: DataFrame, primes: tuple[int, int]) -> DataFrame:
    """``(row, doc_id, chars, text_sha256, *KEY, class)``: rows of equal texts share ``KEY`` and ``class``."""
    docs = filed(docs)
    prints = written(_fingerprints(docs, primes, False), "prints")
    twice = prints.groupBy(*KEY).count().where("count > 1").select(*KEY)
    rest = written(_fingerprints(docs, primes, True).drop("row").join(twice, KEY, "left_semi"), "twice")
    classes = None
    number = 0
    while True:
        # One digest's text per fingerprint is the pivot of this round.
        first = rest.groupBy(*KEY).agg(F.min("text_sha256").alias("text_sha256"))
        pivots = rest.join(first, [*KEY, "text_sha256"], "left_semi").groupBy(*KEY).agg(F.min("body").alias("pivot"))
        outcome = written(_compared(rest.join(pivots, KEY)).distinct(), "compared")
        found = outcome.where("equal").select(*KEY, "text_sha256", F.lit(number).alias("class"))
        classes = found if classes is None else classes.unionByName(found)
        differ = outcome.where("not equal").select(*KEY, "text_sha256")
        if differ.isEmpty():
            break
        rest = written(rest.join(differ, [*KEY, "text_sha256"], "left_semi"), "differ")
        number += 1
    if number:
        return prints.join(classes, [*KEY, "text_sha256"], "left").withColumn("class", F.coalesce("class", F.lit(0)))
    return prints.withColumn("class", F.lit(0))


def _stays() -> list[Column]:
    """Order of preference of the rows of a group."""
    return [F.col("chars"), F.col("doc_id").isNotNull().alias("known"), (-F.col("doc_id")).alias("minus")]


def exact_groups(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` per row of ``docs``.

    Texts are equal when identical without ``[\\x20\\x09-\\x0D]``; null counts as empty. The row with the most code
    points stays, then the smallest doc_id, null ids last. Repeated rows count in ``group_size`` and share ``kept``;
    a null ``keep_id`` keeps the rows with a null id. Other columns are left out; an empty table gives no rows. Texts
    with equal fingerprints are compared with one of them chunk by chunk; those that differ form groups of their own
    in further rounds. Only texts whose fingerprint occurs twice are shuffled; a text is held whole by one task.
    """
    prints = _classified(docs, primes)
    keys = [*KEY, "class"]
    groups = prints.groupBy(*keys).agg(F.max(F.struct(*_stays())).alias("best"), F.count("*").alias("group_size"))
    groups = groups.select(*keys, (-F.col("best.minus")).alias("keep_id"), "group_size")
    return prints.join(groups, keys).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def spare_rows(docs: DataFrame, primes: tuple[int, int] = PRIMES) -> DataFrame:
    """``(row)``: names (see ``named_rows``) of the rows whose text another row, which stays, has as well.

    Of equal texts the one row that ``exact_groups`` prefers stays, of rows alike in that the last by name. ``docs``
    must be a table of files, whose rows have lasting names.
    """
    prints = _classified(docs, primes).select("row", "doc_id", "chars", F.struct(*KEY, "class").alias("group"))
    stays = prints.groupBy("group").agg(F.max(F.struct(*_stays(), "row")).alias("best"), F.count("*").alias("n"))
    return spread_join(prints, stays.where("n > 1"), "group", "row").where("row <> best.row").select("row")
