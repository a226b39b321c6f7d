"""Block against block on the executors: both sides are dealt into blocks, and any task takes any pair of blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import spread


def grid(left: DataFrame, right: DataFrame, key: tuple[str, str], counts: tuple[Column, Column], order: list[str]) -> DataFrame:
    """Rows of both sides, which have the same columns, under the ``(rows, columns)`` tiles that need them.

    ``counts`` are the numbers of blocks. A row of ``left`` goes to one block of rows and every block of columns, a row
    of ``right`` the other way; ``asked`` tells them apart.
    """
    (left_key, right_key), (n_left, n_right) = key, counts
    block = lambda name, n: F.pmod(F.xxhash64(name), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    asked = left.select("*", block(left_key, n_left).alias("rows"), every(n_right).alias("columns"), F.lit(True).alias("asked"))
    offered = right.select("*", every(n_left).alias("rows"), block(right_key, n_right).alias("columns"), F.lit(False).alias("asked"))
    return spread(asked.unionByName(offered), "rows", "columns").sortWithinPartitions("rows", "columns", *order)


def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one tile after another, from the sorted rows of a task."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        places = np.stack([batch.column(c).to_numpy() for c in ("rows", "columns")], 1)
        starts = [0, *(np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1)) + 1).tolist(), len(places)]
        for start, end in zip(starts, starts[1:]):
            if held and tuple(places[start]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(start, end - start))
            last = tuple(places[start])
    if held:
        yield pa.Table.from_batches(held)
