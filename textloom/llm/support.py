"""Helpers shared by the operators: tables in the shared folder and Arrow row loops."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import written

SPACES = b" \t\n\x0b\x0c\r"
"""The characters of ``[\\x20\\x09-\\x0D]``."""


def keyed_texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of any table that has them; further columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def byte_list(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def in_batches(rows: Iterable[tuple], schema: pa.Schema, size=None, most_rows: int = 20_000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of ``rows``; ``size(row)`` bounds the bytes held before a batch is sent on."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += size(row) if size else 0
        if len(held) >= most_rows or weight >= most_bytes:
            yield _batch(held, schema)
            held, weight = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def filed(table: DataFrame) -> DataFrame:
    """``table`` itself if its rows lie in files, else written to the shared folder."""
    try:
        table.select("_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        return written(table, "rows")
    return table


def named_rows(table: DataFrame, *columns: Column) -> DataFrame:
    """``columns`` of ``table`` and a name of each row in ``row``: its file and place, the same in every run.

    A table that has no files is written first; pass one through ``filed`` if its names are to last.
    """
    place = filed(table).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"), *columns)
    return place.withColumn("row", F.concat_ws("-", F.md5("file"), "place")).drop("file", "place")


def without_rows(table: DataFrame, spare: DataFrame) -> DataFrame:
    """``table`` (of files) without the rows named in ``spare``; few names are sent to the table, many meet it by name."""
    packed = named_rows(table, F.struct(*[F.col(f"`{c}`") for c in table.columns]).alias("whole"))
    return packed.join(written(spare, "spare"), "row", "left_anti").select("whole.*")


SALTS = 1024
"""Partitions that the rows of one hot key are dealt over."""


def spread_join(rows: DataFrame, table: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which holds a key once; ``rows`` should be a written table, as it is read twice.

    A key's rows are dealt by a hash of ``by``, and a row of ``table`` is repeated only for the deals that its key
    really fills: never more rows than ``rows`` has, and no hot key in one task.
    """
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    filled = salted.select(key, "_salt").distinct()
    return salted.join(filled.join(table, key), [key, "_salt"], how).drop("_salt")
