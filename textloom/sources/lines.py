"""Text out of ragged lines: JSON objects, JSON strings or plain text."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions.text import strip
from textloom.sources.tables import in_file_order

_JSON_START = r'^[\[{"0-9-]'
_JSON_WORDS = ["true", "false", "null", "NaN", "Infinity", "-Infinity"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, value)``: the lines of text files, numbered in each file from 1.

    A file may be read by many tasks; numbers come from the line counts of its blocks, and no line is moved.
    """
    rows = in_file_order(spark.read.text(path).withColumn("file", F.col("_metadata.file_path")), "line", by_file=True)
    return rows.select("file", (F.col("line") + 1).alias("line"), "value")


def _spelled(value: object) -> str | None:
    """A known field as text: a non-empty string, or a non-empty list with its items as Python prints them."""
    if not value:
        return None
    if isinstance(value, list):
        return " ".join(map(str, value))
    return value if isinstance(value, str) else None


def line_text(line: str) -> tuple[str, str | None]:
    """``(kind, text)`` of a stripped line that may be JSON.

    Of repeated keys the last counts, in the place of the first. ``object``: the known fields that have text, in their
    fixed order, else all strings that are not blank; ``string``: itself; ``other`` JSON has no text; a line that is
    no JSON is ``text``, or ``bad_object`` if it has an object's brackets. What no reader could hold, such as too deep
    nesting, is ``unreadable`` and has no text.
    """
    try:
        value = json.loads(line)
    except json.JSONDecodeError:
        return "bad_object" if line[0] == "{" and line[-1] == "}" else "text", line
    except (RecursionError, ValueError):
        return "unreadable", None
    if isinstance(value, str):
        kind, text = "string", value
    elif isinstance(value, dict):
        named = [t for t in map(_spelled, map(value.get, C.CORPUS_FIELDS)) if t is not None]
        kind, text = "object", " ".join(named)
        if not text.strip():
            text = " ".join(v for v in value.values() if isinstance(v, str) and v.strip())
    else:
        kind, text = "other", ""
    # Halves of surrogate pairs are no text in UTF-8.
    return kind, text.strip().encode("utf-8", "replace").decode("utf-8") or None


def _line_texts() -> Column:
    @F.pandas_udf("kind string, text string")
    def read(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(None, None) if x is None else line_text(x) for x in batch], columns=["kind", "text"])

    return read


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``kind`` (blank, object, string, other, text, bad_object, unreadable) and the extracted ``text`` or null.

    Lines that cannot be JSON by their first character stay where they are; the others are read in Arrow batches.
    """
    shaped = lines.withColumn("_line", strip(F.col(column)))
    open_json = F.col("_line").rlike(_JSON_START) | F.col("_line").isin(_JSON_WORDS)
    read = shaped.withColumn("_read", _line_texts()(F.when(open_json, F.col("_line"))))
    kind = F.when(open_json, F.col("_read.kind")).when(F.col("_line") == "", "blank").when(F.col("_line").isNotNull(), "text")
    text = F.when(open_json, F.col("_read.text")).otherwise(F.nullif(F.col("_line"), F.lit("")))
    return read.select(*lines.columns, kind.alias("kind"), text.alias("text"))


def extract_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """The texts of all usable lines."""
    return parse_lines(lines, column).where(F.col("text").isNotNull()).drop("kind", column)


def extract_text_errors(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines that gave no text, and object-shaped lines kept as plain text, with the reason."""
    reason = (
        F.when(F.col("kind") == "blank", "blank line")
        .when(F.col("kind") == "other", "JSON value without text")
        .when(F.col("kind") == "bad_object", "broken JSON object kept as text")
        .when(F.col("kind") == "unreadable", "JSON that cannot be read")
        .otherwise("no text in JSON")
    )
    parsed = parse_lines(lines, column)
    return parsed.where(F.col("text").isNull() | (F.col("kind") == "bad_object")).select(
        *[c for c in lines.columns], reason.alias("reason")
    )
