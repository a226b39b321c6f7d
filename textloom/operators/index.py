"""A stored index in segments: documents as counted rows, postings clustered by token, and totals of every token.

Appending documents adds a segment; readers merge the segments that the folder's list names, so a segment is seen
whole or not at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LANG = "lang"
_LIST = "segment string"


class StoredIndex:
    """The segments of the index at ``path``; documents carry a language, null if there is only one kind of text."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def append(self, counted: DataFrame) -> None:
        """Adds ``(pair_id, dl, runs)``, with ``lang`` if given, as a segment. A document belongs to one segment.

        The counted rows are written as they come; postings and totals are made from what was written, so texts are
        cut into tokens once and a lost task repeats only its own part.
        """
        segment = uuid.uuid4().hex
        lang = F.col(LANG) if LANG in counted.columns else F.lit(None).cast("string").alias(LANG)
        counted.select(lang, "pair_id", "dl", "runs").write.parquet(self._folder("documents", segment))
        postings = _postings(self._read("documents", [segment]))
        ranged = postings.repartitionByRange(LANG, "token", "pair_id").sortWithinPartitions(LANG, "token", F.desc("tf"), "pair_id")
        ranged.write.parquet(self._folder("postings", segment))
        written = self._read("postings", [segment])
        totals = written.groupBy(LANG, "token").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        totals.write.parquet(self._folder("totals", segment))
        self.spark.createDataFrame([(segment,)], _LIST).coalesce(1).write.mode("append").parquet(f"{self.path}/list")

    def _folder(self, kind: str, segment: str) -> str:
        return f"{self.path}/{kind}/{segment}"

    def _read(self, kind: str, segments: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[self._folder(kind, s) for s in segments])

    def segments(self) -> list[str]:
        """Names of the finished segments; as many rows as there were appends."""
        return sorted(r.segment for r in self.spark.read.schema(_LIST).parquet(f"{self.path}/list").collect())

    def _of(self, kind: str, lang: str | None) -> DataFrame:
        rows = self._read(kind, self.segments())
        return rows.drop(LANG) if lang is None else rows.where(F.col(LANG) == lang).drop(LANG)

    def documents(self, lang: str | None = None) -> DataFrame:
        """``(pair_id, dl, runs)``, one row per document."""
        return self._of("documents", lang)

    def postings(self, lang: str | None = None) -> DataFrame:
        """``(pair_id, dl, token, tf)``, by token and falling ``tf`` in every file, so that filters on tokens skip most."""
        return self._of("postings", lang)

    def totals(self, lang: str | None = None) -> DataFrame:
        """``(token, df, total)`` over all segments."""
        return self._of("totals", lang).groupBy("token").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _postings(counted: DataFrame) -> DataFrame:
    # The outer form keeps the optimizer from re-evaluating the array expressions in an inferred size filter.
    return counted.select(LANG, "pair_id", "dl", F.inline_outer("runs")).where(F.col("token").isNotNull())
