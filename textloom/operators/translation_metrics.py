"""Corpus BLEU, chrF and chrF++.

Clipped n-gram matches are counted inside each row, for many rows at a time: the n-grams of a row are numbered, those
of order n from those of order n - 1. Nothing is exploded and the only shuffle carries one row of sums per task and
group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import constants as C
from textloom.functions import text as T

# Separators of the standard tokenizer.
_SPLIT_MARKS = r"([\{-~\[-` -&\(-\+:-@/])"
_ASCII_MARKS = r"!-/:-@\[-`{-~"

TOKENS_AT_ONCE = 1 << 19
"""Tokens after which a run of rows is closed; a row is never cut."""


def tokenize_13a(text: Column) -> Column:
    """Standard punctuation splitting of lowered text."""
    out = F.replace(F.lower(text), F.lit("<skipped>"), F.lit(""))
    for found, put in (("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        out = F.replace(out, F.lit(found), F.lit(put))
    return _split_marks(out)


def tokenize_zh(text: Column) -> Column:
    """Each CJK character on its own, the rest by standard punctuation splitting."""
    cjk = f"([{C.CJK_CHARS}\\x{{3000}}-\\x{{303f}}\\x{{ff00}}-\\x{{ffef}}])"
    return _split_marks(F.regexp_replace(T.strip(F.lower(text)), cjk, " $1 "))


def _split_marks(text: Column) -> Column:
    out = F.concat(F.lit(" "), text, F.lit(" "))
    out = F.regexp_replace(out, _SPLIT_MARKS, " $1 ")
    out = F.regexp_replace(out, r"([^0-9])([.,])", "$1 $2 ")
    out = F.regexp_replace(out, r"([.,])([^0-9])", " $1 $2")
    out = F.regexp_replace(out, r"([0-9])(-)", "$1 $2 ")
    return T.split_blank(out, any_whitespace=True)


def unspaced(text: Column) -> Column:
    """Lowered text without blanks."""
    return F.regexp_replace(F.lower(text), rf"[{C.WHITESPACE}]+", "")


def tokenize_chars(text: Column) -> Column:
    """Characters of lowered text without blanks."""
    return T.characters(unspaced(text))


def chrf_words(text: Column) -> Column:
    """Lowered words with one trailing, else one leading, ASCII mark split off."""
    words = T.split_blank(F.lower(text), any_whitespace=True)

    def split(w: Column) -> Column:
        size = F.length(w)
        last = F.array(F.substring(w, F.lit(1), size - 1), F.substring(w, size, F.lit(1)))
        first = F.array(F.substring(w, 1, 1), F.substring(w, F.lit(2), size))
        return (
            F.when(size == 1, F.array(w))
            .when(w.rlike(rf"[{_ASCII_MARKS}]\z"), last)
            .when(w.rlike(rf"^[{_ASCII_MARKS}]"), first)
            .otherwise(F.array(w))
        )

    return F.flatten(F.transform(words, split))


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all rows as numbers, and how many each row has; a text stands for its characters."""
    if pa.types.is_list(column.type):
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        return column.flatten().dictionary_encode().indices.to_numpy().astype(np.int64), sizes.astype(np.int64)
    text = "".join(column.to_pylist())
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64), pc.utf8_length(column).to_numpy().astype(np.int64)


def _matches(pred: pa.Array, ref: pa.Array, orders: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(m, p, r)`` of every row, for each order from 1: clipped matches and n-grams per side.

    An n-gram can only match if the one without its last token does, so the others are dropped on the way.
    """
    tokens, sizes = _numbers(pa.concat_arrays([pred, ref]))
    rows = len(pred)
    first_ref = int(sizes[:rows].sum())
    row = np.repeat(np.arange(2 * rows) % rows, sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(tokens))
    kinds = int(tokens.max(initial=0)) + 1
    at, grams = np.arange(len(tokens)), row
    for n in range(1, orders + 1):
        held = left[at] >= n
        at = at[held]
        keys, grams = np.unique(grams[held] * kinds + tokens[at + n - 1], return_inverse=True)
        of_pred = at < first_ref
        both = np.minimum(*(np.bincount(grams[side], minlength=len(keys)) for side in (of_pred, ~of_pred)))
        of_row = np.zeros(len(keys), np.int64)
        of_row[grams] = row[at]
        counts = np.maximum(sizes - n + 1, 0)
        yield np.bincount(of_row, weights=both, minlength=rows).astype(np.int64), counts[:rows], counts[rows:]
        shared = both[grams] > 0
        at, grams = at[shared], grams[shared]


def _with_matches(rows: DataFrame, grams: list[tuple[str, str, int]]) -> DataFrame:
    """Adds ``m_i`` (clipped matches), ``p_i`` and ``r_i`` (n-grams per side) for each (pred, ref, highest order).

    The columns hold tokens, or texts whose characters are the tokens; orders count on from one pair of columns to the
    next. The columns of tokens are left out.
    """
    tokens = {c for p, r, _ in grams for c in (p, r)}
    keep = [f for f in rows.schema.fields if f.name not in tokens]
    names = [f"{kind}_{i}" for i in range(sum(n for _, _, n in grams)) for kind in "mpr"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.ones(batch.num_rows, np.int64)
            for c in tokens:
                of_list = pa.types.is_list(batch[c].type)
                length = pc.list_value_length(batch[c]) if of_list else pc.utf8_length(batch[c])
                sizes += pc.fill_null(length, 0).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.diff(np.cumsum(sizes) // TOKENS_AT_ONCE, append=-1)) + 1
            for start, end in zip([0, *ends.tolist()], ends.tolist()):
                part = batch.slice(start, end - start)
                found = [x for p, r, n in grams for counts in _matches(part[p], part[r], n) for x in counts]
                yield pa.RecordBatch.from_arrays([*(part[f.name] for f in keep), *map(pa.array, found)], [*(f.name for f in keep), *names])

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in keep]
    return rows.select(*[f.name for f in keep], *sorted(tokens)).mapInArrow(run, ", ".join(kept + [f"{n} bigint" for n in names]))


def _sums(counted: DataFrame, orders: int, by_level: str | None, extra: list[Column]) -> DataFrame:
    cells = [F.sum(f"{kind}_{i}").alias(f"{kind}_{i}") for i in range(orders) for kind in "mpr"]
    if by_level is None:
        return counted.agg(*cells, *extra)
    return counted.groupingSets([[], [by_level]], by_level).agg(*cells, *extra, F.grouping(by_level).alias("overall"))


def bleu_score(orders: int = 4) -> Column:
    """BLEU from the sums ``m_i``, ``p_i``, ``pred_len`` and ``ref_len``; zero counts are smoothed exponentially."""
    logs, zeros = F.lit(0.0), F.lit(0)
    for i in range(orders):
        match, total = F.col(f"m_{i}").cast("double"), F.col(f"p_{i}").cast("double")
        zeros = zeros + F.when(match == 0, 1).otherwise(0)
        logs = logs + F.when(match > 0, F.log(match / total)).otherwise(-F.log(F.pow(F.lit(2.0), zeros) * total))
    pred, ref = F.col("pred_len").cast("double"), F.col("ref_len").cast("double")
    penalty = F.when(pred > ref, 1.0).otherwise(F.exp(1 - ref / pred))
    defined = F.lit(True)
    any_match = F.lit(False)
    for i in range(orders):
        defined, any_match = defined & (F.col(f"p_{i}") > 0), any_match | (F.col(f"m_{i}") > 0)
    return F.when(defined & any_match, 100 * penalty * F.exp(logs / orders)).otherwise(0.0)


def chrf_score(orders: list[int], beta: float = 2.0) -> Column:
    """F score from the sums of the given orders; averages run over orders present on both sides."""
    used, precision, recall = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for i in orders:
        m, p, r = (F.col(f"{kind}_{i}").cast("double") for kind in "mpr")
        both = (p > 0) & (r > 0)
        used = used + F.when(both, 1.0).otherwise(0.0)
        precision = precision + F.when(both, m / p).otherwise(0.0)
        recall = recall + F.when(both, m / r).otherwise(0.0)
    avg_p, avg_r, weight = precision / used, recall / used, F.lit(beta * beta)
    f = 100 * (1 + weight) * avg_p * avg_r / (weight * avg_p + avg_r)
    return F.when((used > 0) & (precision + recall > 0), f).otherwise(0.0)


def _prepared(rows: DataFrame, tokenize: Callable[[Column], Column], names: tuple[str, str]) -> DataFrame:
    out = rows
    for side, column in zip(names, ("pred", "gold"), strict=True):
        out = out.withColumn(side, tokenize(F.coalesce(column, F.lit(""))))
    return out


def corpus_bleu(rows: DataFrame, tokenize: Callable[[Column], Column] = tokenize_13a) -> DataFrame:
    """One row ``(score)``; ``rows`` is ``(pred, gold)``. ``tokenize`` gives tokens, or a text of which the characters count."""
    tokens = _prepared(rows, tokenize, ("pt", "rt")).select("pt", "rt")
    counted = _with_matches(tokens, [("pt", "rt", 4)])
    sums = _sums(counted, 4, None, [F.sum("p_0").alias("pred_len"), F.sum("r_0").alias("ref_len")])
    return sums.select(F.bround(bleu_score(), 4).alias("score"))


def char_bleu(rows: DataFrame) -> DataFrame:
    """BLEU on characters."""
    return corpus_bleu(rows, unspaced)


def _chrf_counts(rows: DataFrame, word_order: int, keep: list[str] | None = None) -> DataFrame:
    tokens = _prepared(rows, unspaced, ("pc", "rc"))
    grams = [("pc", "rc", 6)]
    columns = [*(keep or []), "pc", "rc"]
    if word_order:
        tokens = _prepared(tokens, chrf_words, ("pw", "rw"))
        grams += [("pw", "rw", word_order)]
        columns += ["pw", "rw"]
    counted = _with_matches(tokens.select(*columns), grams)
    # Predicted n-grams only count in rows whose gold text has n-grams of that order.
    for i in range(6 + word_order):
        counted = counted.withColumn(f"p_{i}", F.when(F.col(f"r_{i}") > 0, F.col(f"p_{i}")).otherwise(0))
    return counted


def chrf(rows: DataFrame, word_order: int = 0) -> DataFrame:
    """One row ``(score)``; ``word_order=2`` gives chrF++."""
    sums = _sums(_chrf_counts(rows, word_order), 6 + word_order, None, [])
    return sums.select(F.bround(chrf_score(list(range(6 + word_order))), 4).alias("score"))


def metrics_by_level(rows: DataFrame, level: str = "source", levels: list[str] | None = None, tokenize: Callable[[Column], Column] = tokenize_13a) -> DataFrame:
    """``(level, bleu, chrfpp, chrf)`` for all rows (level ``overall``) and each level, from one pass over the rows."""
    tokens = _prepared(_prepared(_prepared(rows, tokenize, ("pt", "rt")), unspaced, ("pc", "rc")), chrf_words, ("pw", "rw"))
    tokens = tokens.select(F.col(level).alias("level"), "pt", "rt", "pc", "rc", "pw", "rw")
    counted = _with_matches(tokens, [("pt", "rt", 4), ("pc", "rc", 6), ("pw", "rw", 2)])
    for i in range(4, 12):
        counted = counted.withColumn(f"p_{i}", F.when(F.col(f"r_{i}") > 0, F.col(f"p_{i}")).otherwise(0))
    sums = _sums(counted, 12, "level", [F.sum("p_0").alias("pred_len"), F.sum("r_0").alias("ref_len")])
    named = sums.withColumn("level", F.when(F.col("overall") == 1, "overall").otherwise(F.col("level")))
    named = named.where((F.col("overall") == 1) | F.col("level").isin(levels or C.LEVELS))
    return named.select(
        "level",
        F.bround(bleu_score(), 4).alias("bleu"),
        F.bround(chrf_score(list(range(4, 12))), 4).alias("chrfpp"),
        F.bround(chrf_score(list(range(4, 10))), 4).alias("chrf"),
    )
