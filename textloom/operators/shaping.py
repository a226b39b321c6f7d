"""Small projections: binarized labels, previews, samples, fixed-length encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multilabel_binarize(labels: Column, n: int) -> Column:
    """0/1 vector of ``n`` classes; ids outside ``[0, n)`` are ignored."""
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.array_contains(labels, i).cast("int"))


def preview(text: Column, length: int = 200) -> Column:
    cut = F.concat(F.substring(text, 1, length), F.lit("..."))
    return F.when(F.length(text) > length, cut).otherwise(text)


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement, the same ones under any partitioning."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.orderBy(draw, id_col).limit(n)


def head_n(df: DataFrame, order_col: str, n: int = 100) -> DataFrame:
    return df.orderBy(order_col).limit(n)


def pad_truncate(ids: Column, length: int, cls_id: int, sep_id: int, pad_id: int) -> dict[str, Column]:
    """Fixed-length ``input_ids``, ``attention_mask`` and ``token_type_ids``; the special tokens are kept."""
    body = F.slice(ids, 1, length - 2)
    used = F.least(F.size(ids), F.lit(length - 2)) + 2
    padding = F.array_repeat(F.lit(pad_id), F.lit(length) - used)
    return {
        "input_ids": F.concat(F.array(F.lit(cls_id)), body, F.array(F.lit(sep_id)), padding),
        "attention_mask": F.concat(F.array_repeat(F.lit(1), used), F.array_repeat(F.lit(0), F.lit(length) - used)),
        "token_type_ids": F.array_repeat(F.lit(0), F.lit(length)),
    }


def fits_limit(ids: Column, limit: int = 512) -> Column:
    """True when the untruncated encoding, special tokens included, fits the limit."""
    return F.size(ids) <= limit
