"""Exact nearest neighbours by a block matrix join: int8 tiles with error bounds, float rescoring, heaps."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
RUN = 16
"""Candidate blocks that one task takes against a block of queries."""

MATRIX = "block bigint, dim int, ids binary, vectors binary"


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v)``: one row per id; null, zero and non-finite vectors are left out, a repeated id keeps its least one."""
    v = F.col(vector_col).cast("array<float>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    return rows.where(fine).groupBy("id").agg(F.min("v").alias("v"))


def _blocks(rows: DataFrame, blocks: int) -> DataFrame:
    """One row per block and dimension: ids and float matrix as binary."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        matrix = np.array(frame["v"].tolist(), "<f4")
        ids = frame["id"].to_numpy("<i8")
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "dim": [matrix.shape[1]], "ids": [ids.tobytes()], "vectors": [matrix.tobytes()]})

    keyed = rows.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"), F.size("v").alias("dim"), "id", "v")
    return keyed.groupBy("block", "dim").applyInPandas(run, MATRIX)


def _quantised(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows as int8 with scales, the norms of what they stand for, and the norms of their rounding errors."""
    scale = np.abs(matrix).max(1, keepdims=True).astype(np.float64) / 127
    small = np.rint(matrix / scale).astype(np.int8)
    stands = small * scale
    return small, scale[:, 0], np.linalg.norm(stands, axis=1), np.linalg.norm(matrix - stands, axis=1)


def tile(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Approximate inner products from int8 codes, and a bound of their errors.

    ``q.c = Q.C + e.c + Q.f`` for codes Q, C and errors e, f; Cauchy-Schwarz bounds the last two terms.
    """
    q, qs, qn, qe = _quantised(queries)
    c, cs, cn, ce = _quantised(candidates)
    kind = np.float32 if queries.shape[1] <= 1000 else np.float64  # whole numbers below 2**24 are exact
    about = (q.astype(kind) @ c.astype(kind).T).astype(np.float64) * qs[:, None] * cs[None, :]
    bound = (qe[:, None] * (cn + ce)[None, :] + qn[:, None] * ce[None, :]) * (1 + 1e-9) + 1e-12 * (qn[:, None] * cn[None, :] + 1)
    return about, bound


def scores(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(candidates))
    for x, column in zip(query.astype(np.float64), candidates.T.astype(np.float64)):
        total += x * column
    return total


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` largest inner products of each query with other rows.

    ``is_query`` is a condition on ``id``. Ties go to the smaller id; fewer candidates give fewer rows; vectors meet
    only vectors of their length; see ``clean`` for what takes no part. Query blocks are repeated once per run of
    candidate blocks and joined on the run's number; every tile keeps ``k`` rows a query, found without loss.
    """
    rows = clean(vectors, id_col, vector_col)
    blocks = max(1, -(-vectors.count() // block))
    runs = -(-blocks // RUN)
    items = _blocks(rows, blocks).withColumn("run", (F.col("block") / RUN).cast("long"))
    asked = rows.where(is_query)
    asked_blocks = max(1, -(-vectors.where(F.expr(f"{id_col} is not null")).select(F.col(id_col).cast("long").alias("id")).where(is_query).count() // block))
    queries = _blocks(asked, asked_blocks).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))))
    left = queries.select("run", "dim", F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("vectors").alias("query_vectors"))
    pairs = left.join(items.select("run", "dim", "ids", "vectors"), ["run", "dim"])

    def run(frames):
        for frame in frames:
            out: list[tuple[int, int, float]] = []
            for dim, query_ids, query_vectors, ids, matrix in zip(*(frame[c] for c in ("dim", "query_ids", "query_vectors", "ids", "vectors"))):
                qi, ci = np.frombuffer(query_ids, "<i8"), np.frombuffer(ids, "<i8")
                q = np.frombuffer(query_vectors, "<f4").reshape(-1, dim)
                c = np.frombuffer(matrix, "<f4").reshape(-1, dim)
                for low in range(0, len(qi), 256):
                    about, bound = tile(q[low : low + 256], c)
                    own = qi[low : low + 256, None] == ci[None, :]
                    least = np.where(own, -np.inf, about - bound)
                    cut = np.partition(least, -min(k, len(ci)), axis=1)[:, -min(k, len(ci))]
                    for n, row in enumerate((about + bound >= cut[:, None]) & ~own):
                        at = np.flatnonzero(row)
                        exact = scores(q[low + n], c[at])
                        best = heapq.nsmallest(k, zip((-exact).tolist(), ci[at].tolist()))
                        out += [(int(qi[low + n]), i, -s) for s, i in best]
            yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(k, zip((-frame["score"]).tolist(), frame["vec_id"].tolist()))
        return pd.DataFrame([(frame["query_id"].iloc[0], r + 1, i, -s) for r, (s, i) in enumerate(best)], columns=["query_id", "rank", "vec_id", "score"])

    found = pairs.mapInPandas(run, "query_id bigint, vec_id bigint, score double")
    return found.groupBy("query_id").applyInPandas(merge, "query_id bigint, rank int, vec_id bigint, score double")
