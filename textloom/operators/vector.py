"""Cosine similarity search, hybrid fusion and vector statistics."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.text import split_blank, word_set
from textloom.operators.lexical import TIE_DIGITS, top_k
from textloom.operators.tiles import grid, tiles
from textloom.session import salted_join, small_side

BLOCK_BYTES = 8 * 1024 * 1024
BLOCK_ROWS = 2_048
"""Largest block of vectors; two blocks and their scores are what a task holds."""

LEAST_BYTES = 64 * 1024
"""Blocks are not made smaller than this to have more of them."""


def unit_vectors(df: DataFrame, id_col: str, vec_col: str = "embedding") -> DataFrame:
    """``(id, vec)`` scaled to length one; zero vectors stay zero."""
    vec = F.col(vec_col).cast("array<double>")
    norm = F.sqrt(F.aggregate(vec, F.lit(0.0), lambda a, x: a + x * x))
    measured = df.select(F.col(id_col).alias("id"), vec.alias("raw"), norm.alias("norm"))
    scaled = F.transform("raw", lambda x: F.when(F.col("norm") > 0, x / F.col("norm")).otherwise(F.lit(0.0)))
    return measured.select("id", scaled.alias("vec"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _block_count(side: DataFrame) -> Column:
    """Blocks of bounded rows and bytes; a smaller side is still cut, so that several tasks have work."""
    size = F.count("*") * F.coalesce(F.max(F.size("vec")), F.lit(0)) * 8
    tasks = side.sparkSession.sparkContext.defaultParallelism
    wanted = F.least(F.ceil(size / LEAST_BYTES), F.lit(ceil(sqrt(2 * tasks))))
    return side.agg(F.greatest(F.ceil(size / BLOCK_BYTES), F.ceil(F.count("*") / BLOCK_ROWS), wanted, F.lit(1)).cast("int")).scalar()


def _matches(queries: DataFrame, items: DataFrame, pick: Callable) -> DataFrame:
    """Run ``pick(scores, query_ids, item_ids)`` on the score matrix of every block of queries and block of items."""

    def matrix(side: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = side["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return side["id"].to_numpy(), flat.reshape(side.num_rows, -1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in tiles(batches):
            asked, offered = tile.filter(tile["asked"]), tile.filter(pc.invert(tile["asked"]))
            if asked.num_rows and offered.num_rows:
                (query_ids, left), (item_ids, right) = matrix(asked), matrix(offered)
                q, i, s = pick(left @ right.T, query_ids, item_ids)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], ["query_id", "item_id", "score"])

    sides = [side.select("id", "vec").where("vec is not null") for side in (queries, items)]
    counts = tuple(_block_count(side) for side in sides)
    return grid(*sides, ("id", "id"), counts, ["id"]).mapInArrow(score, "query_id bigint, item_id bigint, score double")


def cosine_scores(queries: DataFrame, items: DataFrame, min_score: float) -> DataFrame:
    """``(query_id, item_id, score)`` of all pairs with cosine of at least ``min_score``; sides are unit vectors."""

    def above(scores: np.ndarray, query_ids: np.ndarray, item_ids: np.ndarray):
        q, i = np.nonzero(scores >= min_score)
        return query_ids[q], item_ids[i], scores[q, i]

    return _matches(queries, items, above)


def cosine_topk(queries: DataFrame, items: DataFrame, k: int, high_id_first: bool = False) -> DataFrame:
    """``(query_id, item_id, score, rank)``: the ``k`` nearest items, exact.

    Each block of items gives only its own best ``k`` per query, so the final ranking moves a few rows per query and
    block.
    """
    if k <= 0:
        return _matches(queries.limit(0), items, lambda s, q, i: (q, i, s)).withColumn("rank", F.lit(0))

    def best(scores: np.ndarray, query_ids: np.ndarray, item_ids: np.ndarray):
        rounded = np.round(scores, TIE_DIGITS)
        if scores.shape[1] > k:
            tie_order = np.argsort(-item_ids if high_id_first else item_ids, kind="stable")
            ranked = np.argsort(-rounded[:, tie_order], axis=1, kind="stable")[:, :k]
            keep = tie_order[ranked]
        else:
            keep = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
        rows = np.repeat(np.arange(scores.shape[0]), keep.shape[1])
        cols = keep.reshape(-1)
        return query_ids[rows], item_ids[cols], scores[rows, cols]

    tie = F.col("item_id").desc() if high_id_first else F.col("item_id").asc()
    return top_k(_matches(queries, items, best), k, order=[F.round("score", TIE_DIGITS).desc(), tie])


def keyword_score(queries: DataFrame, rules: DataFrame) -> DataFrame:
    """``(query_id, rule_id, kw)`` with ``kw > 0``.

    ``queries`` is ``(query_id, words, keys)`` (distinct arrays). Weights: 2 per word of the description, 1 per word
    of each example, 3 per word key of each example. Rule terms are summed per rule before they meet the queries.
    """
    described = rules.select("rule_id", F.lit("w").alias("kind"), F.explode(word_set(F.col("grammar_description"), False)).alias("term"), F.lit(2).alias("w"))
    examples = rules.select("rule_id", F.explode("examples").alias("ex"))
    worded = examples.select("rule_id", F.lit("w").alias("kind"), F.explode(word_set(F.col("ex.za"), False)).alias("term"), F.lit(1).alias("w"))
    keyed = examples.select("rule_id", F.lit("k").alias("kind"), F.explode(F.map_keys("ex.related_words")).alias("term"), F.lit(3).alias("w"))
    terms = described.unionByName(worded).unionByName(keyed).groupBy("rule_id", "kind", "term").agg(F.sum("w").alias("w"))
    asked = queries.select("query_id", F.lit("w").alias("kind"), F.explode_outer("words").alias("term")).unionByName(
        queries.select("query_id", F.lit("k").alias("kind"), F.explode_outer("keys").alias("term"))
    ).where(F.col("term").isNotNull())
    pairs = salted_join(asked, terms, ["kind", "term"], "query_id")
    return pairs.groupBy("query_id", "rule_id").agg(F.sum("w").alias("kw"))


def hybrid_scores(
    kw: DataFrame, query_vecs: DataFrame, rule_vecs: DataFrame, alpha: DataFrame | float, k: int
) -> DataFrame:
    """Fused scores of every pair that can be among the best ``k`` of its query.

    Fused = alpha * kw / (max kw + 1e-9) + (1 - alpha) * (cos + 1) / 2. A rule without keyword hits scores by its
    cosine alone, so it can only be among the best k if it is among the k nearest rules; pairs with hits are all
    kept. No other pair is formed, and the result is exact. ``alpha`` is a number or ``(query_id, alpha)``. With
    alpha 1 the cosine does not count and rules without hits rank by id: a query with fewer than k hits finds k such
    rules among the 2k highest ids.
    """
    if isinstance(alpha, float) and alpha == 1.0:
        last = rule_vecs.select("id").orderBy(F.desc("id")).limit(2 * k).agg(F.collect_list("id")).scalar()
        near = query_vecs.select(F.col("id").alias("query_id"), F.explode(last).alias("rule_id"))
    else:
        near = cosine_topk(query_vecs, rule_vecs, k, high_id_first=True)
        near = near.select("query_id", F.col("item_id").alias("rule_id"))
    candidates = near.join(kw, ["query_id", "rule_id"], "full_outer").withColumn("kw", F.coalesce("kw", F.lit(0)))
    left = small_side(query_vecs.select(F.col("id").alias("query_id"), F.col("vec").alias("qv")))
    right = small_side(rule_vecs.select(F.col("id").alias("rule_id"), F.col("vec").alias("rv")))
    scored = candidates.join(left, "query_id").join(right, "rule_id")
    scored = scored.select("query_id", "rule_id", "kw", dot(F.col("qv"), F.col("rv")).alias("cos"))
    top = kw.groupBy("query_id").agg(F.max("kw").alias("top_kw"))
    scored = scored.join(top, "query_id", "left").withColumn("top_kw", F.coalesce("top_kw", F.lit(0)))
    if isinstance(alpha, DataFrame):
        scored = scored.join(alpha, "query_id")
    else:
        scored = scored.withColumn("alpha", F.lit(float(alpha)))
    fused = F.col("alpha") * F.col("kw") / (F.col("top_kw") + 1e-9) + (1 - F.col("alpha")) * (F.col("cos") + 1) / 2
    return scored.select("query_id", "rule_id", "kw", "cos", fused.alias("score"))


def hybrid_topk(
    kw: DataFrame, query_vecs: DataFrame, rule_vecs: DataFrame, k: int = 5, alpha: float = 0.5, mode: str = "hybrid"
) -> DataFrame:
    """Best ``k`` rules per query; ``mode`` keyword, semantic or hybrid; equal scores put the higher id first."""
    weight = {"keyword": 1.0, "semantic": 0.0, "hybrid": alpha}[mode]
    scored = hybrid_scores(kw, query_vecs, rule_vecs, weight, k)
    return top_k(scored, k, order=[F.round("score", TIE_DIGITS).desc(), F.col("rule_id").desc()])


def hybrid_dynamic_topk(
    kw: DataFrame, query_vecs: DataFrame, rule_vecs: DataFrame, sentences: DataFrame, k: int = 3
) -> DataFrame:
    """As ``hybrid_topk`` with alpha 0.7 for sentences under five words and 0.3 otherwise."""
    n_words = F.size(split_blank(F.col("text"), any_whitespace=True))
    alpha = sentences.select("query_id", F.when(n_words < 5, 0.7).otherwise(0.3).alias("alpha"))
    scored = hybrid_scores(kw, query_vecs, rule_vecs, alpha, k)
    return top_k(scored, k, order=[F.round("score", TIE_DIGITS).desc(), F.col("rule_id").desc()])


def rerank_topk(candidates: DataFrame, query_vecs: DataFrame, rule_vecs: DataFrame) -> DataFrame:
    """The best candidate of each query by a second embedding; equal scores keep the better first rank."""
    left = small_side(query_vecs.select(F.col("id").alias("query_id"), F.col("vec").alias("qv")))
    right = small_side(rule_vecs.select(F.col("id").alias("rule_id"), F.col("vec").alias("rv")))
    scored = candidates.join(left, "query_id").join(right, "rule_id").select(
        "query_id", "rule_id", F.col("rank").alias("first_rank"), dot(F.col("qv"), F.col("rv")).alias("rerank_score")
    )
    order = [F.round("rerank_score", TIE_DIGITS).desc(), F.col("first_rank").asc()]
    return top_k(scored, 1, order=order).drop("rank")


def rule_text(rules: DataFrame) -> DataFrame:
    """Text to embed: description, newline, example sentences joined by spaces."""
    sentences = F.array_join(F.transform("examples", lambda e: F.coalesce(e["za"], F.lit(""))), " ")
    description = F.coalesce("grammar_description", F.lit(""))
    return rules.select("rule_id", F.concat(description, F.lit("\n"), sentences).alias("text"))


def embedding_stats(vectors: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """``(pos, mean, std)`` per dimension, sample standard deviation."""
    cells = vectors.select(F.posexplode(F.col(vec_col).cast("array<double>")).alias("pos", "x"))
    return cells.groupBy("pos").agg(F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"))


def init_vectors(vectors: DataFrame, n: int, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 42) -> DataFrame:
    """Old rows plus ``n`` new rows drawn per dimension from a normal distribution with the old mean and deviation."""
    stats = embedding_stats(vectors, vec_col).agg(F.array_sort(F.collect_list(F.struct("pos", "mean", "std"))).alias("s"))
    last = vectors.agg(F.max(id_col)).scalar()
    fresh = vectors.sparkSession.range(1, n + 1).withColumn("stats", stats.scalar()).withColumn("new_id", last + F.col("id"))
    cells = fresh.select("new_id", F.inline("stats")).withColumn(
        "x", (F.col("mean") + F.col("std") * _normal(F.concat_ws(":", F.lit(seed), "new_id", "pos"))).cast("float")
    )
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    new = cells.groupBy("new_id").agg(F.transform(ordered, lambda c: c["x"]).alias(vec_col))
    return vectors.select(id_col, vec_col).unionByName(new.withColumnRenamed("new_id", id_col))


def _normal(key: Column) -> Column:
    """Standard normal draw from a key (Box-Muller), the same under any partitioning."""

    def uniform(salt: str) -> Column:
        return (F.pmod(F.xxhash64(F.concat(key, F.lit(salt))), F.lit(2**52)) + 0.5) / F.lit(float(2**52))

    return F.sqrt(-2 * F.log(uniform("a"))) * F.cos(2 * F.pi() * uniform("b"))
