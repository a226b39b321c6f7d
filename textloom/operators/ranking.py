"""BM25 where the documents lie: every task scores its own documents and passes on its best of each query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

TIE_DIGITS = 9
"""Scores are ranked after rounding, so that the order of a distributed sum cannot break a tie."""


class Queries:
    """Weighted query terms ``(query_id, token, qtf, idf, avg_len)``, sorted by query, as arrays for the tasks."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by([("query_id", "ascending"), ("token", "ascending")]).combine_chunks()
        ids = rows["query_id"].combine_chunks()
        self.ids = pc.unique(ids)
        self.tokens = pc.unique(rows["token"].combine_chunks())
        self.terms = pc.index_in(rows["token"].combine_chunks(), value_set=self.tokens).to_numpy()
        self.weights = rows["qtf"].to_numpy() * rows["idf"].to_numpy()
        self.starts = np.searchsorted(pc.index_in(ids, value_set=self.ids).to_numpy(), np.arange(len(self.ids) + 1))
        self.avg_len = float(rows["avg_len"][0].as_py()) if rows.num_rows else 1.0


class Best:
    """The best ``k`` documents of every query so far; blocks that cannot better them are passed over.

    The highest share that a term has in any document of a block bounds the scores of the whole block from above.
    """

    def __init__(self, queries: Queries, k: int, k1: float, b: float) -> None:
        self.queries, self.k, self.k1, self.b = queries, k, k1, b
        count = len(queries.ids)
        self.docs = [np.empty(0, np.int64)] * count
        self.scores = [np.empty(0)] * count
        self.least = np.full(count, -np.inf)
        self.passed_over = 0

    def add(self, pair_ids: np.ndarray, dl: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> None:
        """A block: lengths by document, and its postings of query terms as (document of the block, term, tf)."""
        q = self.queries
        order = np.argsort(term, kind="stable")
        doc, term, tf = doc[order], term[order], tf[order]
        share = tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * dl[doc] / q.avg_len))
        starts = np.searchsorted(term, np.arange(len(q.tokens) + 1))
        filled = np.flatnonzero(np.diff(starts))
        if not len(filled):
            return
        highest = np.zeros(len(q.tokens))
        highest[filled] = np.maximum.reduceat(share, starts[filled])
        bound = np.add.reduceat(np.maximum(q.weights * highest[q.terms], 0), q.starts[:-1])
        met = np.add.reduceat(highest[q.terms] > 0, q.starts[:-1]) > 0
        open_queries = met & (np.round(bound, TIE_DIGITS) + 10.0**-TIE_DIGITS >= self.least)
        self.passed_over += int(met.sum() - open_queries.sum())
        for i in np.flatnonzero(open_queries).tolist():
            parts = [(t, w) for t, w in zip(q.terms[q.starts[i] : q.starts[i + 1]].tolist(), q.weights[q.starts[i] : q.starts[i + 1]].tolist()) if highest[t] > 0]
            docs = np.concatenate([doc[starts[t] : starts[t + 1]] for t, _ in parts])
            worth = np.concatenate([w * share[starts[t] : starts[t + 1]] for t, w in parts])
            hit = np.unique(docs)
            self._keep(i, pair_ids[hit], np.bincount(docs, worth, len(dl))[hit])

    def _keep(self, i: int, docs: np.ndarray, scores: np.ndarray) -> None:
        docs, scores = np.concatenate([self.docs[i], docs]), np.concatenate([self.scores[i], scores])
        rounded = np.round(scores, TIE_DIGITS)
        if len(docs) > self.k:
            near = np.flatnonzero(rounded >= -np.partition(-rounded, self.k - 1)[self.k - 1])
            docs, scores, rounded = docs[near], scores[near], rounded[near]
        order = np.lexsort((-docs, -rounded))[: self.k]
        self.docs[i], self.scores[i] = docs[order], scores[order]
        if len(order) == self.k:
            self.least[i] = rounded[order[-1]]


def local_topk(weighted: pa.Table, forward: DataFrame, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """``(query_id, pair_id, score)``: at least the best ``k`` documents of each query, at most ``k`` from each task.

    ``forward`` is ``(pair_id, dl, runs)`` with a whole document in a row, so scores need no exchange; ``weighted``
    is the measured table of query terms. Equal scores put the higher id first.
    """
    kind = forward.sparkSession.createDataFrame(weighted.select(["query_id"]).slice(0, 0)).schema["query_id"].dataType.simpleString()
    queries = Queries(weighted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(queries, k, k1, b)
        for batch in batches:
            runs = batch["runs"]
            flat = runs.flatten()
            term = pc.fill_null(pc.index_in(flat.field("token"), value_set=queries.tokens), -1).to_numpy()
            at = np.flatnonzero(term >= 0)
            doc = np.repeat(np.arange(batch.num_rows), pc.fill_null(pc.list_value_length(runs), 0).to_numpy())
            best.add(batch["pair_id"].to_numpy(), batch["dl"].to_numpy(), doc[at], term[at], flat.field("tf").to_numpy()[at].astype(float))
        sizes = np.array([len(x) for x in best.docs], np.int64)
        if sizes.sum():
            owners = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            columns = [queries.ids.take(owners), pa.array(np.concatenate(best.docs)), pa.array(np.concatenate(best.scores))]
            yield from pa.Table.from_arrays(columns, ["query_id", "pair_id", "score"]).to_batches()

    if not len(queries.ids) or k < 1:
        return forward.sparkSession.createDataFrame([], f"query_id {kind}, pair_id bigint, score double")
    found = forward.where("dl > 0 and pair_id is not null").select("pair_id", "dl", "runs")
    return found.mapInArrow(run, f"query_id {kind}, pair_id bigint, score double")
