"""Quality classifier: a weak-label model fitted by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, in_batches, keyed_texts, written

DIMENSIONS = 1 << 14
SAMPLE = 6_000
"""Most weakly labelled rows that the scorer is fitted on, drawn by a hash of id and text."""

DRAWS = 1 << 40

# In the order of the signs of a vote pattern. Most only object; the last two also vouch, and overlap with all.
LABELLERS = ["capitals", "symbols", "shouts", "cells", "repeats", "variety", "length", "plain words", "flow"]
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_LETTERS = _UPPER + _LOWER + bytes(range(48, 58)) + b"'-\"()" + bytes(range(128, 256))
_PLAIN = {b"", b".", b",", b";", b":", b"?"}


def statistics(data: bytes) -> tuple[np.ndarray, list[bytes]]:
    """Shares that the labellers look at, in their order, and the words."""
    words = data.split()
    n = max(1, len(words))
    upper = len(data) - len(data.translate(None, _UPPER))
    capitals = upper / max(1, upper + len(data) - len(data.translate(None, _LOWER)))
    symbols = (len(data) - len(data.translate(None, b"#$%&*"))) / max(1, len(data))
    shouts = data.count(b"!!") / n
    cells = data.count(b" | ") / n
    repeats = sum(map(eq, words, words[1:])) / n
    variety = len(set(words)) / n
    marks = b" ".join(words).translate(None, _LETTERS).split(b" ")
    plain = sum(c for m, c in Counter(marks).items() if m in _PLAIN) / n if words else 0.0
    return np.array([capitals, symbols, shouts, cells, repeats, variety, n, plain, plain - repeats]), words


def votes(x: np.ndarray) -> str:
    """One sign per labeller: ``-`` low quality, ``+`` good, ``0`` abstains."""
    capitals, symbols, shouts, cells, repeats, variety, n, plain, flow = x
    objects = [capitals > 0.5, symbols > 0.05, shouts > 0.2, cells > 0.15, repeats > 0.15, n > 40 and variety < 0.2, n < 3]
    return "".join("-" if o else "0" for o in objects) + "".join("-" if v < 0.7 else "+" if v > 0.85 else "0" for v in (plain, flow))


def fit_accuracies(patterns: dict[str, int], rounds: int = 100) -> tuple[dict[str, float], np.ndarray, float]:
    """Posterior chance of good quality per vote pattern, the labellers' vote chances, and the prior.

    ``patterns`` counts each pattern over all rows; at most ``3 ** labellers`` of them.
    """
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], float)
    vote = np.array([["-0+".index(c) for c in p] for p in names])
    table = np.empty((2, vote.shape[1], 3))
    table[0], table[1] = [0.4, 0.5, 0.1], [0.02, 0.5, 0.48]
    prior = 0.85
    post = np.full(len(names), prior)
    for _ in range(rounds):
        logs = np.stack([np.log(table[c])[np.arange(vote.shape[1]), vote].sum(1) for c in (0, 1)])
        odds = logs[1] - logs[0] + np.log(prior / (1 - prior))
        post = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
        for c, share in ((0, weight * (1 - post)), (1, weight * post)):
            for v in range(3):
                table[c, :, v] = ((vote == v) * share[:, None]).sum(0) + 1.0
            table[c] /= table[c].sum(1, keepdims=True)
        prior = float(np.clip((weight * post).sum() / max(weight.sum(), 1e-9), 0.01, 0.99))
    return dict(zip(names, post.tolist())), table, prior


class Shapes(dict):
    """Class of a word: its case, the mark at its end, its length; short words are remembered up to a fixed number."""

    def __missing__(self, word: bytes) -> bytes:
        kind = b"A" if word.isupper() else b"a" if word.islower() else b"m" if word[:1].isupper() else b"s"
        shape = b"%b%b%d" % (kind, word[-2:] if not word[-1:].isalnum() and word[-1] < 128 else b"", min(len(word), 12) // 3)
        if len(word) <= 64:
            if len(self) >= 300_000:
                self.clear()
            self[word] = shape
        return shape


_SHAPES = Shapes()


def features(data: bytes) -> dict[int, float]:
    """Hashed shares: shapes of words, pairs of neighbouring shapes, words that repeat the one before."""
    words = data.split()
    shapes = list(map(_SHAPES.__getitem__, words))
    n = max(1, len(words))
    counts = {s: c for s, c in Counter(shapes).items()}
    counts |= {a + b"_" + b: c for (a, b), c in Counter(zip(shapes, shapes[1:])).items()}
    counts[b"="] = sum(map(eq, words, words[1:]))
    out: dict[int, float] = {}
    for key, c in counts.items() if words else ():
        h = zlib.crc32(key) % DIMENSIONS
        out[h] = out.get(h, 0.0) + (c / n) ** 0.5
    return out


def fit_scorer(rows: list[tuple[dict[int, float], float]], passes: int = 300, rate: float = 2.0, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the bias."""
    index = np.array([h for x, _ in rows for h in x], np.int64)
    value = np.array([v for x, _ in rows for v in x.values()], float)
    row = np.repeat(np.arange(len(rows)), [len(x) for x, _ in rows])
    label = np.array([y for _, y in rows])
    weights, total = np.zeros(DIMENSIONS + 1), np.full(DIMENSIONS + 1, 1e-8)
    for _ in range(passes):
        z = np.bincount(row, value * weights[index], len(rows)) + weights[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - label
        slope = np.append(np.bincount(index, value * error[row], DIMENSIONS), error.sum()) / max(1, len(rows)) + decay * weights
        total += slope**2
        weights -= rate * 0.05 * slope / np.sqrt(total)
    return weights


def _vote_rows(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("votes", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, votes(statistics(d)[0])) for b in batches for i, d in zip(b["doc_id"].to_pylist(), byte_list(b["text"])))
        yield from in_batches(rows, schema)

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, votes string")


def fit(docs: DataFrame, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the scorer. Votes are counted over all rows; the scorer sees at most ``sample`` rows.

    Rows whose draw is below ``sample`` in the number of rows are made features where they are; no text is moved.
    """
    voted = written(_vote_rows(docs), "votes")
    patterns = {r["votes"]: r["count"] for r in voted.groupBy("votes").count().collect()}
    if not patterns:
        return np.zeros(DIMENSIONS + 1)
    posterior, _, _ = fit_accuracies(patterns)
    drawn = keyed_texts(docs).withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(DRAWS)))
    chosen = drawn.where(F.col("draw") < DRAWS * sample // max(sample, sum(patterns.values())))
    schema = pa.schema([("draw", pa.int64()), ("keys", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("label", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for draw, data in zip(batch["draw"].to_pylist(), byte_list(batch["text"])):
                    x = features(data)
                    yield draw, list(x), list(x.values()), posterior.get(votes(statistics(data)[0]), 0.5)

        yield from in_batches(rows(), schema)

    described = chosen.mapInArrow(run, "draw bigint, keys array<int>, values array<double>, label double")
    rows = described.orderBy("draw").limit(sample).collect()
    return fit_scorer([(dict(zip(r["keys"], r["values"])), r["label"]) for r in rows])


def score(data: bytes, weights: np.ndarray) -> float:
    """Chance of good quality; a text without words has 0."""
    x = features(data)
    if not x:
        return 0.0
    z = sum(weights[h] * v for h, v in x.items()) + weights[-1]
    return float(1 / (1 + np.exp(-np.clip(z, -60, 60))))


def classify(docs: DataFrame, weights: np.ndarray | None = None, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, score, accepted)`` for every row; null and empty texts score 0 and are rejected.

    Repeated rows and null ids give a row each; other columns are left out.
    """
    weights = fit(docs) if weights is None else weights
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((i, score(d, weights)) for b in batches for i, d in zip(b["doc_id"].to_pylist(), byte_list(b["text"])))
        yield from in_batches(rows, schema)

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, score double").withColumn("accepted", F.col("score") >= threshold)


def accepted(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier accepts."""
    weights = fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([score(d, weights) >= threshold for d in byte_list(batch["text"])], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
