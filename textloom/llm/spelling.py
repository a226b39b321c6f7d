"""Words one edit apart, by dense tiles of code-point matrices, and the forms that frequent words give to rare ones."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, in_batches, keyed_texts, spread_join, written
from textloom.session import spread

RUN = "[A-Za-zÀ-ÿ]+"
SLIP = 97
"""A word loses a code point where this divides the checksum of its document and itself."""

HELD_WORDS = 300_000
HELD_BYTES = 64 << 20
"""Distinct words and their bytes that a task counts before it passes them on."""

BLOCK = 1024
CELLS = 4 << 20
"""Words of a block, fewer if their code points exceed ``CELLS``; a tile holds two blocks."""

SECTION = 256
"""Rows of the sub-blocks that are compared at once; small tiles share a section."""


def slipped(word: str, checksum: int) -> str:
    if checksum % SLIP:
        return word
    at = checksum % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3) -> DataFrame:
    """``(word, n)`` of the words of whole texts: runs of Latin letters, A-Z lowered, some with a code point deleted.

    With the unsigned crc32 ``h`` of ``<doc_id>:<word>``, a null id as no digits, the code point ``h % length`` goes
    if ``SLIP`` divides ``h``. Words of at least ``shortest`` code points with at least ``least`` occurrences stay.
    Null and empty texts have none; repeated rows count each; other columns are left out.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(RUN)

        def rows() -> Iterator[tuple]:
            held: Counter[str] = Counter()
            size = 0
            for batch in batches:
                for doc_id, data in zip(batch["doc_id"].to_pylist(), byte_list(batch["text"])):
                    begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    # Only A-Z change: bytes of other letters are not lowered.
                    for word, n in Counter(runs.findall(data.lower().decode("utf-8"))).items():
                        if len(word) < shortest:
                            continue
                        checksum = zlib.crc32(word.encode(), begun)
                        if not checksum % SLIP:
                            word = slipped(word, checksum)
                            if len(word) < shortest:
                                continue
                        if word not in held:
                            size += len(word)
                        held[word] += n
                    if len(held) >= HELD_WORDS or size >= HELD_BYTES:
                        yield from held.items()
                        held, size = Counter(), 0
            yield from held.items()

        yield from in_batches(rows(), schema, lambda r: len(r[0]))

    counted = keyed_texts(docs).mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _leading(a: np.ndarray, b: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Columns from the left in which rows of ``a`` and ``b`` agree, for the pairs ``alive``."""
    alive = alive.copy()
    total = np.zeros(alive.shape, np.int32)
    for x, y in zip(a.T, b.T):
        alive &= x[:, None] == y
        if not alive.any():
            break
        total += alive
    return total


class Section:
    """Padded matrices of words of ``longer`` and of one code point less, several whole tiles of them."""

    def __init__(self, longer: int, by_prefix: bool, rows: list[tuple]) -> None:
        self.longer, self.by_prefix = longer, by_prefix
        self.words = [r[0] for r in rows]
        self.n = np.array([r[1] for r in rows], np.int64)
        self.tile = np.array([r[2] for r in rows])
        self.block = np.array([r[3] for r in rows])
        self.within = np.array([r[4] for r in rows])
        self.whole = np.array([len(w) == longer for w in self.words])
        codes = np.array(self.words, f"U{longer}").view(np.uint32).reshape(len(rows), longer)
        codes = codes.astype(np.uint8 if codes.max() < 255 else np.uint32) + 1
        codes[~self.whole, -1] = 0
        self.left = codes
        self.right = codes.copy()
        self.right[~self.whole, 1:], self.right[~self.whole, 0] = codes[~self.whole, :-1], 0
        self.right = self.right[:, ::-1]

    def _compared(self, a: slice, b: slice) -> tuple[np.ndarray, np.ndarray]:
        met = (self.tile[a, None] == self.tile[b]) & (self.whole[a, None] | self.whole[b])
        met &= self.within[a, None] | (self.block[a, None] != self.block[b])
        if a == b:
            met &= np.tri(*met.shape, dtype=bool).T & ~np.eye(len(met), dtype=bool)
        prefix = _leading(self.left[a], self.left[b], met)
        # A pair that shares both halves is found by its prefix alone.
        met &= (prefix >= self.longer // 2) == self.by_prefix
        suffix = _leading(self.right[a], self.right[b], met)
        i, j = np.nonzero(met & (prefix + suffix >= self.longer - 1))
        return i + a.start, j + b.start

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the pairs whose common prefix and suffix reach the longer length minus one."""
        found = [(np.empty(0, np.int64),) * 2]
        parts = [slice(i, min(i + SECTION, len(self.words))) for i in range(0, len(self.words), SECTION)]
        for p, a in enumerate(parts):
            for b in parts[p:]:
                if self.tile[b.start] > self.tile[a.stop - 1]:
                    break
                found.append(self._compared(a, b))
        return tuple(np.concatenate(x) for x in zip(*found))

    def summary(self) -> Iterator[tuple]:
        """``(word, near, best_n, best_word)``: how many near words, and the most frequent, by code points in ties."""
        i, j = self.pairs()
        if not len(i):
            return
        source, other = np.concatenate([i, j]), np.concatenate([j, i])
        rank = np.empty(len(self.words), np.int64)
        rank[sorted(range(len(self.words)), key=self.words.__getitem__)] = np.arange(len(self.words))
        order = np.lexsort((rank[other], -self.n[other], source))
        source, other = source[order], other[order]
        first = np.flatnonzero(np.diff(source, prepend=-1))
        for s, o, near in zip(source[first].tolist(), other[first].tolist(), np.diff(first, append=len(source)).tolist()):
            yield self.words[s], near, int(self.n[o]), self.words[o]


def _keyed(words: DataFrame) -> DataFrame:
    """Each word under the halves that a near word shares with it, as the longer and as the shorter of the two.

    Of a pair with longer length ``l``, prefix and suffix together reach ``l - 1``, so one of them reaches ``l // 2``.
    """
    length = F.length("word")
    half = lambda l: F.floor(l / 2).cast("int")
    keys = [
        F.struct(l.alias("longer"), F.lit(side).alias("by_prefix"), (F.left("word", half(l)) if side else F.right("word", half(l))).alias("half"))
        for l in (length, length + 1)
        for side in (True, False)
    ]
    each = words.where(length > 0).select("word", "n", F.explode(F.array(*keys)).alias("k")).select("word", "n", "k.*")
    return each.withColumn("key", F.xxhash64("longer", "by_prefix", "half")).drop("half")


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` for words of ``(word, n)``, each once, that have near words.

    Near words differ by one inserted, deleted or replaced code point; ``best`` has the largest ``n``, then the
    smallest code points. Words meet in groups of one shared half, cut into blocks; each pair of blocks is a tile that
    any task may take, so a group of any size is spread. Null words and an empty table give no rows.
    """
    keyed = _keyed(words.select("word", "n"))
    own = F.length("word") == F.col("longer")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"), F.max(own).alias("open")).where("size > 1 and open").drop("open")
    room = F.greatest(F.lit(8), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / F.col("longer"))))
    sized = spread_join(keyed, sizes, "key", "word").withColumn("blocks", F.ceil(F.col("size") / room).cast("int"))
    dealt = sized.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    order = ["longer", "by_prefix", "key", "low", "high"]
    tiles = dealt.select("word", "n", "longer", "by_prefix", "key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block")
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sections() -> Iterator[Section]:
            held: list[tuple] = []
            kind = last = None
            for batch in batches:
                for word, n, longer, by_prefix, key, low, high, block in zip(*(c.to_pylist() for c in batch.columns)):
                    if (key, low, high, longer, by_prefix) != last:
                        if held and ((longer, by_prefix) != kind or len(held) >= SECTION or len(held) * longer >= CELLS):
                            yield Section(*kind, held)
                            held = []
                        number, kind, last = len(held), (longer, by_prefix), (key, low, high, longer, by_prefix)
                    held.append((word, n, number, block, low == high))
            if held:
                yield Section(*kind, held)

        yield from in_batches((row for s in sections() for row in s.summary()), schema)

    met = spread(tiles, *order).sortWithinPartitions(*order).mapInArrow(run, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("top")
    return met.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``(word, form)``: the end of each path of forms, whose steps double with every round."""
    paths = written(forms.select("word", F.col("form").alias("root")), "paths")
    while True:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = spread_join(paths, further, "root", "word", "left")
        paths = written(longer.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "paths")
        if paths.where("moved").isEmpty():
            return paths.select("word", "root")
        paths = paths.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for every word of ``word_counts``.

    A word's form is its near word of largest ``n`` if that is at least twice its own, else null. Counts at least
    double along a path of forms, so paths end; ``root`` is the last word, or the word itself.
    """
    words = written(word_counts(docs), "words")
    near = near_words(words)
    joined = words.join(near, "word", "left")
    formed = F.col("best_n") >= 2 * F.col("n")
    forms = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n")
    )
    forms = written(forms, "forms")
    ends = roots(forms.where("form is not null"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
