"""Two tokenizers over the same texts: groups between common token ends, linked id pairs and their corpus counts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.bpe import byte_symbols
from textloom.llm.support import byte_list, in_batches, spread_join, written

CHUNK_LINKS = 1 << 19
CHUNK_TEXTS = 20_000
"""Links or texts after which a chunk is closed: the unit in which pair counts are asked for. A text is never cut."""

LATIN = 0x250
LONG = 100_000
"""Texts of code points below ``LATIN`` and at most ``LONG`` characters take the fast encoder of the same merges."""

# Fixed: the splitting pattern of the public byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_LOADED: dict[tuple[str, str], "Aligner"] = {}


class Aligner:
    """Both encoders of a worker and the bytes of every id."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.byte_level = Tokenizer.from_file(byte_path)
        self.byte_level.encode_special_tokens = True
        self.byte_level.no_truncation()
        self.byte_level.no_padding()
        plain = {c: bytes([b]) for b, c in byte_symbols().items()}
        spelled = lambda t: b"".join(plain[c] for c in t) if all(c in plain for c in t) else t.encode()
        vocab = self.byte_level.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = spelled(token)
        with open(byte_path, encoding="utf-8") as source:
            model = json.load(source)["model"]
        merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # Merges in order of ids are ranks, as the fast encoder needs them.
        self.fast = None
        if [model["vocab"][t] for t in merged] == list(range(256, 256 + len(merged))):
            ranks = {spelled(t): i for t, i in model["vocab"].items() if i < 256 + len(merged)}
            self.fast = tiktoken.Encoding("byte level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        self.b_bytes = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:-1], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        # Decimal ids followed by what separates them: within a part, at a part's end.
        self.shown = [[[f"{i}{mark}" for i in range(len(side))] for mark in marks] for side, marks in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]

    def a_ids(self, text: str) -> list[int]:
        if self.fast is not None and len(text) <= LONG and (text.isascii() or ord(max(text)) < LATIN):
            return self.fast(f" {text}")
        return self.byte_level.encode(f" {text}", add_special_tokens=False).ids

    def align(self, text: str, b_ids: list[int] | None = None) -> tuple[int, int, int, str, np.ndarray, np.ndarray] | None:
        """``(n_a, n_b, groups, digest, linked a ids, linked b ids)``; None if the tokens do not spell the text."""
        a_ids = self.a_ids(text)
        b_ids = self.pieces.encode(text, num_threads=1) if b_ids is None else b_ids
        want = f" {text}".encode()
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != want or b"".join(map(self.b_bytes.__getitem__, b_ids)) != want:
            return None
        a, b = np.array(a_ids), np.array(b_ids)
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        shared = np.zeros(len(want) + 1, np.int8)
        shared[a_ends] = 1
        shared[b_ends] += 2
        a_cut, b_cut = shared[a_ends] == 3, shared[b_ends] == 3
        # Every token has bytes, so just one of either side ends at a common end.
        groups = int(a_cut.sum())
        of_group = np.concatenate([2 * (np.cumsum(a_cut) - a_cut), 2 * (np.cumsum(b_cut) - b_cut) + 1])
        (a_within, a_last), (b_within, b_last) = self.shown
        texts = [(a_last if cut else a_within)[i] for i, cut in zip(a_ids, a_cut.tolist())]
        texts += [(b_last if cut else b_within)[i] for i, cut in zip(b_ids, b_cut.tolist())]
        joined = "".join(map(texts.__getitem__, np.argsort(of_group, kind="stable").tolist()))[:-1]
        return len(a), len(b), groups, hashlib.sha256(joined.encode()).hexdigest(), a[a_cut], b[b_cut]


def aligner(byte_path: str, piece_path: str) -> Aligner:
    if (byte_path, piece_path) not in _LOADED:
        _LOADED[byte_path, piece_path] = Aligner(byte_path, piece_path)
    return _LOADED[byte_path, piece_path]


_TEXT = "array<struct<same:string,n_a:bigint,n_b:bigint,n_groups:bigint,groups_sha256:string>>"
_ALIGNED = f"chunk bigint, texts {_TEXT}, pairs array<bigint>, counts array<bigint>, text_at array<int>, pair_at array<int>, uses array<int>"


def _aligned(texts: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """A row per chunk of distinct texts (``same, text, copies``).

    ``texts`` has each text's measures; ``pairs`` the distinct id pairs ``a * 2**32 + b`` (ids have 32 bits) with
    ``counts`` weighted by copies; entry by entry, text ``text_at`` links pair ``pair_at`` ``uses`` times.
    """
    measures = pa.struct([("same", pa.string()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())])
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema(
        [("chunk", pa.int64()), ("texts", pa.list_(measures)), ("pairs", longs), ("counts", longs), ("text_at", ints), ("pair_at", ints), ("uses", ints)]
    )

    def closed(name: int, held: list[dict], links: list[np.ndarray], copies: list[int]) -> pa.RecordBatch:
        sizes = [len(x) for x in links]
        pairs, place = np.unique(np.concatenate(links), return_inverse=True)
        entry, uses = np.unique(np.repeat(np.arange(len(links)), sizes) * np.int64(len(pairs)) + place, return_counts=True)
        text_at, pair_at = np.divmod(entry, max(len(pairs), 1))
        counts = np.zeros(len(pairs), np.int64)
        np.add.at(counts, pair_at, uses * np.array(copies, np.int64)[text_at])
        return pa.record_batch([pa.array([x], f.type) for x, f in zip((name, held, pairs, counts, text_at, pair_at, uses), schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(byte_path, piece_path)
        held, links, copies, size = [], [], [], 0
        name = TaskContext.get().partitionId() << 32
        for batch in batches:
            for same, data, n in zip(batch["same"].to_pylist(), byte_list(batch["text"]), batch["copies"].to_pylist()):
                found = both.align(data.decode("utf-8")) if data else None
                n_a, n_b, groups, digest, a, b = found or (0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
                held.append({"same": same, "n_a": n_a, "n_b": n_b, "n_groups": groups, "groups_sha256": digest})
                links.append(a << 32 | b)
                copies.append(n)
                size += len(a)
                if size >= CHUNK_LINKS or len(held) >= CHUNK_TEXTS:
                    yield closed(name, held, links, copies)
                    held, links, copies, size, name = [], [], [], 0, name + 1
        if held:
            yield closed(name, held, links, copies)

    return texts.select("same", "text", "copies").mapInArrow(run, _ALIGNED)


_MEASURES = "same string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _measured(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """``_MEASURES`` of every text, from its chunk's entries and the chunk's answers (``pair, count, best``)."""
    fields = [("same", pa.string()), *((x, pa.int64()) for x in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(batch.num_rows):
                    texts = batch["texts"][i].as_py()
                    pairs, text_at, pair_at, uses = (
                        np.asarray(batch[c][i].values) if batch[c][i].is_valid else np.empty(0, np.int64) for c in ("pairs", "text_at", "pair_at", "uses")
                    )
                    told = batch["answers"][i].values
                    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
                    if told is not None and len(told):
                        at = np.searchsorted(pairs, np.asarray(told.field("pair")))
                        count[at] = np.asarray(told.field("count"))
                        best[at] = np.asarray(told.field("best").cast(pa.int8()))
                    totals = np.zeros((3, len(texts)), np.int64)
                    for row, worth in zip(totals, (uses, uses * best[pair_at], uses * count[pair_at])):
                        np.add.at(row, text_at, worth)
                    for x, n_links, n_best, count_sum in zip(texts, *totals.tolist()):
                        yield x["same"], x["n_a"], x["n_b"], x["n_groups"], n_links, n_best, count_sum, x["groups_sha256"]

        yield from in_batches(rows(), schema)

    met = chunks.drop("counts").join(answers, "chunk", "left")
    return met.select("texts", "pairs", "text_at", "pair_at", "uses", "answers").mapInArrow(run, _MEASURES)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``(pair, count, best)`` over the corpus; ``best`` where no pair of the same second id has a higher count."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.pairs", "x.counts")
    counts = written(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("counts").alias("count")), "pair-counts")
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(second.alias("b")).agg(F.max("count").alias("highest"))
    # One row per id of the second vocabulary, so the vocabulary bounds what is sent.
    return counts.withColumn("b", second).join(F.broadcast(highest), "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` for every row of ``docs``.

    Whole texts are shuffled, each distinct one is encoded by both tokenizers once, and its pair counts weigh its
    copies. Groups end where tokens of both end; the last tokens of a group are linked. Texts that are null or empty,
    or that the tokens do not spell byte for byte behind a blank, have zeros and no digest. Null and repeated ids get
    their text's measures; other columns are left out; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    same = F.sha2("text", 256)
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies")).withColumn("same", same)
    chunks = written(_aligned(distinct, byte_path, piece_path), "aligned")
    asked = chunks.select("chunk", F.explode("pairs").alias("pair"))
    told = asked.join(pair_counts(chunks), "pair")
    answers = told.groupBy("chunk").agg(F.collect_list(F.struct("pair", "count", "best")).alias("answers"))
    measures = written(_measured(chunks, answers), "measures")
    members = written(texts.select("doc_id", same.alias("same"), F.monotonically_increasing_id().alias("row")), "members")
    return spread_join(members, measures, "same", "row").select("doc_id", *[c for c in measures.columns if c != "same"])
