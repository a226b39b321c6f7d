"""Byte-level BPE: merges from a priority queue over a linked list of symbols, and decoding by concatenation."""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, in_batches, keyed_texts

KEEP_BYTES = 64
KEEP_PARTS = 200_000
"""Remembered pre-tokens of a worker, short ones only; when full, the memory starts anew."""

_SPACE = r"[\t-\r \x85\xa0  -     　]"
_DARK = r"[^\t-\r \x85\xa0  -     　\p{L}\p{N}]"
# Fixed: the splitting pattern of the public byte-level vocabulary, with white space by its Unicode property.
SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?{_DARK}+|{_SPACE}+(?!{_SPACE[:1]}^{_SPACE[1:]})|{_SPACE}+"

_LOADED: dict[str, "BytePairs"] = {}


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class BytePairs:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as source:
            file = json.load(source)
        model = file["model"]
        plain = {c: b for b, c in byte_symbols().items()}
        ids = model["vocab"]
        self.bytes_of = {i: bytes(plain[c] for c in token) for token, i in ids.items()}
        self.byte_id = [ids[c] for _, c in sorted(byte_symbols().items())]
        #: (left id, right id) to (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        marks = sorted(self.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None
        self.split = regex.compile(SPLIT)
        self.known: dict[str, bytes] = {}

    def merged(self, data: bytes) -> list[int]:
        """Ids of one pre-token.

        The queue holds (rank, left position, left id, right id); an entry whose symbols have since changed is stale
        and skipped. ``after`` and ``before`` link the symbols still standing.
        """
        ids = [self.byte_id[b] for b in data]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank_of = self.merges.get
        queue = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(n - 1) if (r := rank_of((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, left, right, whole = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = whole, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if r := rank_of((whole, ids[k])):
                    heapq.heappush(queue, (r[0], i, whole, ids[k], r[1]))
            h = before[i]
            if h >= 0 and (r := rank_of((ids[h], whole))):
                heapq.heappush(queue, (r[0], h, ids[h], whole, r[1]))
        return [x for x in ids if x >= 0]

    def _part(self, part: str) -> bytes:
        packed = self.known.get(part)
        if packed is None:
            data = part.encode("utf-8")
            packed = np.array(self.merged(data), "<u4").tobytes()
            if len(data) <= KEEP_BYTES:
                if len(self.known) >= KEEP_PARTS:
                    self.known.clear()
                self.known[part] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Packed little-endian 32-bit ids of a whole text; special tokens in the text become their ids."""
        pieces = self.marks.split(text) if self.marks else [text]
        out: list[bytes] = []
        for piece in pieces:
            if piece in self.special:
                out.append(np.array([self.special[piece]], "<u4").tobytes())
            else:
                out += map(self._part, self.split.findall(piece))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


def byte_pairs(path: str) -> BytePairs:
    """A worker's coder for the file at ``path``, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = BytePairs(path)
    return _LOADED[path]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` for every row: ``ids`` is binary, little-endian unsigned 32-bit.

    Null and empty texts have no ids; repeated rows and null ids give a row each; other columns are left out. Texts
    are encoded whole; memory is bounded by the longest text and a fixed number of remembered pre-tokens.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path)
        rows = (
            (doc_id, coder.encode(text or ""))
            for batch in batches
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
        )
        yield from in_batches(rows, schema, lambda r: len(r[1]))

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, text)`` of ``(doc_id, ids)``; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_pairs(path)
        rows = (
            (doc_id, ids, coder.decode(ids))
            for batch in batches
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), byte_list(batch["ids"]))
        )
        yield from in_batches(rows, schema, lambda r: len(r[1]) + len(r[2]))

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``."""
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
