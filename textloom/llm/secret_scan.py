"""Secret scans: an Aho-Corasick keyword pass, anchored expressions at its hits, then embedded checksums."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from textloom.llm.support import byte_list, in_batches, keyed_texts

# The keywords, expressions and least lengths of each kind, in order of listing.
KEYWORDS = ["password", "passwd", "secret", "token", "apikey", "api_key", "akia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"]
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
CHECKED = re.compile(rb"(gh[pousr]_|npm_)([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "checked"]
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX_CLASS = bytes(1 if chr(b) in "0123456789abcdef" else 0 for b in range(256))
_AUTOMATON: list[ahocorasick.Automaton] = []


def automaton() -> ahocorasick.Automaton:
    if not _AUTOMATON:
        made = ahocorasick.Automaton()
        for word in KEYWORDS:
            made.add_word(word, word)
        made.make_automaton()
        _AUTOMATON.append(made)
    return _AUTOMATON[0]


def checksum(body: bytes) -> bytes:
    """CRC-32 of a token's body in six base-62 digits, as its last six characters state it."""
    n, out = zlib.crc32(body), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.encode()


def byte_spans(data: bytes) -> list[tuple[int, int, int]]:
    """``(start, order of kind, end)`` in bytes, sorted."""
    spans: list[tuple[int, int, int]] = []
    ends = [0, 0, 0, 0]
    hits = sorted((end - len(word) + 1, word) for end, word in automaton().iter(data.lower().decode("latin-1")))
    for at, word in hits:
        kind = 1 if word == "akia" else 3 if word[-1] == "_" else 0
        if at < ends[kind]:
            continue
        found = (ASSIGN, ACCESS, HEX, CHECKED)[kind].match(data, at)
        if not found:
            continue
        if kind < 3:
            ends[kind] = found.end()
        if kind == 0 and found.end(2) - found.start(2) >= ASSIGN_LEAST:
            spans.append((at, 0, found.end()))
        elif kind == 1 and found.end() - at >= ACCESS_LEAST:
            spans.append((at, 1, found.end()))
        elif kind == 3 and checksum(found[2]) == found[3]:
            ends[3] = found.end()
            spans.append((at, 3, found.end()))
    # Hex runs have no keyword: a run of the class is the literal that is searched.
    classes, needle, at = data.translate(_HEX_CLASS), b"\x01" * HEX_LEAST, 0
    while (at := classes.find(needle, at)) >= 0:
        end = HEX.match(data, at).end()
        spans.append((at, 2, end))
        at = end
    return sorted(spans)


def char_spans(data: bytes) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` in code points by start, then kind as listed."""
    out, at, chars = [], 0, 0
    for start, kind, end in byte_spans(data):
        chars += len(data[at:start].decode("utf-8"))
        at = start
        out.append((KINDS[kind], chars, chars + len(data[start:end].decode("utf-8"))))
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`` for every row.

    Null and empty texts have no spans; repeated rows and null ids give a row each; other columns are left out. Whole
    texts are read, one at a time. ``checked`` spans are tokens whose last characters are their own checksum.
    """
    names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    schema = pa.schema(list(zip(names, [pa.int64()] * 4 + [pa.string()] * 2)))

    def row(doc_id: int | None, data: bytes) -> tuple:
        spans = char_spans(data)
        shown = [f"{k}:{a}:{b}" for k, a, b in spans]
        base = ",".join(s for s, (k, _, _) in zip(shown, spans) if k != "checked")
        counts = [sum(k == kind for k, _, _ in spans) for kind in KINDS[:3]]
        return doc_id, *counts, hashlib.sha256(base.encode()).hexdigest(), ",".join(shown)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row(i, d) for b in batches for i, d in zip(b["doc_id"].to_pylist(), byte_list(b["text"])))
        yield from in_batches(rows, schema, lambda r: len(r[-1]))

    return keyed_texts(docs).mapInArrow(run, "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``mark``, overlapping spans by one; null texts stay null.

    All other columns stay as they are.
    """

    def clean(text: str | None) -> str | None:
        data = text.encode() if text else b""
        spans = byte_spans(data)
        if not spans:
            return text
        out, at = [], 0
        for start, _, end in spans:
            if start >= at:
                out += [data[at:start], mark.encode()]
            at = max(at, end)
        return b"".join([*out, data[at:]]).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(map(clean, batch["text"].to_pylist()), pa.string()))

    return docs.mapInArrow(run, docs.schema)
