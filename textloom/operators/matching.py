"""Greedy longest matches against a lexicon that every task holds, for lexicons of a measured size."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEXICON_ROWS = 500_000
LEXICON_BYTES = 32 * 1024 * 1024
"""Largest lexicon that is sent to the tasks; larger ones are matched by joins on substrings."""

REMEMBERED = 500_000
"""Encoded words that a worker remembers; when full, it starts anew."""

USES_AT_ONCE = 1 << 18
"""Words, chunks or tokens after which a run of rows is closed; a row is never cut."""

UNK = "[UNK]"
CONTINUED = "##"


class Lexicon:
    """Tokens with their lengths by first character, so that a position is tried only with lengths that can match."""

    def __init__(self, tokens: list[str]) -> None:
        self.tokens = set(tokens)
        lengths: dict[str, set[int]] = defaultdict(set)
        for token in self.tokens:
            if token:
                lengths[token[0]].add(len(token))
        self.lengths = {c: sorted(n, reverse=True) for c, n in lengths.items()}

    def end(self, text: str, at: int) -> int:
        """Where the longest token that begins at ``at`` ends, or ``at``."""
        for n in self.lengths.get(text[at], ()):
            piece = text[at : at + n]
            if piece in self.tokens:
                return at + len(piece)
        return at

    def cut(self, text: str, glued: bool) -> list[tuple[str, bool]]:
        """Tokens from left to right, and what lies between them: single characters, or ``glued`` to whole pieces."""
        out: list[tuple[str, bool]] = []
        at = begun = 0
        while at < len(text):
            end = self.end(text, at)
            if end > at:
                if begun < at:
                    out.append((text[begun:at], False))
                out.append((text[at:end], True))
                at = begun = end
            else:
                at += 1
                if not glued:
                    out.append((text[begun:at], False))
                    begun = at
        if begun < at:
            out.append((text[begun:at], False))
        return out


class WordPieces:
    """Words in vocabulary pieces, longest first, continuations marked; a word that cannot be covered is unknown."""

    def __init__(self, tokens: list[str]) -> None:
        self.first = Lexicon(tokens)
        self.rest = Lexicon([t.removeprefix(CONTINUED) for t in tokens if t.startswith(CONTINUED)])
        self.known: dict[str, list[str]] = {}

    def encode(self, word: str) -> list[str]:
        found = self.known.get(word)
        if found is None:
            found = self._cut(word)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = found
        return found

    def _cut(self, word: str) -> list[str]:
        at = self.first.end(word, 0) if word else 0
        if not at:
            return [UNK]
        out = [word[:at]]
        while at < len(word):
            end = self.rest.end(word, at)
            if end == at:
                return [UNK]
            out.append(CONTINUED + word[at:end])
            at = end
        return out


_BUILT: dict[tuple[int, type], object] = {}


def built(sent: Broadcast, kind: type) -> object:
    """A worker's ``kind`` of the sent tokens, made once."""
    key = (id(sent.value), kind)
    if key not in _BUILT:
        if len(_BUILT) >= 4:
            _BUILT.clear()
        _BUILT[key] = (kind(sent.value), sent.value)
    return _BUILT[key][0]


def sent(lexicon: DataFrame) -> Broadcast | None:
    """The tokens of ``(token)`` for all tasks if they are measured to be few; reads at most ``LEXICON_ROWS`` + 1."""
    rows = lexicon.where("token is not null").select("token").distinct().limit(LEXICON_ROWS + 1).toArrow()
    if rows.num_rows > LEXICON_ROWS or rows.nbytes > LEXICON_BYTES:
        return None
    return lexicon.sparkSession.sparkContext.broadcast(sorted(rows["token"].to_pylist()))


def _lists(offsets: list[int], values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def cut(units: DataFrame, key: str, tokens: Broadcast, glued: bool) -> DataFrame:
    """``(key, pieces)``: ``array<struct<piece, hit>>`` of every unit, as ``Lexicon.cut`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = built(tokens, Lexicon)
        for batch in batches:
            pieces, hits, offsets = [], [], [0]
            for unit in batch[key].to_pylist():
                for piece, hit in lexicon.cut(unit, glued):
                    pieces.append(piece)
                    hits.append(hit)
                offsets.append(len(pieces))
            values = pa.StructArray.from_arrays([pa.array(pieces, pa.string()), pa.array(hits, pa.bool_())], ["piece", "hit"])
            yield pa.RecordBatch.from_arrays([batch[key], _lists(offsets, values)], [key, "pieces"])

    return units.select(key).mapInArrow(run, f"`{key}` string, pieces array<struct<piece:string,hit:boolean>>")


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray]]:
    """Rows in runs of bounded size: the run, the items of its lists in ``column``, and how many each row has."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = (np.flatnonzero(np.diff(np.cumsum(sizes) // USES_AT_ONCE, append=-1)) + 1).tolist()
        for start, end in zip([0, *ends], ends):
            run = batch.slice(start, end - start)
            yield run, run[column].flatten(), sizes[start:end]


def _placed(codes: np.ndarray, pieces: list[list], sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Where the pieces of the items ``codes`` stand among all ``pieces``, and where the rows of ``sizes`` items end."""
    counts = np.array([len(p) for p in pieces], np.int64)
    taken = counts[codes]
    ends = np.cumsum(taken)
    begins = (np.cumsum(counts) - counts)[codes]
    places = np.arange(int(taken.sum())) + np.repeat(begins - (ends - taken), taken)
    return places, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])].tolist()


def _encoded(words: pa.StructArray, encode: Callable[[str], list[str]], max_chars: int | None) -> tuple[np.ndarray, list[list[str]]]:
    """The distinct words of ``(word, hit)`` in vocabulary pieces, and the number of each word among them."""
    coded = words.field("word").dictionary_encode()
    keys = coded.indices.to_numpy().astype(np.int64) * 2 + words.field("hit").to_numpy(zero_copy_only=False)
    used = np.zeros(2 * len(coded.dictionary), bool)
    used[keys] = True
    texts = coded.dictionary.to_pylist()
    pieces = []
    for key in np.flatnonzero(used).tolist():
        word = texts[key >> 1]
        if key & 1:
            pieces.append([word])
        else:
            pieces.append([UNK] if max_chars is not None and len(word) > max_chars else encode(word))
    return (np.cumsum(used) - 1)[keys], pieces


def encode_lists(units: DataFrame, key: str, tokens: Broadcast, max_chars: int | None = None) -> DataFrame:
    """``(key, tokens)`` of ``(key, words)``: the words of each row, ``array<struct<word, hit>>``, in vocabulary pieces.

    A word with ``hit`` is a token as it is; one of more than ``max_chars`` characters is unknown.
    """
    kind = units.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = built(tokens, WordPieces).encode
        for rows, words, sizes in _runs(batches, "words"):
            codes, pieces = _encoded(words, encode, max_chars)
            places, offsets = _placed(codes, pieces, sizes)
            values = pa.array([t for p in pieces for t in p], pa.string()).take(pa.array(places))
            yield pa.RecordBatch.from_arrays([rows[key], _lists(offsets, values)], [key, "tokens"])

    return units.select(key, "words").mapInArrow(run, f"`{key}` {kind}, tokens array<string>")


def count_lists(units: DataFrame, key: str, tokens: Broadcast, max_chars: int | None = None) -> DataFrame:
    """``(key, n)``: how many tokens ``encode_lists`` gives for each row."""
    kind = units.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = built(tokens, WordPieces).encode
        for rows, words, sizes in _runs(batches, "words"):
            codes, pieces = _encoded(words, encode, max_chars)
            ends = np.concatenate([[0], np.cumsum(np.array([len(p) for p in pieces], np.int64)[codes])])
            counts = np.diff(ends[np.concatenate([[0], np.cumsum(sizes)])])
            yield pa.RecordBatch.from_arrays([rows[key], pa.array(counts, pa.int64())], [key, "n"])

    return units.select(key, "words").mapInArrow(run, f"`{key}` {kind}, n bigint")


def cut_lists(units: DataFrame, key: str, tokens: Broadcast, glued: bool) -> DataFrame:
    """``(key, pieces)`` of ``(key, chunks)``: what ``cut`` gives for the chunks of each row, one after another."""
    kind = units.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = built(tokens, Lexicon)
        for rows, chunks, sizes in _runs(batches, "chunks"):
            coded = chunks.dictionary_encode()
            cuts = [lexicon.cut(chunk, glued) for chunk in coded.dictionary.to_pylist()]
            places, offsets = _placed(coded.indices.to_numpy(), cuts, sizes)
            flat = [x for c in cuts for x in c]
            fields = [pa.array([p for p, _ in flat], pa.string()), pa.array([h for _, h in flat], pa.bool_())]
            values = pa.StructArray.from_arrays([f.take(pa.array(places)) for f in fields], ["piece", "hit"])
            yield pa.RecordBatch.from_arrays([rows[key], _lists(offsets, values)], [key, "pieces"])

    return units.select(key, "chunks").mapInArrow(run, f"`{key}` {kind}, pieces array<struct<piece:string,hit:boolean>>")


def sent_ids(vocab: DataFrame) -> Broadcast | None:
    """``(token, token_id)`` as pairs for all tasks if measured to be few, as ``sent``, and the ids are whole numbers."""
    if vocab.schema["token_id"].dataType.simpleString() != "bigint":
        return None
    rows = vocab.where("token is not null and token_id is not null").select("token", "token_id").limit(LEXICON_ROWS + 1).toArrow()
    if rows.num_rows > LEXICON_ROWS or rows.nbytes > LEXICON_BYTES:
        return None
    return vocab.sparkSession.sparkContext.broadcast(sorted(zip(rows["token"].to_pylist(), rows["token_id"].to_pylist())))


def id_lists(units: DataFrame, key: str, ids: Broadcast, cls: str, sep: str) -> DataFrame:
    """``(key, ids)`` of ``(key, tokens)``: the least id of each token, else that of ``UNK``, between two special ones."""
    kind = units.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for token, number in ids.value:
            known.setdefault(token, number)
        unknown = known.get(UNK)
        first, last = known.get(cls, unknown), known.get(sep, unknown)
        for rows, tokens, sizes in _runs(batches, "tokens"):
            coded = tokens.dictionary_encode()
            numbers = pa.array([*(known.get(t, unknown) for t in coded.dictionary.to_pylist()), first, last], pa.int64())
            ends = np.cumsum(sizes)
            codes = np.insert(coded.indices.to_numpy().astype(np.int64), ends, len(numbers) - 1)
            codes = np.insert(codes, ends - sizes + np.arange(len(sizes)), len(numbers) - 2)
            offsets = np.concatenate([[0], np.cumsum(sizes + 2)]).tolist()
            yield pa.RecordBatch.from_arrays([rows[key], _lists(offsets, numbers.take(pa.array(codes)))], [key, "ids"])

    return units.select(key, "tokens").mapInArrow(run, f"`{key}` {kind}, ids array<bigint>")


def text_lists(units: DataFrame, key: str, ids: Broadcast, skip: list[str]) -> DataFrame:
    """``(key, text)`` of ``(key, ids)``: the tokens but those to skip, joined, continuations attached; rows without any are left out."""
    kind = units.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, list[str]] = defaultdict(list)
        for token, number in ids.value:
            if token not in skip:
                known[number].append(token)
        for rows, numbers, sizes in _runs(batches, "ids"):
            coded = numbers.dictionary_encode(null_encoding="encode")
            pieces = [known.get(n, []) for n in coded.dictionary.to_pylist()]
            places, offsets = _placed(coded.indices.to_numpy(), pieces, sizes)
            tokens = pa.array([t for p in pieces for t in p], pa.string()).take(pa.array(places))
            joined = pc.replace_substring(pc.binary_join(_lists(offsets, tokens), " "), " ##", "")
            filled = pa.array(np.diff(offsets) > 0)
            yield pa.RecordBatch.from_arrays([rows[key].filter(filled), joined.filter(filled)], [key, "text"])

    return units.select(key, F.col("ids").cast("array<bigint>").alias("ids")).mapInArrow(run, f"`{key}` {kind}, text string")
