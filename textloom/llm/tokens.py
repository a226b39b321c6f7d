"""Ids of whole texts under a tokenizer file whose pre-tokens never hold white space."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np

from textloom.llm.bpe import byte_symbols

KEEP_BYTES = 64
"""Longer chunks are encoded each time."""

KEEP_CHUNKS = 1_000_000
"""Remembered chunks of a worker; when full, the memory starts anew."""

MARK = re.compile(rb"(?<=[a-z])(?=[.,;:!?])")
"""Where a mark follows a letter. The file splits there in any case, so a blank changes nothing, and a word with and
without marks is remembered once."""

LATIN = "\u0250"
"""Below it stand the Latin letters that every Unicode version knows."""

_LOADED: dict[str, "ChunkIds"] = {}


class ChunkIds(dict):
    """Packed little-endian 32-bit ids by chunk of text between ASCII white space.

    Normaliser, splitting pattern and special tokens of the file act within such chunks, so a text's ids are those
    of its chunks one after another.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merge = self.tokenizer.model.tokenize
        self.symbols = byte_symbols()

    def _word(self, word: str) -> bytes:
        """Ids of lower-case Latin letters: one pre-token that the normaliser leaves alone, so the merges are all."""
        data = word.encode("utf-8")
        shown = word if len(data) == len(word) else "".join(map(self.symbols.__getitem__, data))
        return np.array([t.id for t in self.merge(shown)], "<u4").tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        ids = self._plain(chunk) if chunk.isalpha() and chunk.islower() else self._other(chunk)
        if len(chunk) <= KEEP_BYTES:
            if len(self) >= KEEP_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids

    def _plain(self, word: bytes) -> bytes:
        """Ids of ASCII letters, which the vocabulary writes as they are."""
        found = [t.id for t in self.merge(word.decode("ascii"))]
        return struct.pack(f"<{len(found)}I", *found)

    def _other(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8")
        word = text.rstrip(".,;:!?")
        if len(word) < len(text) and word.isalpha() and word.lower().isalpha():
            # Letters and the marks after them are two pre-tokens.
            return self[word.encode("utf-8")] + self[text[len(word) :].encode("utf-8")]
        if text.isalpha() and max(text) < LATIN and text == text.lower() and is_normalized("NFC", text):
            return self._word(text)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def of(self, data: bytes) -> bytes:
        """Ids of a whole UTF-8 text."""
        # The file lower-cases all but its special tokens, which start with "<|".
        chunks = data.split() if b"<|" in data else MARK.sub(b" ", data.lower()).split()
        return b"".join(map(self.__getitem__, chunks))


def packed_encoder(path: str) -> Callable[[bytes], bytes]:
    """A worker's encoder for the tokenizer file at ``path``, loaded once."""
    if path not in _LOADED:
        _LOADED[path] = ChunkIds(path)
    return _LOADED[path].of
