"""ZIP directories by range reads: classic and ZIP64 end records, central directory, places of stored members."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import NamedTuple

# Fixed values of the ZIP format.
END, END64, LOCATOR, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
STORED = 0
ZIP64_FIELD = 1
_END, _END64, _ENTRY, _LOCAL = struct.Struct("<4s4H2LH"), struct.Struct("<4sQ2H2L4Q"), struct.Struct("<4s6H3L5H2L"), struct.Struct("<4s5H3L2H")

WINDOW = 1 << 20
"""Bytes of the central directory read at once."""


class Member(NamedTuple):
    name: str
    method: int
    header: int
    size: int


class Window:
    """Reads of a few bytes each, served from ranges of ``WINDOW`` bytes."""

    def __init__(self, source, start: int, end: int) -> None:  # noqa: ANN001
        self.source, self.at, self.end = source, start, end
        self.held, self.base = b"", start

    def take(self, n: int) -> bytes:
        if self.at + n > self.end:
            raise ValueError("the central directory ends within an entry")
        if self.at + n > self.base + len(self.held):
            self.base = self.at
            self.held = self.source.read_at(min(max(WINDOW, n), self.end - self.at), self.at)
        got = self.held[self.at - self.base : self.at - self.base + n]
        if len(got) != n:
            raise ValueError("the package is cut short")
        self.at += n
        return got


def _end_record(source) -> tuple[int, int, int, int]:  # noqa: ANN001
    """``(entries, directory size, directory start, bytes before the archive)``."""
    size = source.size()
    base = max(0, size - _END.size - FULL16)
    tail = source.read_at(size - base, base)
    at = tail.rfind(END)
    while at >= 0 and (at + _END.size > len(tail) or at + _END.size + _END.unpack_from(tail, at)[-1] != len(tail)):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("not a ZIP package: no end record")
    _, disk, first_disk, _, entries, length, start, _ = _END.unpack_from(tail, at)
    end = base + at
    place = source.read_at(20, end - 20) if end >= 20 else b""
    if place[:4] == LOCATOR:
        _, _, record, _ = struct.unpack("<4sLQL", place)
        head = source.read_at(_END64.size, record)
        if head[:4] != END64:  # bytes stand before the archive: the record ends at its locator
            record = end - 20 - _END64.size
            head = source.read_at(_END64.size, record)
        if head[:4] == END64:
            _, _, _, _, disk, first_disk, _, entries, length, start = _END64.unpack(head)
            end = record
    if FULL32 in (length, start):
        raise ValueError("the ZIP64 end record is missing")
    if disk or first_disk:
        raise ValueError("packages over several disks are not read")
    return entries, length, start, end - length - start


def _wide(extra: bytes, values: list[int]) -> list[int]:
    """Sizes and offset with those of all ones taken from the ZIP64 field, in its order."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == ZIP64_FIELD:
            words = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            return [next(words) if v == FULL32 else v for v in values]
        at += 4 + n
    return values


def members(source) -> Iterator[Member]:  # noqa: ANN001
    """Entries of the central directory, read in windows; ``source`` has ``size()`` and ``read_at(n, offset)``."""
    entries, length, start, before = _end_record(source)
    window = Window(source, start + before, start + before + length)
    for _ in range(entries):
        head = _ENTRY.unpack(window.take(_ENTRY.size))
        if head[0] != ENTRY:
            raise ValueError("an entry of the central directory is damaged")
        _, _, _, flags, method, _, _, _, packed, plain, n_name, n_extra, n_note, _, _, _, at = head
        name, extra, _ = window.take(n_name), window.take(n_extra), window.take(n_note)
        plain, packed, at = _wide(extra, [plain, packed, at])
        yield Member(name.decode("utf-8" if flags & 0x800 else "cp437"), method, at + before, packed)


def data_start(source, member: Member) -> int:  # noqa: ANN001
    """Where the bytes of a member begin: behind its local header, whose extra field may differ from the directory's."""
    head = _LOCAL.unpack(source.read_at(_LOCAL.size, member.header))
    if head[0] != LOCAL:
        raise ValueError(f"no local header for {member.name}")
    return member.header + _LOCAL.size + head[-2] + head[-1]
