"""Web archives: WARC records in ZIP packages, found through directory and index, read by byte ranges."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm import zip_ranges
from textloom.llm.support import in_batches, named_rows, spread_join, written
from textloom.session import spread

PACKAGE = 256 << 20
"""Bytes after which a task begins another package; a record is never cut."""

MEMBER = 64 << 20
"""Bytes after which a package's archive member is closed."""

STRETCH = 8 << 20
"""Bytes of a package that one reading unit covers, so that many tasks share a large package."""

GAP = 64 << 10
"""Records that lie closer than this are fetched by one read."""

DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "urn:page:"

_PLACE = "path string, start bigint, length bigint"
_RECORD = "record_id string, record_type string, refers_to string, target_uri string, declared_digest string, declared_bytes bigint, payload binary"


def _open(path: str):  # noqa: ANN202
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def _line(value: str) -> str:
    """A header value on one line: control characters and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(record_id: str, target: str, payload: bytes | None, digest: bytes, n_bytes: int, refers_to: str | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit with the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    body = http if refers_to is not None else http + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>"]
    head += [f"WARC-Target-URI: {_line(target)}", f"WARC-Date: {DATE}", "Content-Type: application/http; msgtype=response"]
    head += [f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    head += [f"Content-Length: {len(body)}", "", ""]
    return gzip.compress("\r\n".join(head).encode() + body + b"\r\n\r\n", 4, mtime=0)


class Package:
    """Writes one ZIP package: stored archive members, then an index with a line per record, then a description."""

    def __init__(self, sink, zip64: bool = True) -> None:  # noqa: ANN001
        self.zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
        self.zip64 = zip64
        self.index = io.BytesIO()
        self.member = None
        self.names: list[str] = []
        self.at = self.bytes = self.records = 0

    def _entry(self, name: str):  # noqa: ANN202
        return self.zip.open(zipfile.ZipInfo(name), "w", force_zip64=self.zip64)

    def add(self, target: str, record: bytes) -> None:
        if self.member is None or self.at >= MEMBER:
            self._close_member()
            self.names.append(f"archive/data-{len(self.names):05d}.warc.gz")
            self.member, self.at = self._entry(self.names[-1]), 0
        self.member.write(record)
        line = {"url": _line(target), "filename": self.names[-1].removeprefix("archive/"), "offset": str(self.at), "length": str(len(record))}
        self.index.write(f"{_line(target)} {DATE[:10].replace('-', '')}000000 {json.dumps(line)}\n".encode())
        self.at += len(record)
        self.bytes += len(record)
        self.records += 1

    def _close_member(self) -> None:
        if self.member is not None:
            self.member.close()

    def close(self) -> None:
        self._close_member()
        with self._entry("indexes/index.cdxj") as out:
            out.write(self.index.getbuffer())
        about = {"profile": "data-package", "resources": [{"name": n.split("/")[-1], "path": n} for n in [*self.names, "indexes/index.cdxj"]]}
        with self._entry("datapackage.json") as out:
            out.write(json.dumps(about).encode())
        self.zip.close()


def write(records: DataFrame, folder: str) -> DataFrame:
    """``(path, bytes, records)`` of the packages written for ``(record_id, target, payload, digest, n_bytes, refers_to)``.

    Every attempt of a task writes files of its own names, and only those of finished attempts are listed, so a lost
    executor leaves no half package behind in the result. An empty table writes no package.
    """
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, inner = fs.FileSystem.from_uri(folder)
        system.create_dir(inner, recursive=True)

        def rows() -> Iterator[tuple]:
            package = sink = None
            for batch in batches:
                for record_id, target, payload, digest, n_bytes, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                    if package is None:
                        name = f"{uuid.uuid4().hex}.wacz"
                        sink = system.open_output_stream(f"{inner}/{name}")
                        package = Package(sink)
                    package.add(target, record_bytes(record_id, target, payload, bytes.fromhex(digest), n_bytes, refers_to))
                    if package.bytes >= PACKAGE:
                        package.close()
                        sink.close()
                        yield f"{folder}/{name}", package.bytes, package.records
                        package = None
            if package is not None:
                package.close()
                sink.close()
                yield f"{folder}/{name}", package.bytes, package.records

        yield from in_batches(rows(), schema)

    columns = records.select("record_id", "target", "payload", "digest", "n_bytes", "refers_to")
    return written(columns.mapInArrow(run, "path string, bytes bigint, records bigint"), "packages")


def _lines(source, start: int, size: int, packed: bool) -> Iterator[bytes]:  # noqa: ANN001
    """Lines of a stored index, plain or of gzip members, in ranges."""
    gz, rest = zlib.decompressobj(31) if packed else None, b""
    for at in range(0, size, zip_ranges.WINDOW):
        data = source.read_at(min(zip_ranges.WINDOW, size - at), start + at)
        if gz is not None:
            plain = b""
            while data:
                plain += gz.decompress(data)
                data = gz.unused_data
                if gz.eof:
                    gz = zlib.decompressobj(31)
            data = plain
        *whole, rest = (rest + data).split(b"\n")
        yield from whole
    if rest:
        yield rest


def _walked(source, start: int, size: int) -> Iterator[tuple[int, int]]:  # noqa: ANN001
    """``(offset, length)`` of the records of a member without an index: its gzip members, or plain records by length."""
    if source.read_at(min(2, size), start) == b"\x1f\x8b":
        begun, gz = 0, zlib.decompressobj(31)
        for at in range(0, size, zip_ranges.WINDOW):
            data = source.read_at(min(zip_ranges.WINDOW, size - at), start + at)
            while data:
                gz.decompress(data)
                if not gz.eof:
                    break
                end = min(at + zip_ranges.WINDOW, size) - len(gz.unused_data)
                yield begun, end - begun
                data, begun, gz = gz.unused_data, end, zlib.decompressobj(31)
        return
    at = 0
    while at < size:
        head = b""
        while b"\r\n\r\n" not in head:
            more = source.read_at(min(4096, size - at - len(head)), start + at + len(head))
            if not more:
                raise ValueError("a record head is cut short")
            head += more
        text = head.split(b"\r\n\r\n")[0]
        length = len(text) + 4 + int(_fields(text)["content-length"]) + 4
        yield at, length
        at += length


def locate(packages: DataFrame) -> DataFrame:
    """``(path, start, length)`` of every record of the packages in column ``path``, from their directories and indexes.

    Stored members ``archive/*`` and ``indexes/*.cdx*`` are looked up; an archive member that no index line names is
    walked from record to record. Compressed members are refused, since their parts cannot be read by range.
    """
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("length", pa.int64())])

    def of_package(path: str) -> Iterator[tuple]:
        with _open(path) as source:
            found = [m for m in zip_ranges.members(source) if m.name.startswith(("archive/", "indexes/")) and not m.name.endswith("/")]
            if any(m.method != zip_ranges.STORED for m in found):
                raise ValueError(f"{path} holds compressed archive members")
            begin = {m.name: (zip_ranges.data_start(source, m), m.size) for m in found}
            listed = set()
            for name, (start, size) in begin.items():
                if name.startswith("indexes/") and ".cdx" in name:
                    for line in _lines(source, start, size, name.endswith(".gz")):
                        if b"{" in line:
                            entry = json.loads(line[line.index(b"{") :])
                            member = f"archive/{entry['filename'].removeprefix('archive/')}"
                            listed.add(member)
                            yield path, begin[member][0] + int(entry["offset"]), int(entry["length"])
            for name, (start, size) in begin.items():
                if name.startswith("archive/") and name not in listed:
                    for offset, length in _walked(source, start, size):
                        yield path, start + offset, length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches((row for batch in batches for path in batch["path"].to_pylist() for row in of_package(path)), schema)

    return packages.where("path is not null").select("path").mapInArrow(run, _PLACE)


def _fields(head: bytes) -> dict[str, str]:
    lines = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in lines}


def parsed(data: bytes) -> tuple | None:
    """``_RECORD`` columns of one record's bytes; None for kinds without a payload, such as ``warcinfo``."""
    if data[:2] == b"\x1f\x8b":
        data = zlib.decompress(data, 31)
    head, _, body = data.partition(b"\r\n\r\n")
    if not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = _fields(head)
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    body = body[: int(fields["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    scheme, _, digest = fields.get("warc-payload-digest", "").partition(":")
    declared = base64.b32decode(digest).hex() if scheme.lower() == "sha1" else None
    length = _fields(http).get("content-length", "")
    refers = fields.get("warc-refers-to")
    return (
        fields["warc-record-id"].strip("<>"), kind, refers.strip("<>") if refers else None, fields.get("warc-target-uri"), declared,
        int(length) if length.isdigit() else None, payload if kind == "response" else None,
    )


def read(located: DataFrame) -> DataFrame:
    """Records at the places that ``locate`` found, by range reads of neighbouring places together.

    Columns ``record_id, record_type, refers_to, target_uri, declared_digest, declared_bytes, payload``; a revisit has
    no payload and keeps what its head declares. A response whose payload does not have the declared SHA-1 is an error.
    """
    schema = pa.schema(
        [("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string())]
        + [("declared_digest", pa.string()), ("declared_bytes", pa.int64()), ("payload", pa.large_binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranges() -> Iterator[tuple[str, list[tuple[int, int]]]]:
            near: list[tuple[int, int]] = []
            last, end = None, 0
            for batch in batches:
                for path, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                    if near and (path != last or start > end + GAP or start < near[0][0] or end - near[0][0] > STRETCH):
                        yield last, near
                        near = []
                    near.append((start, length))
                    last, end = path, start + length
            if near:
                yield last, near

        def rows() -> Iterator[tuple]:
            source, opened = None, None
            for path, near in ranges():
                if path != opened:
                    source, opened = _open(path), path
                first = near[0][0]
                data = source.read_at(max(s + n for s, n in near) - first, first)
                for start, length in near:
                    row = parsed(data[start - first : start - first + length])
                    if row is None:
                        continue
                    if row[1] == "response" and row[4] is not None and hashlib.sha1(row[6]).hexdigest() != row[4]:
                        raise ValueError(f"{row[0]} in {path} does not have its declared digest")
                    yield row

        yield from in_batches(rows(), schema, lambda r: len(r[6] or b""))

    stretched = located.withColumn("stretch", F.floor(F.col("start") / F.lit(STRETCH)))
    dealt = spread(stretched, "path", "stretch").sortWithinPartitions("path", "start").select("path", "start", "length")
    return dealt.mapInArrow(run, _RECORD)


def archive_pages(pages: DataFrame, folder: str, least: int = 1000) -> DataFrame:
    """Packages (see ``write``) with one record per row of ``pages`` (``page_id``, ``html``, and ``url`` if there is one).

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of at least ``least`` bytes, the one
    with the largest page_id is a response and the others revisit it; of repeated rows, one. Null ids count as
    smallest. A missing url is replaced by the record's name; other columns are left out.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.col("url").cast("string") if "url" in pages.columns else F.lit(None).cast("string")
    page = F.col("page_id").cast("long")
    rows = named_rows(pages, page.alias("page_id"), url.alias("url"), F.encode(html, "UTF-8").alias("payload"))
    rows = rows.withColumn("n_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("record_id", F.concat(F.lit(PAGE), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(":"), F.col("row")))
    slim = written(rows.where(F.col("n_bytes") >= least).select(F.sha2("payload", 256).alias("same"), "row", "page_id", "record_id"), "page-rows")
    groups = slim.groupBy("same").agg(F.max(F.struct("page_id", "row", "record_id")).alias("top"), F.count("*").alias("n"))
    groups = groups.where("n > 1").select("same", "top")
    copies = spread_join(slim, groups, "same", "row").where("row <> top.row").select("row", F.col("top.record_id").alias("refers_to"))
    # Written first, so that its size is known: few copies are sent to where the pages are read.
    typed = rows.withColumn("digest", F.sha1("payload")).join(written(copies, "page-copies"), "row", "left")
    target = F.coalesce("url", "record_id").alias("target")
    payload = F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload")
    return write(typed.select("record_id", target, payload, "digest", "n_bytes", "refers_to"), folder)


def page_digests(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of records written by ``archive_pages``."""
    page = lambda name: F.nullif(F.split(F.col(name), ":")[2], F.lit("")).cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        F.coalesce(F.octet_length("payload").cast("long"), F.col("declared_bytes")).alias("payload_bytes"),
        F.coalesce(F.sha1("payload"), F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def oracle() -> str:
    return """
      WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
      r AS (
        SELECT page_id, html, strlen(html) AS n, first_value(page_id) OVER w AS top, row_number() OVER w AS place
        FROM p WINDOW w AS (PARTITION BY html ORDER BY page_id DESC NULLS LAST)
      )
      SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
        CASE WHEN n >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN n >= 1000 AND place > 1 THEN top END AS refers_to
      FROM r
    """
