"""Web archives, spelling variants and cross-tokenizer alignment against brute force."""

import hashlib
import io
import random
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.compare import spark_rows, sql_rows
from textloom.llm import alignment, queries, spelling, web_archive, zip_ranges
from textloom.session import scratch_path

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EXTRA = ", lang string, key string, same string, n bigint, word string, chunk int, row int, payload string, _salt int"


def key(row):
    return tuple((x is not None, x) for x in row)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


# Archives


def archived(spark, pages):
    packages = web_archive.archive_pages(pages, scratch_path(spark, "archives"))
    records = web_archive.read(web_archive.locate(packages))
    return packages, records, rows_of(web_archive.page_digests(records), *PAGE_COLUMNS)


PAGE_COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def expected_pages(pages):
    """One response for every payload of at least 1000 bytes; repeated rows differ in nothing, so counts suffice."""
    groups = defaultdict(list)
    for page_id, html in pages:
        groups[(html or "").encode()].append(page_id)
    out = []
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda x: (x is not None, x or 0), reverse=True)
        for place, i in enumerate(ids):
            again = len(payload) >= 1000 and place > 0
            out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", ids[0] if again else None))
    return sorted(out, key=key)


def test_archive_of_odd_pages(spark):
    long = "é" * 500
    pages = [
        (1, None), (2, ""), (3, long), (4, long), (5, "x" * 999), (6, "x" * 999), (7, "y" * 1000), (7, "y" * 1000), (8, "y" * 1000),
        (None, long), (None, "z" * 2000), (None, "z" * 2000), (9, "\r\n\r\nWARC/1.1\r\n\r\n" * 100), (2**62, "w" * 3_000_000), (-5, "w" * 3_000_000),
        (10, "tail\r\n\r\n"), (11, "\0\x1f\x8b" * 400),
    ]
    urls = [None, "http://a/ b\r\nWARC-Type: revisit", "http://é.example/", ""]
    rows = [(i, urls[n % 4], h, "en", "k", "s", 1, "w", 2, 3, "p", 4) for n, (i, h) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string" + EXTRA).repartition(3)
    packages, records, got = archived(spark, table)
    assert got == expected_pages(pages)
    assert sum(r.records for r in packages.collect()) == len(pages)
    kept = {r.record_id: r for r in records.collect()}
    assert len(kept) == len(pages)
    for r in kept.values():
        if r.record_type == "revisit":
            assert r.payload is None and kept[r.refers_to].declared_digest == r.declared_digest and kept[r.refers_to].record_type == "response"
    assert archived(spark, table.drop("url"))[2] == got


def test_archive_of_no_pages(spark):
    assert archived(spark, spark.createDataFrame([], "page_id bigint, url string, html string"))[2] == []


def test_archive_query_equals_sql(spark, con, sf):
    assert spark_rows(queries.QUERIES["op11_warc"](spark, sf)) == sql_rows(con, queries.SQL["op11_warc"])


def test_zip64_directory(monkeypatch):
    for limit in (None, 10):
        if limit:
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", limit)
        for before in (b"", b"#!/bin/sh\n" * 40):
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
                for i in range(200):
                    z.writestr(f"archive/é{i}", bytes([i]) * (i + 5))
                z.comment = b"a note with PK\x05\x06 in it"
            data = before + raw.getvalue()
            source = pa.BufferReader(data)
            found = list(zip_ranges.members(source))
            assert [m.name for m in found] == [f"archive/é{i}" for i in range(200)]
            assert (b"PK\x06\x06" in data) == bool(limit)
            for i, m in enumerate(found):
                at = zip_ranges.data_start(source, m)
                assert data[at : at + m.size] == bytes([i]) * (i + 5)


def test_damaged_packages_are_refused():
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("a", b"b")
    for data in (b"", b"plain text", raw.getvalue()[:-30], raw.getvalue().replace(b"PK\x01\x02", b"PK\x00\x02")):
        with pytest.raises(ValueError):
            list(zip_ranges.members(pa.BufferReader(data)))


def test_members_without_index_are_walked(spark, tmp_path):
    records = [web_archive.record_bytes(f"urn:page:{i}:{i}", "http://a/", b"p" * i, hashlib.sha1(b"p" * i).digest(), i, None) for i in (0, 7, 200_000)]
    info = web_archive.zlib.compress(b"", wbits=31)[:0] + web_archive.gzip.compress(b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n")
    plain = b"".join(web_archive.gzip.decompress(r) for r in records)
    for name, data in (("archive/a.warc.gz", info + b"".join(records)), ("archive/b.warc", plain)):
        path = f"{tmp_path}/{name[-6:].strip('./')}.wacz"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
            z.writestr(name, data)
            z.writestr("indexes/", b"")
        found = web_archive.read(web_archive.locate(spark.createDataFrame([(path,), (None,)], "path string")))
        assert rows_of(web_archive.page_digests(found), "page_id", "payload_bytes") == [(0, 0), (7, 7), (200_000, 200_000)]
    with zipfile.ZipFile(f"{tmp_path}/c.wacz", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a.warc", plain)
    with pytest.raises(Exception, match="compressed archive members"):
        web_archive.locate(spark.createDataFrame([(f"{tmp_path}/c.wacz",)], "path string")).collect()


# Spelling variants


def expected_words(docs):
    counted = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            counted["".join(c for i, c in enumerate(word) if h % 97 or i != h % len(word))] += 1
    return {w: n for w, n in counted.items() if len(w) >= 5 and n >= 3}


def neighbours(words):
    """Sets of words one edit apart: equal with one place blanked, or equal to another with one place deleted."""
    blanked, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            blanked[w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in blanked.values():
        for w in group:
            near[w] |= group - {w}
    return near


def expected_variants(words):
    near, form = neighbours(words), {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=key)


VARIANT_COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def test_spelling_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    words = expected_words([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(spelling.variants(docs), *VARIANT_COLUMNS) == expected_variants(words)
    assert rows_of(queries.QUERIES["op12_spelling"](spark, sf), *VARIANT_COLUMNS) == expected_variants(words)


def test_spelling_of_odd_documents(spark):
    texts = [
        None, "", " 1 2 ", "Apple apple APPLE apples apples apples", "ÉCOLE École école ecole ecole ecole écol", "x" * 50_000, "x" * 50_000 + "y", "x" * 50_000,
        "naïve naive naive naive naïve naïve ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿÿ ÿÿÿÿ", "日本語apple日本 apple-apple apple_apple", "aaaaa aaaaaa aaaaaaa " * 40,
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (5, texts[5]), (5, texts[5]), (6, texts[6]), (None, texts[6]), (None, texts[6]), (None, "apple apple")]
    docs += [(i, "apple appla appls ample" if i % 3 else "apple maple") for i in range(100, 400)]
    rows = [(i, t, "en", "k", "s", 1, "w", 2, 3, "p", 4) for i, t in docs]
    table = spark.createDataFrame(rows, "doc_id bigint, text string" + EXTRA).repartition(3)
    want = expected_variants(expected_words(docs))
    assert rows_of(spelling.variants(table), *VARIANT_COLUMNS) == want
    assert spelling.variants(table.limit(0)).collect() == []


@pytest.mark.parametrize("letters", ["ab", "aé\U0001f600"])
def test_near_words_over_many_tiles(spark, monkeypatch, letters):
    monkeypatch.setattr(spelling, "BLOCK", 8)
    draw = random.Random(len(letters))
    words = {"".join(draw.choices(letters, k=draw.randint(1, 9))): draw.randint(1, 5) for _ in range(900)}
    table = spark.createDataFrame([*words.items()], "word string, n bigint")
    near = neighbours(words)
    want = sorted((w, len(x), *min((-words[o], o) for o in x)) for w, x in near.items() if x and w in words)
    got = rows_of(spelling.near_words(table), "word", "n_near", "best_n", "best")
    assert [(w, n, -b, o) for w, n, b, o in got] == want


# Alignment


def expected_alignment(docs):
    first, second = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    first.encode_special_tokens = True
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
    linked, rows, counts = [], [], Counter()
    for doc_id, text in docs:
        links, parts = [], []
        a = b = []
        if text:
            a = [(i, bytes(table[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
            b = []
            for i in second.encode(text):
                piece = second.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode()))
            if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                a = b = []
            i = j = at_a = at_b = 0
            group = ([], [])
            while i < len(a) or j < len(b):
                if at_a <= at_b and i < len(a):
                    group[0].append(a[i][0])
                    at_a += len(a[i][1])
                    i += 1
                else:
                    group[1].append(b[j][0])
                    at_b += len(b[j][1])
                    j += 1
                if at_a == at_b:
                    links.append((group[0][-1], group[1][-1]))
                    parts.append(",".join(map(str, group[0])) + "|" + ",".join(map(str, group[1])))
                    group = ([], [])
        counts.update(links)
        linked.append(links)
        rows.append((doc_id, len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, n_a, n_b, groups, digest), links in zip(rows, linked):
        best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((doc_id, n_a, n_b, groups, len(links), best, sum(counts[x] for x in links), digest))
    return sorted(out, key=key)


ALIGN_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = expected_alignment([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(queries.QUERIES["op13_alignment"](spark, sf), *ALIGN_COLUMNS) == want


def test_alignment_of_odd_documents(spark):
    texts = [
        None, "", " ", "\n", "a", " a", "a  b\tc\r\n", "<|endoftext|> <s></s><unk> <0x41>", "日本語 \U0001f600 é é ▁x", "x" * 3000, "ab " * 40_000,
        "nul \0 and \x85\xa0 　", "It's 'S don't", "the same", "the same", "ÿ þ ß ı ŉ", "a" * 150_000 + " end",
    ]
    docs = [(i, t) for i, t in enumerate(texts)] + [(13, "the same"), (None, "the same"), (None, None), (20, "the  same")]
    rows = [(i, t, "en", "k", "s", 1, "w", 2, 3, "p", 4) for i, t in docs]
    table = spark.createDataFrame(rows, "doc_id bigint, text string" + EXTRA).repartition(3)
    assert rows_of(alignment.align(table, BYTE, PIECE), *ALIGN_COLUMNS) == expected_alignment(docs)
    assert alignment.align(table.limit(0), BYTE, PIECE).collect() == []


def test_fast_encoder_equals_the_library():
    both = alignment.aligner(BYTE, PIECE)
    library = Tokenizer.from_file(BYTE)
    library.encode_special_tokens = True
    characters = [chr(i) for i in range(alignment.LATIN)]
    draw = random.Random(1)
    texts = [f"a{c}b {c}{c} 1{c} {c}" for c in characters] + ["".join(draw.choices(characters, k=60)) for _ in range(2000)]
    texts += ["".join(draw.choices(" \n\t ab1'.", k=30)) for _ in range(2000)] + [" " * 5000, "<|endoftext|>", "a" * 5000]
    for text in texts:
        assert both.fast(f" {text}") == library.encode(f" {text}", add_special_tokens=False).ids
