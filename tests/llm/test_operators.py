"""Operators of ``textloom.llm`` against brute force, exact round trips and held-out labels."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.compare import spark_rows, sql_rows
from textloom.llm import bpe, exact_dedup, licenses, near_dedup, nearest, packing, quality, queries, secret_scan, sharding, token_files
from textloom.session import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, lang string, shard int, ids string, length int, component_id string, value int, node string"
ODD = [
    None, "", " \n\t", "a", "a b", "It's 'S don't, x.", "a\x1cb \x85 x y​z", "<|endoftext|>x<|startoftext|> <|EndOfText|>",
    "日本語 中文 \U0001f600 é é ΑΣ İI ſK", "x" * 5000, "ab " * 9000, 'token = "aaaa" secret:abcdef PASSWORD: hunter2x',
    "AKIA" + "A" * 16 + " AKIAshort " + "0123456789abcdef" * 3, "Released under the MIT License.", "the same words again and again here",
    "the same words  again and again\nhere",
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", 1, "x", 2, "y", 3, "z") for i, t in enumerate(ODD)]
    rows += [rows[11], rows[14], (None, "null id", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def texts(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return odd, [(r.doc_id, r.text or "") for r in odd.collect()], docs, [(r.doc_id, r.text or "") for r in docs.collect()]


def both(texts):
    return ((texts[0], texts[1]), (texts[2], texts[3]))


def key(row):
    return tuple((x is not None, x) for x in row)


def test_bpe_equals_the_library(texts):
    library = Tokenizer.from_file(BYTE)
    for docs, rows in both(texts):
        got = sorted(map(tuple, bpe.digests(bpe.decode(bpe.encode(docs, BYTE), BYTE)).collect()), key=key)
        want = []
        for i, t in rows:
            ids = library.encode(t, add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        assert got == sorted(want, key=key)


def word_ids(text):
    return Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids


def test_packing_is_complete_and_tight(texts):
    for docs, rows in both(texts):
        got = packing.pack_documents(docs, WORD).collect()
        library = Tokenizer.from_file(WORD)
        want = []
        for i, t in rows:
            ids = [*library.encode(t, add_special_tokens=False).ids, 1]
            want += [(i, n, a, len(p := ids[a : a + 4096]), zlib.crc32(np.array(p, "<u4").tobytes())) for n, a in enumerate(range(0, len(ids), 4096))]
        assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
        bins = defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 4096
        assert len(bins) <= -(-sum(w[3] for w in want) // 4096) + 1


def test_packing_in_rounds(spark):
    pieces = spark.range(5000).select("id", (F.col("id") * 37 % 900 + 1).alias("length"))
    got = packing.pack(pieces, 4096, group=500).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.countDistinct("offset").alias("o"), F.count("*").alias("c"))
    rows = got.collect()
    assert sum(r.c for r in rows) == 5000 and max(r.n for r in rows) <= 4096 and all(r.o == r.c for r in rows)
    assert len(rows) <= -(-pieces.agg(F.sum("length")).first()[0] // 4096) + 1


@pytest.mark.parametrize("lengths", ["2100", "id % 1965 + 2049", "if(id % 3 = 0, 2100, id % 40 + 1)", "if(id % 2 = 0, 3000 + id % 7, 900)", "1300 + id % 3"])
def test_packing_keeps_groups_small(spark, monkeypatch, lengths):
    packer = packing._group_packer

    def bounded(*args):
        pack_group = packer(*args)

        def run(frame):
            assert len(frame) <= 700
            return pack_group(frame)

        return run

    monkeypatch.setattr(packing, "_group_packer", bounded)
    pieces = spark.range(4000).select("id", F.expr(lengths).cast("long").alias("length"))
    rows = packing.pack(pieces, 4096, group=500).groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("c")).collect()
    assert sum(r.c for r in rows) == 4000 and max(r.n for r in rows) <= 4096
    sizes = [r.length for r in pieces.collect()]
    # A few bins more for each of the eight groups than in one group.
    assert len(rows) <= len(packing.pack_sizes(sizes, 4096)) + 3 * 8


def test_packing_goes_on_to_the_next_best_step():
    for sizes in ([40, 27, 51, 9, 43, 25, 30, 14, 10, 48], [28, 40, 14, 13, 34, 19, 20, 51, 22, 39, 14]):
        bins = packing.pack_sizes(sizes, 100)
        assert len(bins) == 3 and sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 100 for b in bins)


def test_sequences_hold_the_ids(odd):
    pieces = packing.token_pieces(odd, WORD)
    full = packing.sequences(packing.pack(pieces)).collect()
    assert sorted(x for r in full for x in np.frombuffer(r.ids, "<u4").tolist()) == sorted(
        x for r in odd.collect() for x in [*word_ids(r.text or ""), 1]
    )


def test_token_files_round_trip(spark, texts):
    for docs, rows in both(texts):
        target = scratch_path(spark, "files")
        token_files.write(docs, WORD, target)
        got = {}
        for r in token_files.read(spark, target).collect():
            got[r.start] = (r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist())
        at, order = 0, []
        for start in sorted(got):
            assert start == at
            at += got[start][1]
            order.append(got[start][0])
        assert order == sorted(order, key=lambda i: (i is not None, i))
        library = Tokenizer.from_file(WORD)
        want = Counter((i, tuple([*library.encode(t, add_special_tokens=False).ids, 2])) for i, t in rows)
        assert Counter((i, tuple(ids)) for i, _, ids in got.values()) == want


def test_repair_shortens_and_reads_at_random():
    rng = np.random.default_rng(0)
    docs = [(i, rng.choice([3, 4, 5, 49000], int(n), p=[0.6, 0.2, 0.1, 0.1]).astype(np.uint32)) for i, n in enumerate(rng.integers(0, 400, 60))]
    data = token_files.pack_shard(docs)
    shard = token_files.Shard(data)
    assert len(shard.seq) < 0.7 * sum(len(x) for _, x in docs)
    for n in (59, 0, 31, 7):
        assert shard.ids(n).tolist() == docs[n][1].tolist()


def straw(doc_id, tree):
    def h(path):
        seed = 42 if doc_id is None else xxhash.xxh64(doc_id.to_bytes(8, "little", signed=True), 42).intdigest()
        return ((xxhash.xxh64(path.encode(), seed).intdigest() >> 11) + 1) / 2.0**53

    def total(node):
        return sum(map(total, node.values())) if isinstance(node, dict) else node

    path, node = "", tree
    while isinstance(node, dict):
        best = max(node, key=lambda c: (np.log(h(f"{path}/{c}")) / total(node[c]), c))
        path, node = f"{path}/{best}" if path else f"{best}", node[best]
    return best


def test_sharding(texts):
    for docs, rows in both(texts):
        got = sharding.shard_documents(docs, bucket_rows=50).collect()
        want = [(i, len(t.encode()) + 1, zlib.crc32(t.encode()), straw(i, sharding.EIGHT), straw(i, sharding.grown(sharding.EIGHT))) for i, t in rows]
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got), key=key) == sorted(want, key=key)
        assert all(r.grown_shard in (r.shard, 8) for r in got)
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def brute_secrets(text):
    spans = []
    for order, (kind, pattern, least, group) in enumerate([
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
        ("access", r"AKIA[A-Z0-9]+", 20, 0), ("hex", r"[0-9a-f]+", 24, 0),
    ]):
        spans += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def test_secrets(texts):
    for docs, rows in both(texts):
        got = sorted(((r.doc_id, r.base_sha256, r.spans) for r in secret_scan.find_secrets(docs).collect()), key=key)
        want = [(i, hashlib.sha256((s := brute_secrets(t)).encode()).hexdigest(), s) for i, t in rows]
        assert got == sorted(want, key=key)


def test_checked_secrets_and_redaction(spark):
    body = b"0123456789abcdefghijABCDEFGHIJ"
    good = "é ghp_" + (body + secret_scan.checksum(body)).decode()
    assert secret_scan.char_spans(good.encode()) == [("checked", 2, 42)]
    assert secret_scan.char_spans((good[:-1] + ("a" if good[-1] != "a" else "b")).encode()) == []
    docs = spark.createDataFrame([(1, good, "k"), (2, None, "k"), (3, "secret=abcdef0123456789abcdef0123456789 x", "k")], "doc_id bigint, text string, lang string")
    assert [tuple(r) for r in secret_scan.redact(docs).orderBy("doc_id").collect()] == [(1, "é [SECRET]", "k"), (2, None, "k"), (3, "[SECRET] x", "k")]


def test_licenses(spark, con, sf, odd):
    names, rows = spark_rows(queries.QUERIES["op1_license_scan"](spark, sf))
    assert (names, rows) == sql_rows(con, queries.SQL["op1_license_scan"])
    found = {r.doc_id: r.licenses for r in licenses.scan(odd).collect()}
    assert found[13] == "MIT" and found[0] == "" and len(found) == len(ODD) + 1
    ordered = spark.createDataFrame([(1, "Apache License\nVersion 2.0, January 2004"), (2, "Version 2.0, January 2004\nApache License")], "doc_id bigint, text string")
    assert [r.licenses for r in licenses.scan(ordered).orderBy("doc_id").collect()] == ["Apache-2.0", ""]


MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice.
"""
BSD_3 = BSD_2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""


def test_wrapped_licenses(spark):
    def marked(leader, text):
        return "\r\n".join(f"{leader} {line}".rstrip() for line in text.split("\n"))

    texts = {
        MIT: ("2,3,4", "MIT"),
        marked(" *", MIT): ("2,3,4", "MIT"),
        marked(";;", MIT): ("2,3,4", "MIT"),
        marked("rem", MIT).replace("\r\n", "\r"): ("2,3,4", "MIT"),
        BSD_2: ("15,16", "BSD-2-Clause"),
        BSD_2.replace("1.", "a)"): ("15,16", "BSD-2-Clause"),
        BSD_3: ("15,16,17", "BSD-3-Clause"),
        marked("#", BSD_3): ("15,16,17", "BSD-3-Clause"),
        marked("!", BSD_3): ("15,16,17", "BSD-3-Clause"),
        BSD_2 + BSD_3: ("15,16,15,16,17", "BSD-2-Clause,BSD-3-Clause"),
        BSD_3 + BSD_2: ("15,16,17,15,16", "BSD-2-Clause,BSD-3-Clause"),
        "no mark here\nlicensed under the\nMIT License": ("1", "MIT"),
        "licensed under the\n\nMIT License": ("2", ""),
        "licensed under the. MIT License, or not": ("", ""),
        "end.***\nLicensed under CC BY-NC 4.0.\nmore": ("12", "CC-BY-NC-4.0"),
        "This work is licensed under the GNU\n  General Public License,\n  version 3.": ("8", "GPL-3.0"),
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = licenses.scan(docs).orderBy("doc_id").collect()
    assert [(r.sentence_ids, r.licenses) for r in got] == list(texts.values())


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((i, t))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, keep, len(members), i == keep, hashlib.sha256(body.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=key)


@pytest.mark.parametrize("primes", [exact_dedup.PRIMES, (2, 3)])
def test_exact_groups(texts, primes):
    for docs, rows in both(texts) if primes[0] > 2 else [both(texts)[0]]:
        assert sorted(map(tuple, exact_dedup.exact_groups(docs, primes).collect()), key=key) == brute_exact(rows)


def test_fingerprints_compose():
    data = np.random.default_rng(1).integers(0, 256, 200_000).astype(np.uint8).tobytes()
    for base, prime in zip(exact_dedup.BASES, exact_dedup.PRIMES):
        whole = 0
        for b in data:
            whole = (whole * base + b + 1) % prime
        assert exact_dedup.fingerprint(data, base, prime) == whole


def brute_near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    inverted = defaultdict(list)
    for n, s in enumerate(sets):
        for g in s:
            inverted[g].append(n)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, s in enumerate(sets):
        for m, c in Counter(m for g in s for m in inverted[g] if m < n).items():
            if 100 * c >= percent * (len(s) + len(sets[m]) - c):
                a, b = find(n), find(m)
                root[max(a, b)] = min(a, b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[find(n)] = min(least.get(find(n), i), i)
    return sorted(((i, len(sets[n]), c := least.get(find(n)), i == c) for n, (i, _) in enumerate(rows)), key=key)


def test_near_duplicates(texts):
    for docs, rows in both(texts):
        assert sorted(map(tuple, near_dedup.near_duplicates(docs, 3, 85).collect()), key=key) == brute_near(rows, 3, 85)


@pytest.mark.parametrize("longest", [20_000, 20])
def test_near_duplicates_in_long_lists(spark, monkeypatch, longest):
    monkeypatch.setattr(near_dedup, "LONG", longest)
    monkeypatch.setattr(near_dedup, "BLOCK", 48)
    monkeypatch.setattr(near_dedup, "SMALL_LIST", 2)
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(160):
        words = [*base] if i % 4 else [f"p{j}" for j in range(20)] + [f"q{i}-{j}" for j in range(40)]
        for j in rng.integers(0, 60, rng.integers(0, 4)):
            words[j] = f"x{i}-{j}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, near_dedup.near_duplicates(docs, 3, 85).collect()), key=key) == brute_near(rows, 3, 85)


@pytest.mark.parametrize("percent, shared", [(80, 31), (85, 36)])
def test_estimates_keep_links_at_the_threshold(spark, percent, shared):
    def kept(n):
        own = (64 - n) // 2
        a, b = [*range(n + own), *range(1000, 1064 - n - own)], [*range(n), *range(n + own, 64), *range(2000, 2000 + own)]
        nodes = spark.createDataFrame([("a", 1000, a), ("b", 1000, b)], "node string, n long, sketch array<long>")
        return near_dedup._estimated(spark.createDataFrame([("a", "b")], "a string, b string"), nodes, percent / 100).count()

    # The binomial tail below ``shared`` of 64 is the last one under 1e-8.
    assert kept(shared) == 1 and kept(shared - 1) == 0
    assert near_dedup.estimate_least(percent / 100) == shared / 64


def test_nearest(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)], 0) for i in range(300)]
    rows += [(i + 300, rows[i][1], 0) for i in range(50)] + [rows[20], (400, None, 0), (420, [0.0] * 8, 0), (440, [float("nan")] * 8, 0), (460, [None] * 8, 0), (None, rows[1][1], 0)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int").repartition(3)
    got = sorted(map(tuple, nearest.nearest(table, F.col("id") % 20 == 0, k=5, block=64).collect()))
    vectors = {i: v for i, v, _ in rows[:350]}
    want = []
    for q in vectors:
        if q % 20 == 0:
            best = sorted((-reduce(lambda t, x: t + x[0] * x[1], zip(vectors[q], v), 0.0), i) for i, v in vectors.items() if i != q)[:5]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_quality_on_labels(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = quality.classify(docs).join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert sum(r.accepted for r in good) / len(good) >= 0.98
    assert sum(not r.accepted for r in bad) / len(bad) >= 0.8


def test_quality_of_odd_rows(odd, none):
    rows = quality.classify(odd).collect()
    assert len(rows) == len(ODD) + 3 and not next(r for r in rows if r.doc_id == 0).accepted
    assert quality.accepted(none).columns == none.columns


def test_empty_tables(spark, none):
    assert bpe.encode(none, BYTE).count() == 0
    assert packing.pack_documents(none, WORD).count() == 0
    assert sharding.shard_documents(none).count() == 0
    assert secret_scan.find_secrets(none).count() == 0
    assert licenses.scan(none).count() == 0
    assert exact_dedup.exact_groups(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert quality.classify(none).count() == 0
    target = scratch_path(spark, "files")
    token_files.write(none, WORD, target)
    assert token_files.read(spark, target).count() == 0
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert nearest.nearest(empty, F.col("id") % 20 == 0).count() == 0


def test_pipeline(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == columns, name
        before = [(r.doc_id, r.text or "") for r in docs.collect()]
        kept = sorted(r.doc_id for r in after.collect())
        if name == "exact dedup":
            assert kept == sorted(i for i, _, _, k, _ in brute_exact(before) if k)
        if name == "near dedup":
            assert kept == sorted(i for i, _, _, k in brute_near(before, 5, 80) if k)
        if name == "secret scan":
            assert kept == sorted(i for i, _ in before) and not any(brute_secrets(r.text) for r in after.collect())
        docs = after
    want = {r.doc_id for r in docs.collect()}
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == want
