"""BM25 where the documents lie, the stored index and fuzzy lookup, against the joins and against brute force."""

import random
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import lexical, lookup, ranking
from textloom.operators.index import StoredIndex
from textloom.plans import catalog
from textloom.session import scratch_path

def tokens():
    return T.tokenize_ws(F.col("text"))


def drawn(seed, count, longest):
    draw = random.Random(seed)
    words = [f"w{c}" for c in string.ascii_lowercase + "áéíó"]
    return [(i, " ".join(draw.choices(words, weights=range(30, 0, -1), k=draw.randint(0, longest)))) for i in range(count)]


@pytest.fixture(scope="module")
def tables(spark):
    docs = drawn(1, 300, 25)
    docs += [(1000 + i, docs[7][1]) for i in range(40)] + [(5000, None), (5001, "")]
    queries = drawn(2, 25, 9) + [(90, "wb wb wc"), (91, "absent"), (92, None)]
    return spark.createDataFrame(docs, "pair_id long, text string").repartition(6), spark.createDataFrame(queries, "query_id long, text string")


def rows(df):
    return sorted((r.query_id, r["rank"], r.pair_id, round(r.score, 6)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 400])
def test_local_ranking_equals_the_join(tables, k):
    docs, queries = tables
    joined = lexical.bm25_topk(queries, docs, tokens(), tokens(), k, index=lexical.postings(docs, "pair_id", tokens()))
    assert rows(lexical.bm25_topk(queries, docs, tokens(), tokens(), k)) == rows(joined)
    assert rows(lexical.bm25_topk(queries, docs, tokens(), tokens(), 0)) == []


def test_scoring_needs_no_exchange(tables):
    docs, queries = tables
    counted = lexical.counted(docs, "pair_id", tokens())
    terms = lexical.query_terms(queries, tokens()).join(lexical.bm25_stats(lexical.postings(docs, "pair_id", tokens()), docs), "token")
    scored = ranking.local_topk(terms.select("query_id", "token", "qtf", "idf", "avg_len").toArrow(), counted, 3)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("MapInArrow")]
    assert "Exchange" not in above
    assert scored.count() <= 3 * queries.count() * 8


def test_blocks_that_cannot_win_are_passed_over(tables):
    docs, queries = tables
    terms = lexical.query_terms(queries, tokens()).join(lexical.bm25_stats(lexical.postings(docs, "pair_id", tokens()), docs), "token")
    asked = ranking.Queries(terms.select("query_id", "token", "qtf", "idf", "avg_len").toArrow())
    best = ranking.Best(asked, 1, 1.5, 0.75)
    place = {t: i for i, t in enumerate(asked.tokens.to_pylist())}
    for pair_id, text in drawn(1, 300, 25):
        words = [w for w in text.split() if w in place]
        term, tf = np.unique(np.array([place[w] for w in words], np.int64), return_counts=True)
        best.add(np.array([pair_id]), np.array([len(text.split())]), np.zeros(len(term), np.int64), term, tf.astype(float))
    assert best.passed_over > 1000


def test_appended_documents_are_found(spark, tables):
    docs, queries = tables
    first, later = docs.where("pair_id % 3 > 0"), docs.where("pair_id % 3 = 0")
    index = StoredIndex(spark, scratch_path(spark, "index"))
    index.append(lexical.counted(first, "pair_id", tokens()))

    def ask(ranked):
        return rows(lexical.bm25_topk(queries, ranked, tokens(), tokens(), 4, forward=index.documents(), totals=index.totals()))

    def found():
        return sorted((r.token, r.pair_id, r.tf) for r in index.postings().where("token in ('wd', 'wó')").collect())

    assert ask(first) == rows(lexical.bm25_topk(queries, first, tokens(), tokens(), 4))
    index.append(lexical.counted(later, "pair_id", tokens()))
    assert len(index.segments()) == 2
    assert ask(docs) == rows(lexical.bm25_topk(queries, docs, tokens(), tokens(), 4))
    assert found() == sorted((r.token, r.pair_id, r.tf) for r in lexical.postings(docs, "pair_id", tokens()).where("token in ('wd', 'wó')").collect())
    assert StoredIndex(spark, index.path).totals().agg(F.sum("total")).first()[0] == docs.agg(F.sum(F.size(tokens()))).first()[0]


def test_index_keeps_languages_apart(spark):
    pairs = spark.createDataFrame([(1, "a b", "b c"), (2, "b", "a a")], "pair_id long, src string, tgt string")
    index = StoredIndex(spark, scratch_path(spark, "index"))
    index.append(lexical.parallel_counted(pairs, "za", "eng"))
    assert sorted(map(tuple, index.postings("eng").select("pair_id", "token", "tf").collect())) == [(1, "b", 1), (1, "c", 1), (2, "a", 2)]
    assert sorted(map(tuple, index.totals("za").collect())) == [("a", 1, 1), ("b", 2, 2)]


def test_word_pairs_by_the_rarer_word(spark):
    draw = random.Random(5)
    texts = [[" ".join(draw.choices("abcdefgh", weights=[50, 20, 9, 5, 3, 2, 1, 1], k=6)) for _ in range(2)] for _ in range(60)]
    pairs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(texts)], "pair_id long, src string, tgt string")
    asked = [(x, y) for x in "abcdefghz" for y in "abcdefghz"]
    got = lexical.lookup_word_pair(spark.createDataFrame([(f" {x.upper()}", y) for x, y in asked], "src_word string, tgt_word string"), lexical.parallel_postings(pairs, "za", "eng"), "za", "eng")
    want = [(x, y, i, s.split().count(x)) for x, y in asked for i, (s, t) in enumerate(texts) if x in s.split() and y in t.split()]
    assert sorted((r.src_word.strip().lower(), r.tgt_word, r.pair_id, r.tf) for r in got.collect()) == sorted(want)


@pytest.mark.parametrize(("together", "rows_a_batch"), [(20_000, 10_000), (4, 7)])
def test_word_pairs_move_no_row_for_each_asked_pair_of_a_posting(spark, monkeypatch, together, rows_a_batch):
    monkeypatch.setattr(lexical, "ROWS_TOGETHER", together, raising=False)
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_a_batch))
    try:
        # One source word in all pairs, asked with 40 target words that stand beside it twice each.
        names = [x + y for x in "tuvwx" for y in "abcdefgh"]
        texts = [(i, "w " + "x " * (i % 3), f"{names[i % 40]} {names[(i + 7) % 40]}") for i in range(80)] + [(None, "w", "ta"), (500, "w", None)]
        pairs = spark.createDataFrame(texts, "pair_id long, src string, tgt string")
        asked = [(x, y) for x in ("w", "W ", "x", "none") for y in [*names, "zz"]] * 2 + [(None, "ta"), ("w", None)]
        index = lexical.parallel_postings(pairs, "za", "eng")
        found = lexical.lookup_word_pair(spark.createDataFrame(asked, "src_word string, tgt_word string"), index, "za", "eng")
        want = [(x, names[t], i, s.split().count(x.strip().lower())) for x in ("w", "W ", "x") for i, s, g in texts[:80] for t in (i % 40, (i + 7) % 40) if x.strip().lower() in s.split()]
        assert sorted(map(tuple, found.select("src_word", "tgt_word", "pair_id", "tf").collect())) == sorted(want)
        assert "_salt" not in found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)


@pytest.mark.parametrize("bits", [20, 2])
def test_asked_pairs_of_a_word_are_handed_over_in_lists(spark, monkeypatch, bits):
    monkeypatch.setattr(lexical, "LIST_BITS", bits, raising=False)
    counts, real = [], lexical.spread
    monkeypatch.setattr(lexical, "spread", lambda df, *keys: counts.append(df.count()) or real(df, *keys))
    names = [x + y for x in "tuvwx" for y in "abcdefgh"]
    texts = [(i, "w x", names[i % 40]) for i in range(50)]
    pairs = spark.createDataFrame(texts, "pair_id long, src string, tgt string")
    asked = spark.createDataFrame([(x, y) for x in "wx" for y in names], "src_word string, tgt_word string")
    got = lexical.lookup_word_pair(asked, lexical.parallel_postings(pairs, "za", "eng"), "za", "eng")
    assert sorted(map(tuple, got.collect())) == sorted((x, t, i, 1) for i, _, t in texts for x in "wx")
    # 100 source postings, and 80 asked pairs in a list or some lists a word.
    assert 102 <= counts[0] <= (102 if bits == 20 else 160)


def test_texts_of_the_asked_pairs_are_cut_once_a_pass(spark, sf, monkeypatch):
    monkeypatch.setattr(lexical, "lookup_word_pair", lambda word_pairs, *rest: word_pairs)
    plan = catalog.QUERIES["lookup_word_pair"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_remove") == 1


def test_word_pairs_of_repeated_pairs(spark):
    pairs = spark.createDataFrame([(1, "a b", "x"), (1, "a", "x y"), (2, "b", "y"), (3, "c", "x")], "pair_id long, src string, tgt string")
    asked = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y"), ("c", "y")], "src_word string, tgt_word string")
    got = lexical.lookup_word_pair(asked, lexical.parallel_postings(pairs, "za", "eng"), "za", "eng")
    assert sorted(map(tuple, got.collect())) == [("a", "x", 1, 1), ("a", "x", 1, 1), ("b", "x", 1, 1), ("b", "y", 1, 1), ("b", "y", 2, 1)]


def edits(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]


@pytest.mark.parametrize("rounds", [(2,), (1, 3), ()])
def test_fuzzy_lookup_with_long_words_and_many_blocks(spark, monkeypatch, rounds):
    monkeypatch.setattr(lookup, "EDITS", rounds)
    monkeypatch.setattr(lookup, "BLOCK_WORDS", 7)
    monkeypatch.setattr(lookup, "BLOCK_ENTRIES", 16)
    draw = random.Random(9)
    long = "".join(draw.choices(string.ascii_lowercase, k=1000))
    entries = {"".join(draw.choices("abé\U0001f600", k=draw.randint(1, 9))) for _ in range(120)} | {long, long[5:], long[:300] + "x" + long[300:], "q" * 64, "q" * 65}
    words = {"".join(draw.choices("abé\U0001f600", k=draw.randint(1, 10))) for _ in range(40)} | {long[:-1], long[:500] + "yy" + long[501:], "q" * 63, "q" * 66 + "z", "zzzz"}
    order = {e: (draw.randint(0, 5), i) for i, e in enumerate(sorted(entries))}
    pool = spark.createDataFrame([(e, r) for e, r in order.items()], "match string, entry_rank struct<doc_id:bigint,pos:int>").repartition(4)
    got = lookup.dict_fuzzy_topk(spark.createDataFrame([(w,) for w in [*words, None, ""]], "word string"), pool, 3)
    want = []
    for w in words:
        scored = sorted((-round(100 * (1 - edits(w, e) / max(len(w), len(e))), 9), r, e) for e, r in order.items())
        want += [(w, i, e, round(-s, 6)) for i, (s, _, e) in enumerate(scored[:3], 1)]
    assert sorted((r.word, r["rank"], r.match, round(r.score, 6)) for r in got.collect()) == sorted(want)
