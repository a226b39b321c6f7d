"""The dictionary of all uses of words against a plain loop, its plans, and pools cut down to affixes."""

import pytest

from textloom.operators import lookup
from textloom.plans import catalog
from textloom.plans import inputs as I

DOCS = [(7, "Red fox, red hen", "s2"), (None, "fox owl", "s1"), (7, "hen", None), (-3, "owl red", "s3"), (2**62, "fox", "s1"), (5, None, "s4"), (6, "", "s4")]


@pytest.fixture
def small(spark, tmp_path):
    spark.createDataFrame(DOCS, "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([("rose", "B2"), ("rust", "B1"), ("rust", "B1"), (None, "B9")], "p_name string, p_brand string").write.parquet(str(tmp_path / "part.parquet"))
    return str(tmp_path)


def plain():
    uses = {}
    for doc_id, text, source in DOCS:
        for pos, word in enumerate((text or "").lower().replace(",", " ").split()):
            uses.setdefault(word, []).append(((doc_id is not None, doc_id or 0, pos), doc_id, source))
    out = {}
    for word, rows in uses.items():
        (_, _, pos), doc_id, _ = min(rows, key=lambda r: r[0])
        out[word] = (["B1", "B2"] if word[0] == "r" else [word], max(rows, key=lambda r: r[0])[2], (doc_id, pos))
    return out


@pytest.mark.parametrize("sources", [0, 1_000_000])
def test_first_place_and_last_source_of_every_word(spark, small, monkeypatch, sources):
    monkeypatch.setattr(I, "SOURCES", sources)
    found = {r.word: (r.meanings, r.source, tuple(r.entry_rank)) for r in I.dictionary(spark, small).collect()}
    assert found == plain()
    only = spark.createDataFrame([("fox",), ("fox",), ("emu",), (None,)], "word string")
    assert {r.word: (r.meanings, r.source, tuple(r.entry_rank)) for r in I.dictionary(spark, small, only).collect()} == {"fox": plain()["fox"]}


def test_uses_are_not_sorted(spark, sf):
    for name in ("load_dictionary", "dict_exact", "dict_prefix"):
        assert "SortAggregate" not in catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString(), name


@pytest.mark.parametrize("fits", [True, False])
def test_a_pool_of_affixes_serves_prefix_and_suffix(spark, monkeypatch, fits):
    monkeypatch.setattr(lookup, "fits_broadcast", lambda df: fits)
    words = spark.createDataFrame([("barfoo",), ("foofoo",), ("x",), ("",)], "word string")
    pool = spark.createDataFrame([("bar", 1), ("foo", 2), ("arf", 3), ("oo", 4), ("foo", 5)], "match string, entry_rank int")
    near = lookup.affix_entries(words, pool)
    assert sorted(r.match for r in near.collect()) == ["bar", "foo", "oo"]
    for entries in (pool, near):
        prefix = lookup.dict_prefix(words, entries)
        assert sorted((r.word, r.match) for r in prefix.collect()) == [("barfoo", "bar"), ("foofoo", "foo")]
        assert sorted((r.word, r.match) for r in lookup.dict_suffix(words, entries, prefix).collect()) == [("barfoo", "foo"), ("foofoo", "oo")]
