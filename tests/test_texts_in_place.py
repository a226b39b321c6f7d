"""Texts encoded, counted and decoded where they lie against the joins, with repeated and null ids."""

import random
from collections import Counter

from pyspark.sql import functions as F

from textloom.operators import encoding, matching

PIECES = ["a", "b", "ab", "-", "##a", "##b", "##bb", "c"]
SPECIAL = ["[CLS]", "[SEP]", "[UNK]"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_texts_in_place_and_by_joins_agree(spark, monkeypatch):
    monkeypatch.setattr(matching, "USES_AT_ONCE", 7)
    draw = random.Random(2)
    texts = ["".join(draw.choices("abAc -z\t", k=draw.randint(0, 30))) for _ in range(30)] + ["", None, "  ", "zz z"]
    rows = [*enumerate(texts), (3, "ab a-b"), (3, "ab a-b"), (4, "c"), (None, "ba ab"), (None, "c b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).persist()
    ids = {"[UNK]": 1, "[CLS]": 2, "[SEP]": 3} | {t: 4 + i for i, t in enumerate(PIECES)}
    vocab = spark.createDataFrame([*ids.items(), ("a", 99), (None, 98)], "token string, token_id long").coalesce(1).persist()

    tokens = encoding.encode_texts(docs, F.col("text"), vocab).persist()
    uses = encoding.chunk_uses(docs, F.col("text"))
    found = rows_of(tokens)
    assert found == rows_of(encoding.encode_docs(uses, encoding.encode_chunks(uses, vocab)))
    assert rows_of(encoding.text_lengths(docs, F.col("text"), vocab)) == sorted(((i, len(t)) for i, t in found), key=str)

    numbered = encoding.encode_ids(tokens, vocab)
    assert rows_of(numbered) == sorted(((i, [2, *(ids.get(x, 1) for x in t), 3]) for i, t in found), key=str)
    plain = [(i, " ".join(x for x in t if x not in SPECIAL).replace(" ##", "")) for i, t in found if set(t) - set(SPECIAL)]
    assert rows_of(encoding.decode_ids(numbered, vocab, SPECIAL)) == sorted(plain, key=str)


def test_added_tokens_are_counted_as_encoded(spark):
    docs = spark.createDataFrame([(1, "abab c-a"), (1, "Bab"), (2, ""), (None, "abbab zbab")], "doc_id long, text string").coalesce(1)
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate([*PIECES, "[UNK]"])], "token string, token_id long").coalesce(1)
    added = spark.createDataFrame([("bab",), ("c-",)], "token string").coalesce(1)
    counts = Counter()
    tokens = {r.chunk: r.tokens for r in encoding.encode_chunks(docs.select(F.explode(F.split(F.lower("text"), " ")).alias("chunk")), vocab, added).collect()}
    assert tokens["c-a"] == ["c-", "a"] and tokens["abab"] == ["a", "bab"]
    for i, chunks in ((1, ["abab", "c-a", "bab"]), (None, ["abbab", "zbab"])):
        counts[i] += sum(len(tokens[c]) for c in chunks)
    assert dict(map(tuple, encoding.text_lengths(docs, F.col("text"), vocab, added).collect())) == dict(counts)


def test_texts_with_ids_of_their_own_are_not_moved(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    vocab = spark.createDataFrame([("a", 1), ("b", 2), ("[UNK]", 0)], "token string, token_id long")
    ids = encoding.encode_ids(encoding.encode_texts(docs, F.col("text"), vocab), vocab)
    assert "Exchange" not in encoding.decode_ids(ids, vocab, [])._jdf.queryExecution().executedPlan().toString()
