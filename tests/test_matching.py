"""Longest matches in the tasks against the joins on substrings, and blocks of great length."""

import random
import time

import pytest
from pyspark.sql import functions as F

from textloom.operators import encoding, matching


def drawn(seed, letters, count, longest):
    draw = random.Random(seed)
    return sorted({"".join(draw.choices(letters, k=draw.randint(1, longest))) for _ in range(count)})


@pytest.mark.parametrize("letters", ["ab", "aé日#\U0001f600.", "abcdefgh-"])
def test_tasks_and_joins_agree(spark, monkeypatch, letters):
    tokens = drawn(1, letters, 25, 4)
    vocab = spark.createDataFrame([(t,) for t in [*tokens, *("##" + t for t in drawn(2, letters, 25, 3)), "[UNK]", None]], "token string")
    added = spark.createDataFrame([(t,) for t in drawn(3, letters, 6, 5)], "token string")
    words = spark.createDataFrame([(w,) for w in [*drawn(4, letters, 120, 12), "", None]], "word string")
    chunks = words.toDF("chunk")
    texts = words.select(F.monotonically_increasing_id().alias("id"), F.col("word").alias("text"))

    def results():
        return [
            sorted((r.word, r.tokens) for r in encoding.encode_words(words, vocab, 9).collect()),
            sorted((r.chunk, r.tokens) for r in encoding.encode_chunks(chunks, vocab).collect()),
            sorted((r.chunk, r.tokens) for r in encoding.encode_chunks(chunks, vocab, added, 9).collect()),
            sorted((r.id, r.tokens) for r in encoding.segment(texts, "id", F.col("text"), vocab, search=True).collect()),
        ]

    in_tasks = results()
    monkeypatch.setattr(matching, "LEXICON_ROWS", 3)
    assert results() == in_tasks


def test_a_block_of_thirty_thousand_characters(spark):
    draw = random.Random(7)
    lexicon = drawn(8, "abcd", 3000, 12)
    text = "".join(draw.choices("abcde", k=30_000))
    texts = spark.createDataFrame([(1, text)], "id int, text string")
    began = time.time()
    tokens = encoding.segment(texts, "id", F.col("text"), spark.createDataFrame([(t,) for t in lexicon], "token string")).first().tokens
    assert time.time() - began < 30
    assert "".join(tokens) == text
    known, at = set(lexicon), 0
    for token in tokens:
        longest = next((n for n in range(min(12, len(text) - at), 1, -1) if text[at : at + n] in known), 1)
        assert len(token) == longest
        at += longest


def test_counted_chunks_give_token_lengths(spark):
    docs = spark.createDataFrame([(1, "a b  a\tC"), (2, ""), (3, None), (4, "c")], "doc_id long, text string")
    counts = encoding.chunk_counts(docs, F.col("text"))
    assert sorted(map(tuple, counts.collect())) == [(1, "a", 2), (1, "b", 1), (1, "c", 1), (4, "c", 1)]
    sizes = spark.createDataFrame([("a", 1, 2), ("b", 3, 1), ("c", 1, 5)], "chunk string, x long, y long")
    assert sorted(map(tuple, encoding.token_lengths(counts, sizes, "x", "y").collect())) == [(1, 6, 10), (4, 1, 5)]
