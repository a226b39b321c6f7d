"""The remembering encoder against the library, and the numbers and columns of packed pieces."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from textloom.llm import packing, token_files, tokens

WORD = public_tokenizers.path("word_bpe_49k.json")


def test_encoder_equals_the_library():
    library, encode = Tokenizer.from_file(WORD), tokens.packed_encoder(WORD)
    draw = random.Random(2)
    parts = [*"abZ é,.;:!?'1 \n\t-\"́̀ßİ<|s>", "'s", "<|endoftext|>", "'re", "l'"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 14))) for _ in range(5000)] + ["İ, i̇, İİ.", "a.b,c d.'s e,́", "x" * 70 + ","]
    for text in texts:
        assert np.frombuffer(encode(text.encode()), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_sequences_are_numbered_without_clashes(spark):
    draw = random.Random(3)
    sizes = [draw.choice([1, 700, 2049, 4000, 4096]) for _ in range(900)]
    rows = [(i, n, "a", "b", 1, 2, 3) for i, n in enumerate(sizes)]
    pieces = spark.createDataFrame(rows, "id int, length int, at string, piece string, bin int, _group int, offset int").repartition(4)
    packed = packing.pack(pieces, 4096, group=100)
    assert packed.columns == ["id", "length", "at", "piece", "bin", "_group", "sequence_id", "offset"]
    found = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.collect_list(F.struct("offset", "length")).alias("p")).collect()
    assert sum(len(r.p) for r in found) == 900
    for r in found:
        assert r.n <= 4096
        at = 0
        for offset, length in sorted(r.p):
            assert offset == at
            at += length


def test_documents_of_a_shard_equal_random_access():
    draw = np.random.default_rng(4)
    phrase = draw.integers(0, 50, 40)
    docs = [(i, np.concatenate([phrase[: draw.integers(0, 41)] for _ in range(draw.integers(0, 30))] or [np.empty(0, int)]).astype(np.uint32)) for i in range(200)]
    shard = token_files.Shard(token_files.pack_shard([(i, x) for i, x in docs]))
    assert len(shard.rules)
    for n, (whole, (_, want)) in enumerate(zip(shard.documents(), docs)):
        assert whole.tolist() == shard.ids(n).tolist() == want.tolist()
