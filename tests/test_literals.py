"""Literal rows for the quirks that the generated tables do not reach."""

import pytest
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import class_metrics, encoding, lexical, lookup, shaping, translation_metrics, vector, vocabulary
from textloom.sources import contracts, lines, sinks, tables

CORPUS = [
    "peking university is located in haidian district",
    "computer science is the flagship major of peking university",
    "the school of electronic engineering and computer science enrolls approximately five hundred new students each year",
]


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    ("text", "tokens"),
    [
        ("Gou dwg, Vangz 123Gangh.", ["gou", "dwg", "vangz", "gangh"]),
        ("a1b", ["ab"]),
        ("a\tb c", ["a\tb", "c"]),
        (" \tx\n y　 ", ["x", "y"]),
        ("", []),
        ("《一》 二", ["一", "二"]),
    ],
)
def test_tokenize_ws(spark, text, tokens):
    assert one(spark, text, T.tokenize_ws) == tokens


def test_other_tokenizers(spark):
    assert one(spark, "hi, x1!", T.tokenize_ws_keep) == ["hi", ",", "x1", "!"]
    assert one(spark, "SARS-CoV-2 (RT-PCR).", T.pretokenize) == ["SARS", "-", "CoV", "-", "2", "(", "RT", "-", "PCR", ")."]
    assert one(spark, "a(b).", lambda x: T.pretokenize(x, True)) == ["a", "(", "b", ")", "."]
    assert one(spark, "‘a’", T.fold_apostrophes) == "'a'"
    assert one(spark, "a\tb\x07中c", T.normalize_text) == "a b 中 c"
    assert one(spark, "A b, a. B", T.word_set) == ["a", "b"]
    assert one(spark, "a", lambda x: T.word_ngrams(T.tokenize_ws(x), 2)) == []
    assert one(spark, "", lambda x: T.char_ngrams(x, 1)) == []


def test_pretokenizers_match_public_library(spark):
    pre = pytest.importorskip("tokenizers").pre_tokenizers
    for text in ["SARS-CoV-2 (RT-PCR).", "It's  é_1 $5.00\n—“q”", "aé中文，x"]:
        assert one(spark, text, T.pretokenize) == [w for w, _ in pre.Whitespace().pre_tokenize_str(text)]
        assert one(spark, text, lambda x: T.pretokenize(x, True)) == [w for w, _ in pre.BertPreTokenizer().pre_tokenize_str(text)]


@pytest.mark.parametrize(
    ("line", "text"),
    [
        ('{"title":"B","text":"A"}', "A B"),
        ('{"abstract":["x","y"]}', "x y"),
        ('{"k":"v"}', "v"),
        ('"s"', "s"),
        ("123", None),
        ("plain", "plain"),
        ("  ", None),
        ("123 abc", "123 abc"),
        ('{"a":"x"} tail', '{"a":"x"} tail'),
        ('{"z":"p","b":"q"}', "p q"),
        ('{"text":"","body":["a",null,true]}', "a None True"),
        ('"' + "\\n" * 20000 + 'x"', "x"),
    ],
)
def test_extract_text(spark, line, text):
    rows = lines.extract_text(spark.createDataFrame([(line,)], "value string")).collect()
    assert [r.text for r in rows] == ([] if text is None else [text])


def test_contract_reports_each_rule(spark):
    bad = [
        "[]",
        '{"id":"1","question":1,"model_responses":{}}',
        '{"id":true,"question":"q","reference_answer":"a","model_responses":[1,{"model":"m","output":2}]}',
    ]
    items = spark.createDataFrame(list(enumerate(bad)), "item_id long, j string").select("item_id", F.parse_json("j").alias("item"))
    report = {r.rule: (r.violations, r.first_bad_item) for r in contracts.validate_responses(items).collect()}
    assert report["item_is_object"] == (1, 0)
    assert report["id_is_integer"] == (2, 1)
    assert report["question_is_string"] == (1, 1)
    assert report["reference_answer_is_string"] == (1, 1)
    assert report["model_responses_is_list"] == (1, 1)
    assert report["response_is_object"] == (1, 2)
    assert report["output_is_string"] == (1, 2)
    assert report["remark_is_string"] == (1, 2)
    assert report["at_least_two_items"] == (0, None)
    with pytest.raises(ValueError):
        contracts.validate_responses(items.limit(1), strict=True)


def test_wide_integers_are_integers(spark):
    ids = ["12345678901234567890", "-10000000000000000000", "1", "1.0", "1.5", "true", '"1"']
    rows = spark.createDataFrame([(n, f'{{"id": {x}}}') for n, x in enumerate(ids)], "item_id long, j string")
    items = rows.select("item_id", F.parse_json("j").alias("item"))
    bad = contracts.item_violations(items).where("rule = 'id_is_integer'").orderBy("item_id").collect()
    assert [r.item_id for r in bad] == [3, 4, 5, 6]


def test_parallel_pairs_are_numbered_as_in_the_files(spark, tmp_path):
    for part in ("a", "b"):
        rows = [f'{{"za": "{part}{i}", "zh": "x{i}"}}\n' for i in range(500)]
        (tmp_path / f"{part}.jsonl").write_text("".join(rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        pairs = tables.read_parallel(spark, f"{tmp_path}/*.jsonl", "za", "zh", position=None)
        found = {r.pair_id: r.src for r in pairs.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {i: f"{'ab'[i // 500]}{i % 500}" for i in range(1000)}


def test_unspaced_side_of_the_index(spark):
    pairs = spark.createDataFrame([(0, "gou", "中国人民"), (1, "gou mwngz", "人民"), (2, "", "")], "pair_id long, src string, tgt string")
    lexicon = spark.createDataFrame([("中国",), ("人民",)], "token string")
    rows = lexical.parallel_postings(pairs, "za", "zh", lexicon).where("lang = 'zh'").collect()
    assert sorted((r.pair_id, r.token, r.tf) for r in rows) == [(0, "中国", 1), (0, "人民", 1), (1, "人民", 1)]
    with pytest.raises(ValueError):
        lexical.parallel_postings(pairs, "za", "zh")


def test_sources_reject_and_resolve(spark):
    with pytest.raises(NotImplementedError):
        tables.read_parallel(spark, "x.csv", "za", "zh")
    with pytest.raises(ValueError):
        tables.resolve_text_column(spark.createDataFrame([(1,)], "n int"))


def test_dictionary_last_entry_wins(spark):
    entries = spark.createDataFrame([("w", ["a"], "s1", 0), ("v", ["c"], "s1", 1), ("w", ["b"], "s2", 2)], "word string, meanings array<string>, source string, entry_rank long")
    rows = {r.word: (r.meanings, r.source, r.entry_rank) for r in tables.load_dictionary(entries).collect()}
    assert rows["w"] == (["b"], "s2", 0)


def test_published_tokenization(spark):
    docs = spark.createDataFrame(list(enumerate(CORPUS)), "doc_id long, text string")
    words = vocabulary.word_freq(docs, T.pretokenize(F.col("text"), True))
    vocab = vocabulary.train_wordpiece(words, 120)
    query = spark.createDataFrame([(0, "nous etudions a l universite de pekin")], "doc_id long, text string")
    uses = encoding.chunk_uses(query, F.col("text"))
    tokens = encoding.encode_docs(uses, encoding.encode_chunks(uses, vocab)).first().tokens
    golden = "n ##o ##u ##s e ##tud ##i ##o ##n ##s a l univ ##e ##rsi ##t ##e d ##e p ##e ##ki ##n"
    assert tokens == golden.split()


def test_batched_merges_equal_single_merges(spark):
    docs = spark.createDataFrame([(0, "aaaa abab banana bandana cabana " * 2 + "aaaab zzzz")], "doc_id long, text string")
    words = vocabulary.word_freq(docs, T.pretokenize(F.col("text")))
    runs = [vocabulary.train_merges(words, 30, "frequency", batch=b, checkpoint_every=7).collect() for b in (1, 256)]
    assert runs[0] == runs[1]


def test_word_encoding_matches_public_library(spark):
    models = pytest.importorskip("tokenizers").models
    vocab = {"[UNK]": 0, "un": 1, "##aff": 2, "##able": 3, "una": 4, "##f": 5, "##fable": 6, "a": 7, "##a": 8}
    model = models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10_000)
    words = ["unaffable", "una", "unaf", "unb", "a" * 30, "a" * 101]
    table = spark.createDataFrame([(t, i) for t, i in vocab.items()], vocabulary.VOCAB_SCHEMA)
    rows = encoding.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), table).collect()
    assert {r.word: r.tokens for r in rows} == {w: [t.value for t in model.tokenize(w)] for w in words}


def test_added_tokens_split_words(spark):
    vocab = spark.createDataFrame([(t, i) for i, t in enumerate(["[UNK]", "x", "##x", "a", "##b"])], vocabulary.VOCAB_SCHEMA)
    added = spark.createDataFrame([("cell",), ("cellular",)], "token string")
    chunks = spark.createDataFrame([("xxcellularab",), ("ab",), ("cell",), ("x-x",)], "chunk string")
    rows = {r.chunk: r.tokens for r in encoding.encode_chunks(chunks, vocab, added).collect()}
    assert rows == {"xxcellularab": ["x", "##x", "cellular", "a", "##b"], "ab": ["a", "##b"], "cell": ["cell"], "x-x": ["x", "[UNK]", "x"]}


def test_segment_gap_gives_single_characters(spark):
    texts = spark.createDataFrame([(0, "中国人Q民")], "id long, text string")
    lexicon = spark.createDataFrame([("中国",), ("国人",), ("中国人",)], "token string")
    assert encoding.segment(texts, "id", F.col("text"), lexicon).first().tokens == ["中国人", "q", "民"]
    assert encoding.segment(texts, "id", F.col("text"), lexicon, search=True).first().tokens == ["中国", "国人", "中国人", "q", "民"]


def test_selection_tiers(spark):
    trained = spark.createDataFrame([(t,) for t in ["immunology", "geneticist", "##cell", "zebra", "ox", "##abc", "known"]], "token string")
    base = spark.createDataFrame([("known", 0)], vocabulary.VOCAB_SCHEMA)

    def pick(n):
        return [r.token for r in vocabulary.select_new_tokens(trained, base, n).orderBy("pos").collect()]

    assert pick(2) == ["geneticist", "immunology"]
    assert pick(10) == ["geneticist", "immunology", "##cell", "zebra"]


def test_published_length_statistics(spark):
    rows = spark.range(1000).select(
        F.lit(0).alias("doc_id"),
        F.lit(67).alias("base_tokens"),
        F.when(F.col("id") < 847, 6).when(F.col("id") < 909, 0).otherwise(-2).alias("saved"),
    ).withColumn("extended_tokens", F.col("base_tokens") - F.col("saved"))
    stats = encoding.token_length_stats(rows).first()
    assert (stats.improved, stats.same, stats.worse) == (847, 62, 91)
    assert round((67.13 - 61.65) / 67.13 * 100, 2) == 8.16


def test_shaping(spark):
    row = spark.createDataFrame([([0, 3, 10, -1], [5, 6, 7])], "label array<int>, ids array<int>")
    assert row.select(shaping.multilabel_binarize(F.col("label"), 4).alias("y")).first().y == [1, 0, 0, 1]
    columns = shaping.pad_truncate(F.col("ids"), 4, 1, 2, 0)
    assert row.select(*[c.alias(n) for n, c in columns.items()]).first()[0] == [1, 5, 6, 2]
    wide = shaping.pad_truncate(F.col("ids"), 7, 1, 2, 0)
    fixed = row.select(*[c.alias(n) for n, c in wide.items()]).first()
    assert (fixed.input_ids, fixed.attention_mask) == ([1, 5, 6, 7, 2, 0, 0], [1, 1, 1, 1, 1, 0, 0])


def test_metrics_on_literals(spark):
    rows = spark.createDataFrame([(0, 0), (0, 2), (1, 1), (1, 1)], "label int, prediction int")
    got = class_metrics.classification_metrics(rows).first()
    assert got.accuracy == got.micro_f1 == 0.75
    assert got.macro_f1 == pytest.approx((2 / 3 + 1 + 0) / 3, abs=1e-4)
    runs = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.7)], "epoch int, f1 double")
    assert class_metrics.best_run(runs).first().epoch == 2
    assert class_metrics.best_run(runs.withColumn("f1", F.lit(0.0))).count() == 0


def test_bm25_matches_brute_force_and_pads(spark):
    import math

    docs = {1: "a b a", 2: "b c", 3: "c d e f", 4: "", 5: "a", 6: "g h", 7: "g i"}
    table = spark.createDataFrame(list(docs.items()), "pair_id long, text string")
    queries = spark.createDataFrame([(0, "a b a"), (1, "zzz")], "query_id long, text string")
    tokens = T.tokenize_ws(F.col("text"))
    split = {i: t.split() for i, t in docs.items()}
    n, avg = len(docs), sum(map(len, split.values())) / len(docs)
    idf = {}
    for term in {t for ts in split.values() for t in ts}:
        df = sum(term in ts for ts in split.values())
        idf[term] = math.log(n - df + 0.5) - math.log(df + 0.5)
    mean = sum(idf.values()) / len(idf)
    idf = {t: (v if v >= 0 else 0.25 * mean) for t, v in idf.items()}

    def score(i):
        return sum(
            idf.get(q, 0) * split[i].count(q) * 2.5 / (split[i].count(q) + 1.5 * (0.25 + 0.75 * len(split[i]) / avg)) for q in ["a", "b", "a"]
        )

    best = sorted(docs, key=lambda i: (-round(score(i), 9), -i))[:3]
    for parts in (1, 7, 64):
        rows = lexical.bm25_topk(queries, table.repartition(parts), tokens, tokens, k=3, pad_zero=True).orderBy("query_id", "rank").collect()
        assert [r.pair_id for r in rows if r.query_id == 0] == best
        assert [(r.pair_id, r.score) for r in rows if r.query_id == 1] == [(7, 0.0), (6, 0.0), (5, 0.0)]
        assert rows[0].score == pytest.approx(score(best[0]))


def test_keyword_weights(spark):
    rules = spark.createDataFrame([(0, "a x", [("b", "", {"K": "v"})])], tables.RULE_SCHEMA)
    queries = spark.createDataFrame([(0, ["a", "b"], ["K"])], "query_id long, words array<string>, keys array<string>")
    assert vector.keyword_score(queries, rules).first().kw == 6


def test_vector_search_in_blocks(spark, monkeypatch):
    rows = [(i, [float((i * 7 + j * 3) % 11 - 5) for j in range(4)]) for i in range(40)]
    vecs = vector.unit_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id").persist()
    queries, items = vecs.where("id < 10"), vecs.where("id >= 10")
    whole = vector.cosine_topk(queries, items, 3).collect()
    swapped = vector.cosine_topk(items, queries, 2).count()
    monkeypatch.setattr(vector, "BLOCK_BYTES", 64)
    assert sorted(map(tuple, vector.cosine_topk(queries, items, 3).select("query_id", "item_id", "rank").collect())) == sorted(
        (r.query_id, r.item_id, r["rank"]) for r in whole
    )
    assert swapped == 60
    assert vector.cosine_topk(queries, items, 0).count() == 0


def test_affix_lookup(spark):
    def run(entries, word, min_chars=1):
        pool = spark.createDataFrame([(w, i) for i, w in enumerate(entries)], "match string, entry_rank long").where(F.length("match") >= min_chars)
        words = spark.createDataFrame([(word,)], "word string")
        prefix = lookup.dict_prefix(words, pool)
        return [r.match for r in prefix.collect()], [r.match for r in lookup.dict_suffix(words, pool, prefix).collect()]

    assert run(["abc", "cde"], "abcde") == (["abc"], ["cde"])
    assert run(["abcd", "bcd"], "abcd") == (["abcd"], ["bcd"])
    assert run(["ab"], "abx", 3) == ([], [])


def test_fuzzy_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    entries = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 12))) for _ in range(300)})
    asked = sorted({"".join(rng.choice("abcé") for _ in range(rng.randint(1, 14))) for _ in range(40)})
    pool = spark.createDataFrame([(w, i) for i, w in enumerate(entries)], "match string, entry_rank long")
    words = spark.createDataFrame([(w,) for w in asked], "word string")
    pairs = words.join(pool, F.lit(True)).withColumn("score", lookup.edit_similarity(F.col("word"), F.col("match")))
    want = lexical.top_k(pairs, 3, "word", [F.round("score", 9).desc(), F.col("entry_rank").asc()])
    got = lookup.dict_fuzzy_topk(words, pool, 3)
    columns = ["word", "match", "rank", F.round("score", 6)]
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))


def test_translation_scores(spark):
    same = spark.createDataFrame([("the cat sat on the mat .", "the cat sat on the mat .")], "pred string, gold string")
    assert translation_metrics.corpus_bleu(same).first().score == 100.0
    assert translation_metrics.chrf(same, 2).first().score == 100.0
    some = spark.createDataFrame([("a b c d e f", "a b c d e x"), ("", "w x y z")], "pred string, gold string")
    assert 0 < translation_metrics.corpus_bleu(some).first().score < 100
    none = spark.createDataFrame([("q q q q", "a b c d")], "pred string, gold string")
    assert translation_metrics.corpus_bleu(none).first().score == 0.0


def test_submission_round_trip(spark, tmp_path):
    rows = [("1", 'a "q"\nb, c'), ("2", " padded "), ("3", "中文\\n")]
    path = str(tmp_path / "s")
    sinks.write_submission(spark.createDataFrame(rows, "id string, translation string"), path)
    assert sorted(map(tuple, sinks.read_submission(spark, path).collect())) == rows


def test_init_vectors_keep_old_rows_and_partitioning(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "vec_id long, embedding array<float>")
    grown = sorted(map(tuple, vector.init_vectors(rows, 3).collect()))
    assert len(grown) == 13 and grown[:10] == sorted(map(tuple, rows.collect()))
    assert grown == sorted(map(tuple, vector.init_vectors(rows.repartition(5), 3).collect()))
    assert all(v[1] == 1.0 for _, v in grown)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, sf):
    from textloom.plans import catalog

    for name in ("bm25_topk", "dict_prefix", "dict_suffix", "keyword_score"):
        plan = plan_of(catalog.QUERIES[name](spark, sf))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    assert "WindowGroupLimit" in plan_of(catalog.QUERIES["bm25_topk"](spark, sf))
