"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

HEADLINE = [
    "word_freq",
    "pair_stats",
    "tokenize_ws",
    "extract_text",
    "inverted_index",
    "bm25_stats",
    "bm25_topk",
    "tfidf",
    "wordpiece_encode",
    "compare_tokenizers",
    "cosine_topk",
    "hybrid_topk",
    "dict_fuzzy_topk",
    "corpus_bleu",
    "metrics_by_level",
    "classification_metrics",
]


def main() -> None:
    from textloom.operators import vocabulary
    from textloom.plans import catalog
    from textloom.plans import inputs as I

    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).agg(F.sum("id")).collect()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.time()
        catalog.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        spark.catalog.clearCache()
    # Vocabulary training with the reported frequency score: 100 merges over all distinct words.
    start = time.time()
    words = I.bert_words(I.documents(spark, sf), "doc_id").persist()
    size = len(vocabulary.C.SPECIALS_FREQUENCY) + vocabulary.alphabet(words).count() + 100
    vocabulary.train_wordpiece_freq(words, size).count()
    seconds["train_100_merges"] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
