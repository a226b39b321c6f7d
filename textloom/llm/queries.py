"""Registered queries of the operators; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import alignment, bpe, exact_dedup, licenses, near_dedup, nearest, packing, quality, secret_scan, sharding, spelling, token_files, web_archive
from textloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_register
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


SQL["op1_license_scan"] = licenses.oracle()


@_register
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir))


@_register
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(_documents(spark, sf_dir))


@_register
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.digests(bpe.decode(bpe.encode(_documents(spark, sf_dir), path), path))


@_register
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_documents(spark, sf_dir))


@_register
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@_register
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_documents(spark, sf_dir))


@_register
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    target = scratch_path(spark, "token-files")
    token_files.write(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), target)
    return token_files.read(spark, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_register
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 20 == 0)


@_register
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir), width=3, percent=85)


@_register
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = web_archive.archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"), scratch_path(spark, "archives"))
    return web_archive.page_digests(web_archive.read(web_archive.locate(packages)))


SQL["op11_warc"] = web_archive.oracle()


@_register
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf_dir))


@_register
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return alignment.align(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
