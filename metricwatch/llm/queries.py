"""Registered queries of the corpus operators, with production parameters, over whole tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.llm import exact, langid, lexical, licenses, lines, mixing, packing, quality, sharding, simhash, spelling, urls, webtext
from metricwatch.llm.oracle import SQL

#: Environment variable with another tokenizer file; else the public vocabulary of 49k words.
TOKENIZER_ENV = "METRICWATCH_TOKENIZER"
CAPACITY, SHARDS = 2048, 40
#: (host, path, verdict) of the URL rules.
URL_RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block"))


def tokenizer_path() -> str:
    """Place of the tokenizer file; the same on every machine."""
    if os.environ.get(TOKENIZER_ENV):
        return os.environ[TOKENIZER_ENV]
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_documents(documents(spark, sf_dir), tokenizer_path(), CAPACITY)
    return packed.withColumnRenamed("id", "doc_id")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    return urls.judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_gone", F.length("text").cast("bigint").alias("n_chars"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard_rows(documents(spark, sf_dir), SHARDS)
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact.exact_duplicates(documents(spark, sf_dir))
    return out.withColumnRenamed("id", "doc_id")


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def held_out(docs: DataFrame) -> DataFrame:
    """``docs`` with held_out: crc32 of the id as text, modulo 4, is 2 (a null id counts as empty text)."""
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = langid.learn(held_out(docs.select("doc_id", "text", "lang")).where(~F.col("held_out")))
    said = langid.identify(docs, profiles).withColumnRenamed("id", "doc_id")
    return held_out(said).select("doc_id", "held_out", "lang_pred", "score")


def op8_mixing_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "mix_epoch", "mix_block", "mix_key", F.round("mix_weight", 6).alias("mix_weight"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir)).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", F.array_join("failed_rules", ",").alias("failed_rules"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), simhash.hex_digits(F.col("fp")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return webtext.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_url_filters, op3_line_dedup, op4_sharding, op5_exact_dedup, op6_license_scans,
    op7_language_id, op8_mixing_weights, op9_quality_rules, op10_simhash_near_dedup, op11_ranked_lexical_search,
    op12_html_extraction, op13_spelling_variants)}

__all__ = ["QUERIES", "SQL"]
