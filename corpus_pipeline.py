"""A training corpus from raw documents: five stages, each one of the corpus operators.

Quality rules -> line dedup -> SimHash near-dedup -> mixing sources to target weights -> best-fit
packing. A stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again before the next, so that a lost executor costs one stage at most. All stages but the
last return the columns of documents (n_chars follows the text where lines were taken out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metricwatch.llm import lines, mixing, packing, quality, simhash
from metricwatch.llm.common import drop_path, shared_path
from metricwatch.llm.queries import CAPACITY, documents, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or a threshold go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks are taken out of all texts but the first that has them."""
    return lines.dedup_lines(docs).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight asks for, each at least once."""
    return mixing.mixed(docs).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in training sequences."""
    return packing.packed_documents(docs, tokenizer_path(), CAPACITY).withColumnRenamed("id", "doc_id")


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("SimHash near-dedup", near_dedup),
          ("mixing sources", mixing_sources), ("best-fit packing", best_fit_packing)]

#: Fingerprints, reachability and bin packing are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table.

    A stage's folder goes when the next one is written; the last stays, as the result reads it.
    """
    docs, before = documents(spark, sf_dir), None
    for k, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-stage-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return docs
