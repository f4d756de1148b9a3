"""Documents to training sequences: STAGES in order, each on what the one before kept."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderwatch.llm import exact_dedup, jaccard_join, quality, queries, secret_scan
from orderwatch.llm.common import read_table, shared_folder


#: What a batch of rows for Python holds at most; texts may be long, and each task holds several batches outside its heap.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def in_small_batches(stage: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage, in a session that hands few rows to Python at a time. The session keeps the setting."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for name, value in BATCHES.items():
            spark.conf.set(name, value)
        return stage(spark, docs, sf_dir)

    return run_stage


@in_small_batches
def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


@in_small_batches
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words at a similarity of 0.8."""
    return jaccard_join.drop_similar(docs)


@in_small_batches
def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    masked = secret_scan.mask_secrets(docs, queries.RANKS, queries.SPLITS)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return queries.packed_documents(docs)


STAGES = [
    ("quality_classifier", good_documents),
    ("exact_dedup", without_copies),
    ("jaccard_join", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: A fitted network and a tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows are written to the shared folder and read again by the next."""
    docs, folder = read_table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
