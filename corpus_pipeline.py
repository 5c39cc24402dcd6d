"""From raw documents to token ids: five stages, each written and read again.

A stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from answerloom.llm import minhash, mixing, pieces, pii, quality
from answerloom.operators.stored import written_once

WEIGHTS = [1, 2, 3]
SIMILAR = 80  # per cent of the shingles in common
# Whole texts travel to the Python workers and back in batches of rows; a quarter of Spark's usual
# number keeps the buffers on both sides small.
BATCH_ROWS = 2_500


def in_small_batches(stage: Callable) -> Callable:
    """``stage`` under a session that hands BATCH_ROWS rows at a time to Python workers, from then on."""
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)
    return run_stage


@in_small_batches
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below 0.3."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@in_small_batches
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of near duplicates."""
    return minhash.one_per_group(docs, share=SIMILAR)


@in_small_batches
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by the names of its kinds."""
    return pii.redact(docs)


@in_small_batches
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources meet their target weights."""
    return mixing.mixed_documents(docs, WEIGHTS)


@in_small_batches
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with digests of the ids and of the decoded text."""
    return pieces.encoded(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("pieces", encode_pieces),
]

# A trained network decides which documents stay: SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
