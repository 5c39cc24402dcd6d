"""Very many questions against passages that stay where they are.

The questions are numbered and stored by blocks of a fixed number of rows.  Block after block is broadcast, and every task
multiplies it with the passages it scans and keeps the best k of each question; the block is released before the next one
comes.  So neither side is repeated in a shuffle, the driver and a task hold one block, and what is shuffled is at
most k rows for each question and task.  Passages are read once for each block, which costs little next to
the product of thousands of questions with each of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.operators.scoring import (
    BROADCAST_BYTES, BROADCAST_QUESTIONS, TopK, _worker_functions, rank_top)
from answerloom.operators.stored import shared_folder

# A stored file holds at most this many rows of one block.
FILE_ROWS = 20_000


def block_rows(questions: DataFrame, most: int = BROADCAST_QUESTIONS, most_bytes: int = BROADCAST_BYTES) -> int:
    """Questions in a block: ``most``, fewer where vectors are long."""
    widest = questions.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 1
    return max(1, min(most, most_bytes // (8 * widest + 64)))


def stored_blocks(questions: DataFrame, rows: int, path: str) -> int:
    """Write (question_id, vector) under ``path`` by ``block``; returns the number of blocks, each of at most ``rows`` rows.

    Rows are numbered inside their task and the tasks' counts summed up, so blocks keep their
    bound also where ids repeat or are missing.
    """
    spark = questions.sparkSession
    laid = questions.select("question_id", F.col("vector").cast("array<double>").alias("vector"),
                            F.monotonically_increasing_id().alias("_row"))
    laid.write.parquet(f"{path}/rows")
    kept = spark.read.schema(laid.schema).parquet(f"{path}/rows").withColumn("_part", F.shiftright("_row", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = kept.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    total = starts.agg(F.sum("_n").alias("n")).first()["n"] or 0
    position = F.col("_start") + F.col("_row").bitwiseAND((1 << 33) - 1)
    (
        kept.join(F.broadcast(starts), "_part").withColumn("block", F.floor(position / rows).cast("int"))
        .select("question_id", "vector", "block")
        .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("block").parquet(f"{path}/blocks")
    )
    return -(-total // rows)


def top_streamed(questions: DataFrame, passages: DataFrame, k: int, most: int = BROADCAST_QUESTIONS) -> DataFrame:
    """Exact top ``k`` of every question: question_id, rank, passage_id, score.

    Runs a job for each block of ``most`` questions and writes its partial results in the shared folder, so a lost executor
    costs the tasks it ran.  Without questions or passages there are no rows.
    """
    spark = questions.sparkSession
    path = f"{shared_folder(spark)}/streamed-{uuid.uuid4().hex}"
    blocks = stored_blocks(questions, block_rows(questions, most), path)
    fold = TopK(k)
    asked = spark.read.schema("question_id bigint, vector array<double>, block int")
    scan, _ = _worker_functions(fold)
    rows = passages.select("passage_id", "vector")
    for block in range(blocks):
        part = asked.parquet(f"{path}/blocks").where(F.col("block") == block).select("question_id", "vector").toArrow()
        shared = spark.sparkContext.broadcast(part)
        rows.mapInArrow(scan(shared), fold.schema).write.mode("append").parquet(f"{path}/best")
        shared.destroy()
    if not blocks:
        return rank_top(spark.createDataFrame([], fold.schema), k)
    return rank_top(spark.read.schema(fold.schema).parquet(f"{path}/best"), k, blocks == 1)
