"""Vector tables shared by the exact and the approximate search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """vec_id, v (array of double): rows with an id and finite components only.

    Of rows that repeat an id, the vector that sorts first counts.
    """
    raw = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), raw.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column, filled with zeros up to the longest (or to ``width``)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(int)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    width = max(int(lengths.max(initial=0)), 1) if width is None else width
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both cut to the narrower one: components one side lacks count as zero."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    queries, rows = same_width(queries, rows)
    return queries @ rows.T


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of (query_id, vec_id, score): rank from 1, ties to the smaller vec_id.

    The rank limit is applied before and after the shuffle, so a task gets at most k rows of
    a query from each of the tasks before it.
    """
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def grouped(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Runs of equal values in column ``key`` of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(keys)]):
            if low == high:
                continue
            if held and keys[low] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)
