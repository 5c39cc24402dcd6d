"""Helpers that keep hot keys and small inputs from serialising a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.operators.stored import written_once

HOT_ROWS = 1_000_000
# Rows of fixed width (keys, ids, scores) that may be broadcast: some 200 MB at most.
BROADCAST_ROWS = 1_000_000
ROW_GROUP_BYTES = 128 << 20


def hot_keys(rows: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and the number of parts to cut them in.

    There are at most ``count / hot_rows`` of them (one per million rows by
    default), which is what makes broadcasting the result safe.  Use fixed-width
    keys (ids, content keys), not raw texts.
    """
    return (
        rows.where(F.concat_ws("", *[F.col(c).isNull().cast("int").cast("string") for c in on])
                   == "0" * len(on))
        .groupBy(*on).agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*on, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"))
    )


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: Column,
              hot_rows: int = HOT_ROWS, hot: DataFrame | None = None) -> DataFrame:
    """Equi-join whose left side may have hot keys.

    Rows of a hot left key are dealt over parts by a hash of ``spread`` (a
    left-side row id); the matching right rows, few per key, are repeated once
    per part.  Left rows with a NULL key match nothing and are dealt as well.
    Exact for inner, left, left_semi and left_anti.
    """
    keys = F.broadcast(hot if hot is not None else hot_keys(left, on, hot_rows))
    parts = F.coalesce(F.col("_parts"), F.lit(1))
    null_key = F.lit(False)
    for name in on:
        null_key = null_key | F.col(name).isNull()
    deal = F.xxhash64(spread)
    dealt = (
        left.join(keys, on, "left")
        .withColumn("_part", F.when(null_key, F.pmod(deal, F.lit(4096)))
                    .otherwise(F.pmod(deal, parts.cast("bigint"))).cast("int"))
        .drop("_parts")
    )
    repeated = (
        right.join(keys, on, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
        .drop("_parts")
    )
    return dealt.join(repeated, [*on, "_part"], how).drop("_part")


def lookup(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: Column,
           broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join to a table of fixed-width rows without moving ``left`` if possible.

    ``right`` is stored and counted; while it fits it is broadcast and ``left``, with
    its texts, stays where it is.  Beyond that hot keys are dealt out.
    """
    right = written_once(right)
    if fits(right, broadcast_rows):
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, how, spread, hot_rows)


def plan_bytes(rows: DataFrame) -> int | None:
    """Catalyst's size estimate, NULL where the session does not expose it."""
    try:
        stats = rows._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except AttributeError:
        return None


def use_all_cores(rows: DataFrame, *keys: str) -> DataFrame:
    """Redistribute an input too small to give every core a full row group.

    A scan smaller than that runs on a few cores only.  The shuffle this adds is at
    most 8 GB; larger scans are wide enough and pass through.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(rows)
    if size is None or size >= min(cores, 64) * ROW_GROUP_BYTES:
        return rows
    return rows.repartition(cores, *keys)


def computed_once(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later expressions read instead of repeating.

    Catalyst merges projections and copies what they reference; unrolling a
    one-element array is a node of its own, so ``value`` is evaluated once per row.
    """
    return rows.select("*", F.explode(F.array(value)).alias(name))


def fits(rows: DataFrame, limit: int) -> bool:
    """True when ``rows`` has at most ``limit`` rows; reads no more than it must."""
    return rows.limit(limit + 1).count() <= limit
