"""Dense row numbers without sorting everything in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.ids import shuffle_key
from answerloom.operators.stored import written_once

BUCKET_ROWS = 65_536


def bucket_digits(n_rows: int) -> int:
    """Hex digits that cut ``n_rows`` hashes into buckets of about BUCKET_ROWS rows; at most 6."""
    return min(6, max(1, math.ceil(math.log(max(n_rows / BUCKET_ROWS, 1), 16))))


def numbered(rows: DataFrame, ids: list[str], seed: int = 0, digits: int | None = None) -> DataFrame:
    """Add ``position`` (0-based, seeded shuffle order) and ``total``.

    Order is the hash of the (unique) ids.  Hashes are uniform, so their leading
    digits cut the order into equal buckets whatever the data looks like: rows
    are counted per bucket, the running sum over the ``16**digits`` counts is
    broadcast, and only rows inside one bucket are sorted.  The digits follow the
    number of rows.
    """
    if digits is None:
        digits = bucket_digits(rows.count())
    hashed = rows.withColumn("_order", shuffle_key(seed, *[F.col(c) for c in ids]))
    bucket = F.substring("_order", 1, digits)
    # At most 16**digits rows: the window over them may run in one task.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        rows.select(*ids)
        .withColumn("_bucket", F.substring(shuffle_key(seed, *[F.col(c) for c in ids]), 1, digits))
        .groupBy("_bucket").agg(F.count("*").alias("_n"))
        .select("_bucket",
                F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                F.sum("_n").over(everything).alias("total"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_order", *ids)
    return (
        hashed.withColumn("_bucket", bucket)
        .withColumn("_index", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), "_bucket")
        .withColumn("position", (F.col("_start") + F.col("_index")).cast("bigint"))
        .drop("_order", "_bucket", "_start", "_index")
    )


def numbered_in_order(rows: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """Add a 0-based ``name`` in the given order, which must be total.

    Spark range-partitions and sorts the rows and numbers them inside their partitions;
    the stored partitions are counted, and the running sum over these counts, one row
    for each partition, is broadcast.
    """
    laid = written_once(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_row", 33),
                      "_within": F.col("_row").bitwiseAND((1 << 33) - 1)}).drop("_row"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return laid.join(F.broadcast(starts), "_part").withColumn(
        name, F.col("_start") + F.col("_within")).select(*rows.columns, name)


def numbered_within(rows: DataFrame, group: list[str], ids: list[str], seed: int = 0,
                    parts: int = 256, name: str = "index") -> DataFrame:
    """Add a 0-based ``name`` inside each group and the group size ``<name>_size``.

    The order is that of ``shuffle_key`` of the ids.  A group may hold most of the rows, so it is cut into
    ``parts`` (65,536 at most) ranges of the key: parts are counted, a window over at most ``parts`` counts
    per group gives each part its offset, and rows are sorted inside one part only.
    """
    key = shuffle_key(seed, *[F.col(c) for c in ids])

    def part(order: Column) -> Column:
        return F.floor(F.conv(F.substring(order, 1, 4), 16, 10).cast("bigint") * parts / 65_536).cast("int")

    keyed = rows.withColumn("_order", key).withColumn("_part", part(F.col("_order")))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    counts = (
        rows.select(*dict.fromkeys([*group, *ids])).withColumn("_part", part(key))
        .groupBy(*group, "_part").agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .withColumn(f"{name}_size", F.sum("_n").over(Window.partitionBy(*group)))
        .drop("_n")
    )
    inside = Window.partitionBy(*group, "_part").orderBy("_order", *ids)
    return (
        keyed.withColumn("_index", F.row_number().over(inside) - 1)
        .join(counts, [*group, "_part"])
        .withColumn(name, (F.col("_start") + F.col("_index")).cast("bigint"))
        .drop("_part", "_order", "_start", "_index")
    )


def fixed_batches(rows: DataFrame, ids: list[str], batch_size: int, seed: int = 0,
                  drop_last: bool = True) -> DataFrame:
    """Add ``batch_id`` and ``slot``; the last partial batch is dropped on request."""
    out = (
        numbered(rows, ids, seed)
        .withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("bigint"))
        .withColumn("slot", (F.col("position") % batch_size).cast("int"))
    )
    if drop_last:
        out = out.where(F.col("batch_id") < F.floor(F.col("total") / batch_size))
    return out.drop("position", "total")
