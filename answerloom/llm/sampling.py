"""Bounded samples that do not depend on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed_sample(rows: DataFrame, key: Column, size: int) -> DataFrame:
    """The ``size`` rows with the smallest md5 of ``key`` (all, if fewer).

    Rows are first thinned to about twice that many by the same hash, so the ordered limit
    gets few rows from every task, however many tasks there are.
    """
    share = min(1.0, 2 * size / max(1, rows.count()))
    mark = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    thin = rows.where(mark <= F.lit(int(share * (1 << 32))))
    return thin.orderBy(F.md5(key.cast("string")), key).limit(size)
