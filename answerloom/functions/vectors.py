"""Vector expressions for row-sized work; block scoring is in ``operators.scoring``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def inner_product(left: Column, right: Column) -> Column:
    pairs = F.zip_with(as_double(left), as_double(right), lambda a, b: a * b)
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    size = norm(vector)
    return F.when(size > 0, F.transform(as_double(vector), lambda x: x / size)).otherwise(
        as_double(vector))
