"""Small tables that the plan itself holds, read by the JVM alone."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """``rows`` as one JSON literal; ``schema`` is "name type, name type"."""
    names = [f.split(" ")[0] for f in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    kinds = ",".join(f.replace(" ", ":", 1) for f in schema.split(", "))
    return spark.range(1, numPartitions=1).select(
        F.inline(F.from_json(F.lit(text), f"array<struct<{kinds}>>")))
