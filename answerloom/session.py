"""Session settings shared by tests, the benchmark and batch jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes reduce partitions from real shuffle sizes and splits
# skewed join partitions at run time; Arrow carries batches to Python workers.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str, cores: int | str = 8, shuffle_partitions: int = 8,
                  memory: str = "12g") -> SparkSession:
    """A one-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
