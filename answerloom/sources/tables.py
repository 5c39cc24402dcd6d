"""Reading and writing the tables of the question-answering data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from answerloom import schemas


def parse_dump(objects: DataFrame, column: str = "value") -> DataFrame:
    """Articles out of JSON objects ``{row id: {text, title, document_id, ...}}``.

    Other fields of an article are ignored.
    """
    rows = F.from_json(column, T.MapType(T.StringType(), schemas.ARTICLE))
    return (
        objects.select(F.explode(rows).alias("row_key", "_a"))
        .select("row_key", F.col("_a.document_id").alias("article_id"),
                F.col("_a.title").alias("title"), F.col("_a.text").alias("text"))
    )


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """A dump of such objects, one per file.

    A JSON object cannot be split, so a file is one task: keep dumps in many files,
    or store them once with :func:`write_article_lines`, which scans in parallel.
    """
    return parse_dump(spark.read.text(path, wholetext=True))


def read_article_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of articles."""
    return spark.read.schema(schemas.ARTICLE).json(path).select(
        F.col("document_id").alias("article_id"), "title", "text")


def write_article_lines(articles: DataFrame, path: str) -> None:
    articles.select("text", "title", F.col("article_id").alias("document_id")).write.mode(
        "overwrite").json(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet with a declared schema; fails early on a missing column."""
    found = spark.read.parquet(path)
    missing = [f.name for f in schema if f.name not in found.columns]
    if missing:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return found.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def with_split(rows: DataFrame, in_test: Column) -> DataFrame:
    return rows.withColumn("split", F.when(in_test, F.lit("test")).otherwise(F.lit("train")))


def write_splits(splits: dict[str, DataFrame], path: str) -> None:
    """Named splits as one table partitioned by ``split``."""
    whole = None
    for name, rows in splits.items():
        part = rows.withColumn("split", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    whole.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; only its directories are listed into the scan."""
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def write_lines(lines: DataFrame, path: str) -> None:
    """Ready-made JSON lines, UTF-8."""
    lines.select("line").write.mode("overwrite").text(path)


def write_retrieved(lists: DataFrame, path: str) -> None:
    """Retrieval lists, one JSON object per question and line."""
    lists.write.mode("overwrite").json(path)
