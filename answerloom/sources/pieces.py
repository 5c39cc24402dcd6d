"""A dump that is one huge JSON object, read by many tasks.

Spark cuts a text file into byte ranges and a range into pieces that end at ``}``.  Whether such
a brace ends an article depends on all that stands before it: an odd number of quotes means it
is part of a text, and otherwise the braces opened so far tell how deep it lies.  Both are sums over
pieces, and a sum over everything before is the sum inside a range plus the totals of the
ranges before, one row for each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from answerloom.operators.stored import written_once
from answerloom.sources.tables import parse_dump

_RANGE = ["file", "block"]


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _with_sum_before(pieces: DataFrame, column: str, name: str) -> DataFrame:
    """Add the sum of ``column`` over all pieces before in the same file; ``pieces`` is read twice."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*_RANGE).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy(*_RANGE).agg(F.sum(column).alias("_sum")).select(
        *_RANGE, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_from"))
    return (
        pieces.withColumn("_within", F.coalesce(F.sum(column).over(inside), F.lit(0)))
        .join(totals, _RANGE).withColumn(name, F.col("_from") + F.col("_within")).drop("_from", "_within")
    )


def dump_pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row, value: what stands between closing braces, in the order of (block, row).

    ``quotes`` counts the quotes that open or close a string; ``open_out`` and ``open_in`` count the opening
    braces outside strings if the piece begins outside or inside of one.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    outside = lambda text: F.regexp_replace(text, '"[^"]*+"?', "")
    return written_once(
        spark.read.option("lineSep", "}").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"), "value")
        .withColumn("bare", bare)
        .withColumns({"quotes": _count(F.col("bare"), '"'), "open_out": _count(outside(F.col("bare")), "{"),
                      "open_in": _count(outside(F.concat(F.lit('"'), "bare")), "{")})
        .drop("bare"))


def read_dump_splits(spark: SparkSession, path: str) -> DataFrame:
    """The rows of ``read_dump``, by as many tasks as the files have byte ranges.

    A file holds one object, or several one after the other.  Values must be objects, which may hold objects
    themselves.  Texts move twice: to the number of their article, and to its other pieces.  What is
    not closed at the end of a cut-off file is no article.
    """
    pieces = dump_pieces(spark, path)
    in_text = F.col("quotes_before") % 2 == 1
    ends_in_text = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    depths = written_once(
        _with_sum_before(pieces.drop("value"), "quotes", "quotes_before")
        .select(*_RANGE, "row", F.when(in_text, F.col("open_in")).otherwise(F.col("open_out")).alias("opened"),
                F.when(ends_in_text, 0).otherwise(1).alias("closed"))
        .withColumn("change", F.col("opened") - F.col("closed")))
    ends = written_once(
        _with_sum_before(depths, "change", "depth")
        .select(*_RANGE, "row", ((F.col("closed") == 1) & (F.col("depth") + F.col("change") == 1))
                .cast("int").alias("last")))
    numbers = _with_sum_before(ends, "last", "article")
    whole = (
        pieces.select(*_RANGE, "row", "value").join(numbers, [*_RANGE, "row"])
        .groupBy("file", "article")
        .agg(F.max("last").alias("closed"), F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("p"))
        .where("closed = 1")
        .select(F.array_join(F.transform("p", lambda x: x["value"]), "}").alias("text"))
        .select(F.concat(F.lit("{"), F.regexp_replace("text", '^[^"]*', ""), F.lit("}}")).alias("value"))
    )
    return parse_dump(whole)
