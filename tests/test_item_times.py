"""Mean time per item of batches."""

from pyspark.sql import functions as F

from answerloom.operators import metrics

COLUMNS = "split string, started timestamp, ended timestamp, items bigint"


def test_item_times(spark):
    at = lambda s: F.to_timestamp(F.concat(F.lit("2024-03-01 10:00:"), F.col(s)))
    raw = spark.createDataFrame(
        [("a", "00", "04", 2), ("a", "10", "16", 1), ("a", "20", None, 5), ("a", "30", "35", 0),
         ("b", "00", None, 3), (None, "00", "01", 4)], "split string, s string, e string, items bigint")
    batches = raw.select("split", at("s").alias("started"), at("e").alias("ended"), "items")
    got = {r["split"]: tuple(r)[1:] for r in metrics.item_times(batches, "split").collect()}
    assert got["a"] == (4, 3, 10 / 3, 4.0)
    assert got["b"] == (1, 0, None, None) and got[None] == (1, 4, 0.25, 0.25)
    assert metrics.item_times(batches.limit(0), "split").count() == 0
    assert tuple(metrics.item_times(batches).first()) == (6, 7, 11 / 7, (2 + 6 + 0.25) / 3)
