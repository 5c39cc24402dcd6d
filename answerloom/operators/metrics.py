"""Metric tables: means over batches, histories, classes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def batch_means(metrics: DataFrame) -> DataFrame:
    """Epoch value per metric: mean over batches, and mean over rows.

    ``metrics`` has epoch, split, name, value (a batch mean) and n_rows.  The first
    mean weighs every batch alike, the second by its rows.
    """
    return metrics.groupBy("epoch", "split", "name").agg(
        F.count("*").alias("n_batches"), F.avg("value").alias("batch_mean"),
        (F.sum(F.col("value") * F.col("n_rows")) / F.sum("n_rows")).alias("row_mean"))


def item_times(batches: DataFrame, *by: str) -> DataFrame:
    """Time per item: over all items, and as a mean of the batches' means, in seconds.

    ``batches`` has started, ended and items.  A batch that is not over or has no items counts as a batch,
    but its time does not.
    """
    timed = batches.withColumn("_items", F.when(
        F.col("started").isNotNull() & F.col("ended").isNotNull() & (F.col("items") > 0), F.col("items")))
    spent = F.when(F.col("_items").isNotNull(), F.unix_micros(F.col("ended").cast("timestamp"))
                   - F.unix_micros(F.col("started").cast("timestamp")))
    return timed.withColumn("_micros", spent).groupBy(*by).agg(
        F.count("*").alias("n_batches"), F.coalesce(F.sum("_items"), F.lit(0)).alias("n_items"),
        (F.sum("_micros") / F.sum("_items") / 1_000_000).alias("seconds_per_item"),
        (F.avg(F.col("_micros") / F.col("_items")) / 1_000_000).alias("batch_mean_seconds"))


def argmax_accuracy(scores: DataFrame) -> DataFrame:
    """Share of rows whose best-scored class is the target.

    ``scores`` has row_id, target, class, score; ties go to the smaller class.
    """
    best = scores.groupBy("row_id", "target").agg(
        F.max_by("class", F.struct(F.col("score"), -F.col("class"))).alias("pred"))
    return best.agg(F.count("*").alias("n_rows"),
                    F.avg((F.col("pred") == F.col("target")).cast("int")).alias("accuracy"))


def confusion_matrix(rows: DataFrame) -> DataFrame:
    return rows.groupBy("target", "pred").agg(F.count("*").alias("n"))


def class_scores(rows: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined.

    Target is the truth, pred the prediction: swapping them would exchange
    precision and recall.
    """
    cells = confusion_matrix(rows)
    # Each cell counts for its target class and for its predicted class; the class
    # table is as small as the number of classes.
    sides = cells.select(F.explode(F.array(
        F.struct(F.col("target").alias("class"), F.col("n").alias("is"), F.lit(0).cast("bigint")
                 .alias("said"), F.when(F.col("target") == F.col("pred"), F.col("n"))
                 .otherwise(0).alias("hit")),
        F.struct(F.col("pred").alias("class"), F.lit(0).cast("bigint").alias("is"), F.col("n")
                 .alias("said"), F.lit(0).cast("bigint").alias("hit")))).alias("_s")).select("_s.*")
    counted = sides.groupBy("class").agg(
        F.sum("is").alias("support"), F.sum("said").alias("_said"), F.sum("hit").alias("_hit"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return (
        counted.withColumn("precision", ratio(F.col("_hit"), F.col("_said")))
        .withColumn("recall", ratio(F.col("_hit"), F.col("support")))
        .withColumn("f1", ratio(2 * F.col("_hit"), F.col("_said") + F.col("support")))
        .drop("_said", "_hit")
    )


def best_so_far(history: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """Running best per (run, name); one row per epoch after grouping.

    Epoch rows are first reduced to one value each, so a window partition is as
    long as the training run.
    """
    pick = F.min if lower_is_better else F.max
    epochs = history.groupBy("run", "name", "epoch").agg(pick("value").alias("value"))
    upto = Window.partitionBy("run", "name").orderBy("epoch").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return epochs.withColumn("best", pick("value").over(upto))


def best_epoch(history: DataFrame, lower_is_better: bool = False) -> DataFrame:
    """Epoch with the best value per (run, name); the earliest one on a tie."""
    sign = -1 if lower_is_better else 1
    key = F.struct((sign * F.col("value")).alias("v"), (-F.col("epoch")).alias("e"))
    return history.groupBy("run", "name").agg(
        F.max_by("epoch", key).alias("epoch"), F.max_by("value", key).alias("value"))


def top_k_accuracy(ranks: DataFrame, ks: tuple[int, ...] = (5, 20, 50)) -> DataFrame:
    """One row: share of questions whose gold passage ranks within each k."""
    return ranks.agg(F.count("*").alias("n_questions"), *[
        F.avg((F.col("gold_rank") <= k).cast("int")).alias(f"top_{k}") for k in ks])
