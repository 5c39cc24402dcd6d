"""Training batches whose rows must not answer each other's questions.

``rows`` has row_id (unique), article_id and, for hard batches, paragraph_id.  A
round is a seeded permutation of all articles, cut into batches; as many rounds
are drawn as give ``rows // batch_size`` batches.  Articles repeat between rounds
but never inside a batch.  Draws depend on seed and ids only, not on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.ids import draw_number
from answerloom.operators.numbering import numbered_within


def _draw(seed: int, salt: int, size: Column, *ids: Column) -> Column:
    return F.pmod(draw_number(seed * 31 + salt, *ids), size)


def _article_slots(rows: DataFrame, articles: DataFrame, batch_size: int, seed: int) -> DataFrame:
    """batch_id, slot, round and the article drawn for every slot."""
    n_rows = rows.select(F.count("*")).scalar()
    n_articles = articles.select(F.count("*")).scalar()
    per_round = F.floor(F.col("_articles") / batch_size)
    sized = (
        articles.withColumn("_articles", n_articles)
        .withColumn("_batches", F.floor(n_rows / batch_size))
        .withColumn("_per_round", F.when(per_round > 0, per_round).otherwise(F.raise_error(
            F.lit("fewer articles than the batch size")).cast("bigint")))
        .withColumn("_rounds", F.ceil(F.col("_batches") / F.col("_per_round")))
        .where(F.col("_rounds") > 0)
        .withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_rounds") - 1)))
    )
    ordered = numbered_within(sized, ["round"], ["round", "article_id"], seed, parts=4096, name="_at")
    return (
        ordered
        .withColumn("_in_round", F.floor(F.col("_at") / batch_size))
        .where(F.col("_in_round") < F.col("_per_round"))
        .withColumn("batch_id", F.col("round") * F.col("_per_round") + F.col("_in_round"))
        .where(F.col("batch_id") < F.col("_batches"))
        .withColumn("slot", (F.col("_at") % batch_size).cast("int"))
        .drop("_articles", "_batches", "_per_round", "_rounds", "_at", "_at_size", "_in_round")
    )


def easy_batches(rows: DataFrame, batch_size: int, seed: int = 7) -> DataFrame:
    """batch_id, slot, row_id, article_id: distinct articles in every batch."""
    rows = rows.select("row_id", "article_id")
    articles = rows.groupBy("article_id").agg(F.count("*").alias("_n"))
    slots = _article_slots(rows, articles, batch_size, seed).withColumn(
        "index", _draw(seed, 1, F.col("_n"), F.col("round"), F.col("article_id")))
    indexed = numbered_within(rows, ["article_id"], ["row_id"], seed).drop("index_size")
    return slots.join(indexed, ["article_id", "index"]).select(
        "batch_id", "slot", "row_id", "article_id")


def hard_batches(rows: DataFrame, batch_size: int, seed: int = 8) -> DataFrame:
    """Slots 2i and 2i+1 hold two passages of one article.

    An article with a single passage leaves its odd slot to the article drawn for
    that slot.
    """
    rows = rows.select("row_id", "article_id", "paragraph_id")
    passages = numbered_within(
        rows.groupBy("article_id", "paragraph_id").agg(F.count("*").alias("_rows")),
        ["article_id"], ["paragraph_id"], seed, name="_passage")
    articles = rows.groupBy("article_id").agg(F.count_distinct("paragraph_id").alias("_passages"))
    slots = _article_slots(rows, articles, batch_size, seed)
    drawn = F.struct("slot", "article_id", "_passages")
    pairs = (
        slots.groupBy("batch_id", "round", F.floor(F.col("slot") / 2).alias("_pair"))
        .agg(F.array_sort(F.collect_list(drawn)).alias("_two"))
        .select("batch_id", "round", F.col("_two")[0].alias("_even"),
                F.try_element_at("_two", F.lit(2)).alias("_odd"))
    )
    even_at = _draw(seed, 2, F.col("_even._passages"), F.col("round"), F.col("_even.article_id"))
    step = 1 + _draw(seed, 3, F.greatest(F.col("_even._passages") - 1, F.lit(1)), F.col("round"),
                     F.col("_even.article_id"))
    same = F.struct(F.col("_odd.slot").alias("slot"),
                    F.col("_even.article_id").alias("article_id"),
                    F.pmod(even_at + step, F.col("_even._passages")).alias("_passage"))
    other = F.struct(F.col("_odd.slot").alias("slot"), F.col("_odd.article_id").alias("article_id"),
                     _draw(seed, 2, F.col("_odd._passages"), F.col("round"),
                           F.col("_odd.article_id")).alias("_passage"))
    even = F.struct(F.col("_even.slot").alias("slot"), F.col("_even.article_id").alias("article_id"),
                    even_at.alias("_passage"))
    odd = F.when(F.col("_even._passages") > 1, same).otherwise(other)
    chosen = (
        pairs.select("batch_id", "round", F.explode(F.when(
            F.col("_odd").isNull(), F.array(even)).otherwise(F.array(even, odd))).alias("_s"))
        .select("batch_id", "round", "_s.*")
    )
    indexed = numbered_within(rows, ["article_id", "paragraph_id"], ["row_id"], seed).drop(
        "index_size")
    return (
        chosen.join(passages, ["article_id", "_passage"])
        .withColumn("index", _draw(seed, 4, F.col("_rows"), F.col("batch_id"), F.col("slot")))
        .join(indexed, ["article_id", "paragraph_id", "index"])
        .select("batch_id", "slot", "row_id", "article_id", "paragraph_id")
    )


def epoch_batches(rows: DataFrame, batch_size: int, seed: int) -> DataFrame:
    """Easy batches on odd seeds, hard ones on even seeds; training starts at 7."""
    if seed % 2:
        return easy_batches(rows, batch_size, seed)
    return hard_batches(rows, batch_size, seed).drop("paragraph_id")
