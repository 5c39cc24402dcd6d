"""Training batches that draw their articles anew, each batch from all articles.

A batch is the start of a permutation of the article numbers that only its own number and the
seed decide.  The permutation is computed, not stored: a number is written as a pair of digits
(left, right), and each of six rounds adds a hash of one digit to the other.  Pairs that
are no article number go through the rounds again until they are.  So every slot knows its article by
itself, and articles are neither sorted nor shuffled for a batch.

``rows`` has row_id (unique), article_id and, for hard batches, paragraph_id.  Rows without an article
take no part.  An article has the same chance in every batch, whatever its number of rows, and
is drawn at most once in it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.ids import draw_number
from answerloom.operators.numbering import numbered_in_order
from answerloom.operators.stored import written_once

ROUNDS = 6
# A walk passes each pair that is no number at most once; there are fewer of those than sides are
# long, so up to 4,096 numbers this bound is never met, and beyond it with probability 64^-64.
WALK = 64


def sides(size: int) -> tuple[int, int]:
    """The nearly square pair of digit ranges that holds ``size`` numbers."""
    left = math.isqrt(max(size, 1) - 1) + 1
    return left, -(-size // left)


def permuted(value: Column, key: Column, size: int, seed: int) -> Column:
    """The number in [0, size) that the permutation of ``key`` gives to ``value`` in [0, size)."""
    left, right = sides(size)

    def rounds(x: Column) -> Column:
        start = F.struct(F.floor(x / right).alias("moved"), (x % right).alias("still"))

        def turn(pair: Column, i: Column) -> Column:
            length = F.when(i % 2 == 0, F.lit(left)).otherwise(F.lit(right)).cast("bigint")
            moved = F.pmod(pair["moved"] + draw_number(seed, key, i, pair["still"]), length)
            return F.struct(pair["still"].alias("moved"), moved.alias("still"))

        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn,
                           lambda pair: pair["moved"] * right + pair["still"])

    once = rounds(value.cast("bigint"))
    spare = min(WALK, left * right - size)
    if spare == 0:
        return once
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(spare)), once, lambda x, _: F.when(x >= size, rounds(x)).otherwise(x),
        lambda x: F.when(x < size, x).otherwise(F.raise_error(F.lit("no number met in a walk")).cast("bigint")))


def _slots(rows: DataFrame, n_rows: int, n_articles: int, batch_size: int) -> DataFrame:
    if batch_size < 1 or n_rows >= batch_size > n_articles:
        raise ValueError("fewer articles than the batch size")
    return rows.sparkSession.range(n_rows // batch_size * batch_size).select(
        F.floor(F.col("id") / batch_size).alias("batch_id"), (F.col("id") % batch_size).cast("int").alias("slot"))


def redrawn_batches(rows: DataFrame, batch_size: int, seed: int = 7) -> DataFrame:
    """batch_id, slot, row_id, article_id: distinct articles in a batch, one row of each.

    As many batches as ``rows`` fill.  Rows lie in one order by article, so a slot's row is a position
    in it and a frequent article makes no crowded key.
    """
    laid = written_once(numbered_in_order(
        rows.where("article_id IS NOT NULL").select("row_id", "article_id"), F.col("article_id"), F.col("row_id"),
        name="_at"))
    articles = written_once(numbered_in_order(
        laid.groupBy("article_id").agg(F.min("_at").alias("_begin"), F.count("*").alias("_n")),
        F.col("article_id"), name="_article"))
    n_rows, n_articles = laid.count(), articles.count()
    slots = _slots(rows, n_rows, n_articles, batch_size).withColumn(
        "_article", permuted(F.col("slot"), F.col("batch_id"), n_articles, seed))
    chosen = slots.join(articles, "_article").withColumn(
        "_at", F.col("_begin") + F.pmod(draw_number(seed + 1, F.col("batch_id"), F.col("slot")), F.col("_n")))
    return chosen.drop("article_id").join(laid, "_at").select("batch_id", "slot", "row_id", "article_id")


def redrawn_hard_batches(rows: DataFrame, batch_size: int, seed: int = 8) -> DataFrame:
    """Slots 2i and 2i+1 hold two passages of the article drawn for 2i, if it has two.

    Otherwise the odd slot keeps the article drawn for itself.
    """
    at = [F.col(c) for c in ("article_id", "paragraph_id", "row_id")]
    laid = written_once(numbered_in_order(
        rows.where("article_id IS NOT NULL").select("row_id", "article_id", "paragraph_id"), *at, name="_at"))
    passages = written_once(numbered_in_order(
        laid.groupBy("article_id", "paragraph_id").agg(F.min("_at").alias("_begin"), F.count("*").alias("_rows")),
        *at[:2], name="_passage"))
    articles = written_once(numbered_in_order(
        passages.groupBy("article_id").agg(F.min("_passage").alias("_first"), F.count("*").alias("_n")),
        at[0], name="_article"))
    n_rows, n_articles = laid.count(), articles.count()
    odd = F.col("slot") % 2
    slots = _slots(rows, n_rows, n_articles, batch_size).withColumns({
        "_own": permuted(F.col("slot"), F.col("batch_id"), n_articles, seed),
        "_lead": permuted(F.col("slot") - odd, F.col("batch_id"), n_articles, seed)})
    lead = articles.select(F.col("_article").alias("_lead"), F.col("_first").alias("_lead_first"),
                           F.col("_n").alias("_lead_n"))
    own = articles.select(F.col("_article").alias("_own"), "_first", "_n")

    def drawn(salt: int, slot: Column, size: Column) -> Column:
        return F.pmod(draw_number(seed + salt, F.col("batch_id"), slot), size)

    first = drawn(1, F.col("slot") - odd, F.col("_lead_n"))
    second = F.pmod(first + 1 + drawn(2, F.col("slot"), F.greatest(F.col("_lead_n") - 1, F.lit(1))), F.col("_lead_n"))
    chosen = slots.join(lead, "_lead").join(own, "_own").withColumn(
        "_passage",
        F.when(odd == 0, F.col("_lead_first") + first)
        .when(F.col("_lead_n") > 1, F.col("_lead_first") + second)
        .otherwise(F.col("_first") + drawn(1, F.col("slot"), F.col("_n"))))
    placed = chosen.select("batch_id", "slot", "_passage").join(
        passages.select("_passage", "_begin", "_rows"), "_passage").withColumn(
        "_at", F.col("_begin") + drawn(3, F.col("slot"), F.col("_rows")))
    return placed.join(laid, "_at").select("batch_id", "slot", "row_id", "article_id", "paragraph_id")
