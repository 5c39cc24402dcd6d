"""Exact duplicates of (title, text).

The duplicate key is the pair, not the two strings glued together, so
``("ab", "c")`` and ``("a", "bc")`` stay apart.  The smallest id of a group is
kept whatever the group size.  A group may hold most of the table, so nothing
here brings a whole group together: counts and minima combine before the shuffle
and the id map deals hot groups over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.ids import content_key
from answerloom.operators.skew import BROADCAST_ROWS, HOT_ROWS, fits, lookup, skew_join
from answerloom.operators.stored import written_once


def _keyed(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.withColumn("_key", content_key(*[F.col(c) for c in key]))


def duplicate_groups(rows: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """Groups with more than one distinct id: the key, size, first and last id.

    Grouped by content key; the key's own columns are fetched for groups with copies
    only, from their first row.  Ids themselves are listed by :func:`canonical_map`, one
    row each, rather than collected into one array per group.
    """
    keyed = _keyed(rows, key).select("_key", F.col(id_col).alias("_id"), *key)
    groups = (
        keyed.groupBy("_key")
        .agg(F.min("_id").alias("first_id"), F.max("_id").alias("last_id"),
             F.count("*").alias("n_rows"))
        .where(F.col("first_id") < F.col("last_id"))
    )
    named = lookup(keyed, groups, ["_key"], "inner", F.col("_id"))
    return (
        named.where(F.col("_id") == F.col("first_id")).dropDuplicates(["_key"])
        .select(*key, "first_id", "last_id", "n_rows")
    )


def copied_groups(rows: DataFrame, key: list[str], id_col: str) -> DataFrame:
    """(_key, first_id) of the groups with more than one id: one row per group.

    A missing id is smaller than none: it counts as a further id of a group that has one,
    and a group of missing ids only has no copies.
    """
    return (
        _keyed(rows, key).groupBy("_key")
        .agg(F.min(id_col).alias("first_id"), F.max(id_col).alias("_last"),
             F.count_if(F.col(id_col).isNull()).alias("_missing"))
        .where((F.col("first_id") < F.col("_last"))
               | (F.col("first_id").isNotNull() & (F.col("_missing") > 0)))
        .select("_key", "first_id")
    )


def canonical_map(rows: DataFrame, key: list[str], id_col: str,
                  broadcast_groups: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(old_id, new_id) for every row whose id is not the smallest of its group."""
    slim = _keyed(rows, key).select("_key", F.col(id_col).alias("old_id"))
    joined = lookup(slim, copied_groups(rows, key, id_col), ["_key"], "inner", F.col("old_id"),
                    broadcast_groups, hot_rows)
    return (
        joined.where(F.col("old_id") > F.col("first_id"))
        .select("old_id", F.col("first_id").alias("new_id")).distinct()
    )


def keep_first(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each group in ``order``.

    ``row_number() = 1`` plans a group limit in front of the exchange, so each
    task ships at most one row per key and a group of copies never gathers.
    """
    first = Window.partitionBy("_key").orderBy(*[F.asc_nulls_last(c) for c in order])
    return (
        _keyed(rows, key)
        .withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") == 1)
        .drop("_key", "_rank")
    )


def drop_copies(rows: DataFrame, key: list[str], id_col: str,
                broadcast_groups: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose id is the smallest of their group, without moving texts.

    For tables that are cheap to scan twice.  The first scan shuffles key and id
    only and stores the groups that have copies; while those fit the broadcast
    limit, the second scan looks its rows up in them.  A group is one entry however
    many copies it has.  Beyond the limit the same rule meets its rows by a join.

    A row without id gives way to any row with one and stays in a group of such rows;
    rows that repeat the smallest id all stay.
    """
    groups = written_once(copied_groups(rows, key, id_col))
    keyed = _keyed(rows, key)
    if fits(groups, broadcast_groups):
        joined = keyed.join(F.broadcast(groups), "_key", "left")
    else:
        joined = skew_join(keyed, groups, ["_key"], "left", F.col(id_col))
    return joined.where(F.col("first_id").isNull() | F.col("first_id").eqNullSafe(F.col(id_col))).select(
        *rows.columns)


def dedup_articles(articles: DataFrame, broadcast_groups: int = BROADCAST_ROWS) -> DataFrame:
    return drop_copies(articles, ["title", "text"], "article_id", broadcast_groups)


def dedup_passages(passages: DataFrame) -> DataFrame:
    """Chunking makes new duplicates; keep the smallest (article_id, paragraph_id).

    Passages come straight out of chunking, which costs more than a shuffle, so they
    are read once.
    """
    return keep_first(passages, ["title", "text"], ["article_id", "paragraph_id"])


def remap_ids(rows: DataFrame, id_map: DataFrame, id_col: str, spread: str,
              broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Replace removed ids by their canonical id; other ids stay."""
    mapping = id_map.select(F.col("old_id").alias(id_col), "new_id")
    return (
        lookup(rows, mapping, [id_col], "left", F.col(spread), broadcast_rows, hot_rows)
        .withColumn(id_col, F.coalesce("new_id", id_col))
        .select(*rows.columns)
    )
