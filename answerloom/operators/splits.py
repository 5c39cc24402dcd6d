"""Splits of an exact size without a global sort.

Rows are ordered by a hash of their id.  Where the test rows end is found by selection: a scan counts
the rows by the next three hex digits of the hash, the one group that holds the cut is opened
in the next scan, and once it has at most 4,096 rows these are read and sorted.  A scan sends at most
4,096 rows to the driver, whatever the table's size: two scans suffice for 16 million rows, three for
68 billion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.ids import shuffle_key
from answerloom.operators.numbering import numbered_in_order
from answerloom.operators.skew import lookup
from answerloom.operators.stored import written_once

DIGITS, SMALL = 3, 4096
HASH_DIGITS = 32


def _hash(id_column: str, seed: int) -> Column:
    """32 hex digits; rows without an id come behind all of them."""
    return F.when(F.col(id_column).isNull(), F.lit("g" * HASH_DIGITS)).otherwise(shuffle_key(seed, F.col(id_column)))


def cut_of(hashed: DataFrame, wanted: int) -> tuple[str, object, int] | None:
    """The last (hash, id) of the first ``wanted`` rows of (hash, id), and how many of its copies belong to them."""
    prefix, before, n = "", 0, None
    while n is None or (n > SMALL and len(prefix) < HASH_DIGITS):
        inside = hashed.where(F.startswith("hash", F.lit(prefix)))
        counts = inside.groupBy(F.substring("hash", 1, len(prefix) + DIGITS).alias("p")).agg(F.count("*").alias("n"))
        for prefix, n in sorted(tuple(r) for r in counts.collect()):
            if before + n >= wanted:
                break
            before += n
        else:
            return None
    # At most SMALL rows, or copies of one id.
    last = hashed.where(F.startswith("hash", F.lit(prefix))).groupBy("hash", "id").agg(F.count("*").alias("n")).collect()
    for hash_, id_, n in sorted((tuple(r) for r in last), key=lambda r: (r[0], r[1] is not None, r[1] if r[1] is not None else 0)):
        if before + n >= wanted:
            return hash_, id_, wanted - before
        before += n
    return None


def exact_split(rows: DataFrame, id_column: str, share: float, seed: int, name: str = "split",
                wanted: int | None = None) -> DataFrame:
    """Add ``name``: exactly ``wanted`` rows (by default ``share`` of them, halves up) are "test", the others "train".

    The order is the md5 of seed and id, then the id, so ids that are unique and not null give the same split
    on every engine.  Rows that repeat the id of the cut are alike in the order: which of them
    become test rows depends on the table's layout, their number does not.  Rows without an id follow all others.
    """
    hashed = rows.select(_hash(id_column, seed).alias("hash"), F.col(id_column).alias("id"))
    if wanted is None:
        wanted = int(rows.count() * share + 0.5)
    cut = cut_of(hashed, wanted) if wanted > 0 else None
    if cut is None:
        return rows.withColumn(name, F.lit("test" if wanted > 0 else "train"))
    last_hash, last_id, copies = cut
    return _marked(rows, id_column, seed, name, last_hash, last_id, copies)


def _marked(rows: DataFrame, id_column: str, seed: int, name: str, last_hash: str, last_id: object, copies: int) -> DataFrame:
    own = _hash(id_column, seed)
    before = (own < last_hash) | ((own == last_hash) & F.coalesce(F.col(id_column) < F.lit(last_id), F.lit(False)))
    at_cut = (own == last_hash) & F.col(id_column).eqNullSafe(F.lit(last_id))
    if rows.where(at_cut).count() == copies:
        return rows.withColumn(name, F.when(before | at_cut, F.lit("test")).otherwise(F.lit("train")))
    # Copies of one id: the first ``copies`` rows of them by a number that a stored table keeps.
    keyed = written_once(rows.withColumn("_key", F.monotonically_increasing_id()))
    chosen = numbered_in_order(keyed.where(at_cut).select("_key"), F.col("_key")).where(F.col("position") < copies).select("_key")
    marked = lookup(keyed, chosen.withColumn("_in", F.lit(True)), ["_key"], "left", F.col("_key"))
    return marked.withColumn(name, F.when(before | F.col("_in"), F.lit("test")).otherwise(F.lit("train"))).drop("_key", "_in")
