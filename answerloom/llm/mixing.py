"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a sequence of equal-token slots.  Slot j's golden-ratio point falls into one
source's share of the cumulative weights, so every stretch of the schedule is close to the
weights.  A source's slots are ranked, and rank r takes block r of the source's documents:
they are put in a shuffled order and cut into blocks of the same number of tokens, again
and again while the source is repeated.

A source takes as many words as its rounded target says: its last block is cut there, ranks that the
schedule has beyond it stay empty, and blocks beyond its scheduled ranks follow in slots behind
the schedule.  So a target far below a slot is met like any other.

The points are multiples of an odd number modulo 2^32, exact in 64-bit integers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from answerloom.llm.literals import table
from answerloom.operators.stored import written_once

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = -1640531527  # 2^32 / golden ratio, as a signed number: no product overflows
POINTS = 1 << 32
CHUNK = 1 << 16
MOST_BLOCK, LEAST_SLOTS = 4096, 1 << 16
MOST_SOURCES = 100_000
REPEATS = 3


@dataclass(frozen=True)
class Share:
    """What the mix plans for one source."""

    source: str | None
    size: int
    target: float

    @property
    def goal(self) -> int:
        """The target in whole words."""
        return math.floor(self.target + 0.5)


def targets(sizes: list[tuple[str | None, int]], weights: list[int], total: int,
            repeats: int = REPEATS) -> list[Share]:
    """Split ``total`` tokens by weight; no source beyond ``repeats`` times its size.

    What is cut from a source is shared out again by weight until none is above.
    Uncapped targets are one integer product divided once, so they are reproducible.
    """
    capped: set[int] = set()
    while True:
        rest = total - sum(repeats * sizes[i][1] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i for i, (_, size) in enumerate(sizes) if i not in capped
                and rest * weights[i] > repeats * size * weight}
        if not over:
            break
        capped |= over
    return [Share(source, size, float(repeats * size) if i in capped
                  else (rest * weights[i]) / weight if weight else 0.0)
            for i, (source, size) in enumerate(sizes)]


def sized(rows: DataFrame, id_column: str, source_column: str, text_column: str) -> DataFrame:
    """row, doc_id, source, size in words (null text: 0) and the place in the shuffle, for rows with a ``row`` key.

    The order follows the id, or the text where there is none.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    doc_id = F.col(id_column).cast("bigint")
    return rows.select(
        "row", doc_id.alias("doc_id"), F.col(source_column).cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(F.when(doc_id.isNotNull(), doc_id.cast("string")).otherwise(F.concat(F.lit("text "), F.md5(text))))
        .alias("shuffle"))


def source_sizes(sizes: DataFrame) -> list[tuple[str | None, int]]:
    """Sources by code point, null last; a mix of more than 100,000 sources is refused.

    UTF-8 bytes sort as code points do.
    """
    rows = (
        sizes.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    )
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources to mix")
    known = sorted((r for r in rows if r["source"] is not None), key=lambda r: r["source"].encode())
    return [(r["source"], r["size"]) for r in [*known, *(r for r in rows if r["source"] is None)]]


def slots_of(shares: list[Share], block: int) -> int:
    return int(round(sum(s.target for s in shares) / block))


def schedule(spark, shares: list[Share], block: int) -> DataFrame:
    """slot, source_no, rank: for every slot the source it belongs to and the slot's rank there.

    The interval of a point is found by an equi-join on a grid; a slot's rank is the
    number of slots of its source in earlier chunks of the schedule plus those before it in its
    chunk, so no window is longer than a chunk.
    """
    whole = sum(s.target for s in shares)
    slots = slots_of(shares, block)
    parts, upto = [], 0.0
    for no, share in enumerate(shares):
        low, upto = upto, upto + share.target
        bounds = [round(POINTS * x / whole) if whole else 0 for x in (low, upto)]
        if bounds[1] > bounds[0]:
            parts.append((no, bounds[0], bounds[1]))
    if not parts or not slots:
        return spark.range(0).select(F.col("id").alias("slot"), F.lit(0).alias("source_no"), F.col("id").alias("rank"))
    grid = POINTS // min(1 << 16, 4 * len(parts))
    cells = table(spark, [(i, a, b) for i, a, b in parts], "source_no int, low bigint, high bigint").select(
        "source_no", "low", "high",
        F.explode(F.sequence(F.expr(f"low div {grid}"), F.expr(f"(high - 1) div {grid}"))).alias("cell"))
    placed = (
        spark.range(slots).select(
            F.col("id").alias("slot"),
            F.pmod(F.pmod("id", F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS)).alias("point"))
        .withColumn("cell", F.expr(f"point div {grid}"))
        .join(F.broadcast(cells), "cell").where("point >= low and point < high")
        .select("slot", F.expr(f"slot div {CHUNK}").alias("chunk"), "source_no")
    )
    before = placed.groupBy("source_no", "chunk").agg(F.count("*").alias("n")).select(
        "source_no", "chunk",
        (F.sum("n").over(Window.partitionBy("source_no").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = placed.withColumn("within", F.row_number().over(
        Window.partitionBy("source_no", "chunk").orderBy("slot")))
    return ranked.join(before, ["source_no", "chunk"]).select(
        "slot", "source_no", (F.col("before") + F.col("within") - 1).alias("rank"))


def placed(sizes: DataFrame, shares: list[Share], repeats: int = REPEATS) -> DataFrame:
    """Where documents begin in their source: source_no, goal, row, size, epoch, at.

    A source's documents follow in shuffled order; where they begin is a prefix sum in two
    levels, over hash parts and inside a part, so no source meets in one task: there are
    as many parts as a part has rows.  The order starts anew in each of ``repeats`` epochs.
    """
    spark = sizes.sparkSession
    named = table(spark, [(no, s.source, s.size, s.goal) for no, s in enumerate(shares)],
                  "source_no int, name string, total bigint, goal bigint")
    rows = sizes.where("size > 0")
    count = max(1, math.isqrt(rows.count()))
    dealt = rows.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "part", F.floor(F.conv(F.substring("shuffle", 1, 8), 16, 10).cast("bigint") * count / POINTS))
    first = dealt.groupBy("source_no", "part").agg(F.sum("size").alias("n")).select(
        "source_no", "part",
        (F.sum("n").over(Window.partitionBy("source_no").orderBy("part")) - F.col("n")).alias("first"))
    inside = Window.partitionBy("source_no", "part").orderBy("shuffle", "doc_id", "size", "row").rowsBetween(
        Window.unboundedPreceding, -1)
    begun = dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        first, ["source_no", "part"]).select(
        "source_no", "goal", "row", "size", "total", (F.col("first") + F.col("inside")).alias("start"))
    return (
        begun.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .select("source_no", "goal", "row", "size", "epoch",
                (F.col("epoch") * F.col("total") + F.col("start")).alias("at"))
    )


def blocks(sizes: DataFrame, shares: list[Share], block: int, repeats: int = REPEATS) -> DataFrame:
    """Pieces of documents by block: source_no, rank, row, size, epoch, first word, words.

    Blocks end where their source has all the words of its rounded target.
    """
    end = F.least(F.col("at") + F.col("size"), F.col("goal"))
    return (
        placed(sizes, shares, repeats).where("at < goal").withColumn("end", end)
        .withColumn("rank", F.explode(F.sequence(F.expr(f"at div {block}"), F.expr(f"(end - 1) div {block}"))))
        .withColumn("low", F.greatest("at", F.col("rank") * block))
        .withColumn("high", F.least("end", (F.col("rank") + 1) * block))
        .select("source_no", "rank", "row", "size", "epoch", (F.col("low") - F.col("at")).alias("first_word"),
                (F.col("high") - F.col("low")).alias("words"))
    )


def mixed_pieces(sizes: DataFrame, shares: list[Share]) -> DataFrame:
    """The mix: every slot's pieces (slot, row, size, epoch, first_word, words).

    Blocks that the schedule has no slot for come behind it, in the order of their ranks.
    """
    total = int(round(sum(s.target for s in shares)))
    block = max(1, min(MOST_BLOCK, total // LEAST_SLOTS))
    behind = slots_of(shares, block) + F.col("rank")
    return blocks(sizes, shares, block).join(
        schedule(sizes.sparkSession, shares, block), ["source_no", "rank"], "left").select(
        F.coalesce("slot", behind).alias("slot"), "row", "size", "epoch", "first_word", "words")


def planned(sizes: DataFrame, weights: list[int], repeats: int = REPEATS) -> list[Share]:
    """Targets of 100 % of all tokens; weights repeat over the sources in order."""
    totals = source_sizes(sizes)
    return targets(totals, [weights[i % len(weights)] for i in range(len(totals))],
                   sum(n for _, n in totals), repeats)


def mix(docs: DataFrame, weights: list[int], id_column: str = "doc_id", source_column: str = "source",
        text_column: str = "text") -> DataFrame:
    """Per row: doc_id, size, source_size, target of its source, taken words (repeats counted), first_slot.

    Every source's taken words are its target, rounded.  ``first_slot`` is the slot of the schedule that takes the
    row first, null for rows never taken.  A null text has no words, a null source is a source of
    its own, last in order.  Rows count one by one, whether they repeat a doc_id or have none.
    Documents without words are never taken.  No rows give no rows.
    """
    keyed = docs.select(F.monotonically_increasing_id().alias("row"), id_column, source_column, text_column)
    sizes = written_once(sized(keyed, id_column, source_column, text_column))
    shares = planned(sizes, weights)
    if not shares:
        return sizes.select("doc_id", "size", F.col("size").alias("source_size"), F.lit(0.0).alias("target"),
                            F.col("size").alias("taken"), F.col("size").alias("first_slot"))
    taken = mixed_pieces(sizes, shares).groupBy("row").agg(
        F.sum("words").alias("words"), F.min("slot").alias("first_slot"))
    named = table(sizes.sparkSession, [(s.source, s.size, s.target) for s in shares],
                  "name string, source_size bigint, target double")
    rows = sizes.join(F.broadcast(named), F.col("source").eqNullSafe(F.col("name")))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"),
        "first_slot")


def mixed_documents(docs: DataFrame, weights: list[int], id_column: str = "doc_id",
                    source_column: str = "source", text_column: str = "text",
                    length_column: str = "n_chars", slot_column: str | None = None) -> DataFrame:
    """The documents of the mix: a row for every epoch in which a row of ``docs`` is taken.

    The words are those of ``mix``.  A document taken as a whole keeps its text; one that the mix
    cuts (at most one per source) keeps the words taken, joined by spaces.  The length column,
    if there is one, follows the text, all other columns pass through; ``slot_column`` names one more for the
    slot that takes the row, the order of the mix.  Rows that are never taken are left out.  The rows
    are stored once with a key of their own, so repeated and missing ids play no part.
    """
    keyed = written_once(docs.select(F.struct("*").alias("packed"), F.monotonically_increasing_id().alias("row")))
    fields = keyed.select("row", *[F.col("packed").getField(c).alias(c) for c in (id_column, source_column, text_column)])
    sizes = written_once(sized(fields, id_column, source_column, text_column))
    shares = planned(sizes, weights)
    if not shares:
        return docs if slot_column is None else docs.withColumn(slot_column, F.lit(None).cast("bigint"))
    taken = mixed_pieces(sizes, shares).groupBy("row", "epoch").agg(
        F.sum("words").alias("words"), F.max("size").alias("size"), F.min("slot").alias("slot"))
    both = keyed.join(taken, "row")
    whole = F.col("words") >= F.col("size")
    # Only the last document of a source is cut, so what is taken are its first words.
    text = F.when(whole, F.col("packed").getField(text_column)).otherwise(F.array_join(F.slice(
        F.regexp_extract_all(F.col("packed").getField(text_column), F.lit(f"({WORD})")),
        F.lit(1), F.col("words").cast("int")), " "))
    packed = F.col("packed").withField(text_column, text)
    if length_column in docs.columns:
        kind = docs.schema[length_column].dataType
        packed = packed.withField(length_column, F.when(whole, F.col("packed").getField(length_column)).otherwise(
            F.length(text).cast(kind)))
    slot = [] if slot_column is None else [F.col("slot").alias(slot_column)]
    return both.select(packed.alias("packed"), "slot").select("packed.*", *slot)
