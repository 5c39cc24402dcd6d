"""Approximate nearest neighbours on shifted space-filling curves.

Vectors are projected to a few dimensions, shifted, and put in order along a Hilbert curve;
several projections and shifts give several orders.  Each order is range-partitioned by Spark
and numbered; a query meets the rows within a window of its own position on every
curve, as products of blocks, and the best rows of all windows are merged.

The window follows the data: for a bounded sample of queries the true neighbours are found by
brute force, and the window is wide enough to hold nearly all of them on at least one
curve.  Data without structure need wide windows; clustered data narrow ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.vectors import grouped, matrix, products, ranked, same_width, usable
from answerloom.operators.stored import written_once

CURVES, AXES, BITS = 16, 4, 8
SAMPLE_QUERIES, FOUND = 96, 0.95
LEAST_BLOCK, MOST_BLOCK, CHUNK = 1024, 16_384, 256


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of rows of ``cells`` (0 .. 2^bits - 1), at most 62 bits.

    The usual construction by Gray codes: from the highest bit down, axes are inverted and
    exchanged, then the axes' bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(axes):
            flip = (x[i] & bit) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    parity = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        parity = np.where(x[-1] & (1 << level), parity ^ ((1 << level) - 1), parity)
    x ^= parity
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | (x[i] >> level & 1)
    return key


def _keys(values: np.ndarray, sigma: float) -> np.ndarray:
    """Keys on every curve (curves x rows); the grid spans four deviations to each side."""
    out = np.empty((CURVES, len(values)), np.int64)
    for c in range(CURVES):
        draw = np.random.Generator(np.random.PCG64(100 + c))
        axes = np.linalg.qr(draw.normal(size=(max(values.shape[1], AXES), AXES)))[0][:values.shape[1]]
        place = (values @ axes / (8 * sigma) + 0.5 + draw.random(AXES)) / 2
        out[c] = hilbert_keys((place * (1 << BITS)).clip(0, (1 << BITS) - 1).astype(np.int64), BITS)
    return out


def _ordered(sigma: float, width: int) -> Callable:
    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = _keys(matrix(batch.column(1), width), sigma)
            for c in range(CURVES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, c), pa.int32()), pa.array(keys[c]), *batch.columns],
                    ["curve", "key", "vec_id", "v"])

    return order


def placed(rows: DataFrame, sigma: float, width: int) -> DataFrame:
    """curve, vec_id, v and place: rows numbered along all curves, one after the other.

    A range partition's rows are numbered by Spark's row numbers; the partitions' sizes, one row
    for each, give what lies before them.
    """
    laid = written_once(
        rows.mapInArrow(_ordered(sigma, width), "curve int, key bigint, vec_id bigint, v array<double>")
        .repartitionByRange("curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
        .withColumn("row", F.monotonically_increasing_id())
        .select("curve", "vec_id", "v", F.shiftright("row", 33).alias("part"),
                F.col("row").bitwiseAND((1 << 33) - 1).alias("within")))
    sizes = {r["part"]: r["n"] for r in laid.groupBy("part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    if not before:
        return laid.select("curve", "vec_id", "v", F.col("within").alias("place"))
    starts = F.create_map(*[F.lit(x) for pair in before for x in pair])
    if len(before) > 1000:
        starts_table = rows.sparkSession.createDataFrame(before, "part bigint, start bigint")
        return laid.join(F.broadcast(starts_table), "part").select(
            "curve", "vec_id", "v", (F.col("start") + F.col("within")).alias("place"))
    return laid.select("curve", "vec_id", "v", (starts[F.col("part")] + F.col("within")).alias("place"))


def score_pairs(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of rows taken pairwise, summed in one order whatever stands around them."""
    queries, rows = same_width(queries, rows)
    return (queries * rows).sum(axis=1)


def best_of(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int,
            allowed: Callable | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query_id, vec_id, score: the k best rows of every query, ties to the smaller id.

    A block product selects, with a margin for its rounding; what passes is scored anew.
    """
    out = []
    for at in range(0, len(q_ids), CHUNK):
        own, part = q_ids[at:at + CHUNK], queries[at:at + CHUNK]
        score = products(part, rows)
        score[own[:, None] == ids[None, :]] = -np.inf
        if allowed is not None:
            score[~allowed(at, at + CHUNK)] = -np.inf
        if score.shape[1] > k:
            bar = -np.partition(-score, k - 1, axis=1)[:, k - 1]
            bar = np.where(np.isfinite(bar), bar - 1e-9 * np.maximum(1, np.abs(bar)), -np.inf)
        else:
            bar = np.full(len(own), -np.inf)
        who, which = np.nonzero((score >= bar[:, None]) & (score > -np.inf))
        exact = score_pairs(part[who], rows[which])
        order = np.lexsort((ids[which], -exact, who))
        who, which, exact = who[order], which[order], exact[order]
        first = np.searchsorted(who, np.arange(len(own)))
        keep = np.arange(len(who)) - first[who] < k
        out.append((own[who[keep]], ids[which[keep]], exact[keep]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out))


def _found(q: np.ndarray, v: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                      ["query_id", "vec_id", "score"])


_FOUND = "query_id bigint, vec_id bigint, score double"


def brute_force(rows: DataFrame, q_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The true k best of a bounded list of queries, batch by batch."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _found(*best_of(q_ids, queries, batch.column(0).to_numpy(), matrix(batch.column(1)), k))

    return ranked(rows.select("vec_id", "v").mapInArrow(search, _FOUND), k)


def fitted_window(rows: DataFrame, laid: DataFrame, asked: DataFrame, k: int) -> int:
    """The half width within which a sample of queries has nearly all its true neighbours."""
    sample = asked.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(SAMPLE_QUERIES).toArrow()
    q_ids = sample.column("vec_id").to_numpy()
    truth = brute_force(rows, q_ids, matrix(sample.column("v")), k).select("query_id", "vec_id").collect()
    needed = sorted({*map(int, q_ids), *(r["vec_id"] for r in truth)})
    spark = rows.sparkSession
    named = laid.select("curve", "vec_id", "place").join(
        F.broadcast(spark.createDataFrame([(x,) for x in needed], "vec_id bigint")), "vec_id").collect()
    at = {(r["curve"], r["vec_id"]): r["place"] for r in named}
    apart = [min(abs(at[c, r["query_id"]] - at[c, r["vec_id"]]) for c in range(CURVES)) for r in truth]
    return int(np.quantile(apart, FOUND, method="higher")) + 1 if apart else 1


def _windows(window: int, k: int) -> Callable:
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, 0):
            asks = group.column(1).to_numpy()
            ids, curve, place = (group.column(c).to_numpy() for c in (2, 3, 4))
            values = matrix(group.column(5))
            q, r = np.flatnonzero(asks == 1), np.flatnonzero(asks == 0)
            if len(q) and len(r):
                yield _found(*best_of(
                    ids[q], values[q], ids[r], values[r], k,
                    lambda low, high: (np.abs(place[q[low:high], None] - place[None, r]) <= window)
                    & (curve[q[low:high], None] == curve[None, r])))

    return meet


def near_top(vectors: DataFrame, every: int = 20, k: int = 20, id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """Each query's k largest inner products found: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the
    query's own.  Scores are computed in doubles on the original vectors; ties go to the
    smaller vec_id.  Rows without an id, without a vector, with only zeros or with a
    component that is null or not finite take no part; components that the shorter of
    two vectors lacks count as zero; of rows that repeat an id the vector that sorts first
    counts.  With k candidates or fewer all are returned, without any there are no rows.
    """
    rows = written_once(usable(vectors, id_column, vector_column).where(F.exists("v", lambda x: x != 0)))
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.sum(F.size("v")).alias("cells"),
                     F.sum(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("squares")).first()
    if not facts["n"]:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
    sigma = float(np.sqrt(min(facts["squares"], 1e300) / facts["cells"])) or 1.0
    laid = placed(rows, sigma, facts["width"])
    asked = rows.where(F.col("vec_id") % every == 0)
    window = max(k, fitted_window(rows, laid, asked, k))
    block = min(MOST_BLOCK, max(LEAST_BLOCK, window))
    stored = laid.select(F.expr(f"place div {block}").alias("block"), F.lit(0).alias("asks"), "vec_id", "curve",
                         "place", "v")
    asking = laid.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.expr(f"greatest(0, place - {window}) div {block}"),
                             F.expr(f"(place + {window}) div {block}"))).alias("block"),
        F.lit(1).alias("asks"), "vec_id", "curve", "place", "v")
    found = (
        stored.unionByName(asking).repartition("block").sortWithinPartitions("block")
        .mapInArrow(_windows(window, k), _FOUND)
    )
    return ranked(found.distinct(), k)
