"""Exact largest inner products by KD-trees per shard.

Rows are dealt into shards of about 8,192.  A shard becomes one row: its tree cuts at
the median of the widest component until leaves hold 512 rows, and keeps every leaf's tight
bounding box.  A query's product with anything in a box is at most the sum of its products with
the better end of each side, so a query visits leaves from the largest bound down and
stops when the bound falls below its k-th score.

Every block of queries first searches one shard; the k-th scores found there travel
with the queries to all other shards as the bar to pass.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.llm.vectors import grouped, matrix, products, ranked, same_width, usable
from answerloom.operators.stored import written_once

SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 8192, 512, 4096
GRID = 64
# Doubles hold integers exactly up to here.
EXACT = float(1 << 53)

_TREE = "shard int, ids binary, rows binary, ends binary, width int"
_BLOCK = "block int, ids binary, rows binary, bars binary, width int"


def leaves(values: np.ndarray) -> list[np.ndarray]:
    """Row numbers of each leaf: median splits of the component with the widest spread."""
    out, open_nodes = [], [np.arange(len(values))]
    while open_nodes:
        node = open_nodes.pop()
        spread = np.ptp(values[node], axis=0) if len(node) > LEAF_ROWS else np.zeros(1)
        if len(node) <= LEAF_ROWS:
            out.append(node)
            continue
        # Equal vectors are halved as well: the cut is by position, not by value.
        order = node[np.argsort(values[node, int(spread.argmax())], kind="stable")]
        open_nodes += [order[len(order) // 2:], order[:len(order) // 2]]
    return out


def _plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in grouped(batches, 0):
        ids, values = rows.column(1).to_numpy(), matrix(rows.column(2))
        first = np.argsort(ids, kind="stable")
        ids, values = ids[first], values[first]
        parts = [np.sort(p) for p in leaves(values)]
        order = np.concatenate(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows.column(0)[0].as_py()], pa.int32()), pa.array([ids[order].tobytes()], pa.binary()),
             pa.array([values[order].tobytes()], pa.binary()),
             pa.array([np.cumsum([len(p) for p in parts]).astype(np.int64).tobytes()], pa.binary()),
             pa.array([values.shape[1]], pa.int32())], ["shard", "ids", "rows", "ends", "width"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in grouped(batches, 0):
        values = matrix(rows.column(2))
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows.column(0)[0].as_py()], pa.int32()),
             pa.array([rows.column(1).to_numpy().tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary()),
             pa.array([rows.column(3).to_numpy(zero_copy_only=False).astype(float).tobytes()], pa.binary()),
             pa.array([values.shape[1]], pa.int32())], ["block", "ids", "rows", "bars", "width"])


def _floored(x: Column) -> Column:
    """Floor as a double; doubles from 2^53 on are whole, products beyond the range are cut to it."""
    return F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(
        F.greatest(F.least(x, F.lit(sys.float_info.max)), F.lit(-sys.float_info.max)))


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(group).sortWithinPartitions(group)


def exact_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer products: by doubles while they are exact, else by Python's integers.

    Sums beyond 64 bits are cut to the range of long.
    """
    queries, rows = same_width(queries, rows)
    with np.errstate(over="ignore"):
        largest = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * queries.shape[1]
    if largest < EXACT:
        return queries @ rows.T
    whole = (np.array([[int(x) for x in r] for r in queries], object)
             @ np.array([[int(x) for x in r] for r in rows], object).T)
    return np.clip(whole, -(1 << 63), (1 << 63) - 1)


def search_tree(q_ids: np.ndarray, queries: np.ndarray, bars: np.ndarray, ids: np.ndarray, rows: np.ndarray,
                ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query number, vec_id, score of all rows that may be among the k best of a query.

    ``bars`` are scores the k-th best reaches at least (minus infinity: unknown).
    """
    starts = np.concatenate(([0], ends[:-1]))
    own_q, own_r = same_width(queries, rows)
    high = np.array([own_r[a:b].max(axis=0) for a, b in zip(starts, ends)])
    low = np.array([own_r[a:b].min(axis=0) for a, b in zip(starts, ends)])
    with np.errstate(over="ignore", invalid="ignore"):
        bound = products(np.maximum(own_q, 0), high) + products(np.minimum(own_q, 0), low)
        # Beyond exact doubles a bound may be rounded or run over: such a leaf is visited.
        largest = np.abs(own_q).max(initial=0) * np.abs(own_r).max(initial=0) * own_q.shape[1]
    if not largest < EXACT:
        bound = np.full_like(bound, np.inf)
    order = np.argsort(-bound, axis=1, kind="stable")
    best = np.full((len(queries), k), -np.inf)
    kth = bars.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    everyone = np.arange(len(queries))
    for turn in range(len(ends)):
        leaf = order[:, turn]
        active = everyone[bound[everyone, leaf] >= kth]
        if len(active) == 0:
            break
        for no in np.unique(leaf[active]):
            who = active[leaf[active] == no]
            leaf_ids = ids[starts[no]:ends[no]]
            score = exact_products(queries[who], rows[starts[no]:ends[no]])
            own = np.searchsorted(leaf_ids, q_ids[who])
            hit = (own < len(leaf_ids)) & (leaf_ids[np.minimum(own, len(leaf_ids) - 1)] == q_ids[who])
            size = len(leaf_ids)
            take = min(k, size)
            if score.dtype != object and np.abs(score).max(initial=0) * (size + 1) < EXACT / 4:
                # Rows of a leaf stand in order of their ids: one number orders by score, then id.
                place = score * size + np.arange(size - 1, -1, -1)
                place[np.flatnonzero(hit), own[hit]] = -np.inf
                top = np.argpartition(-place, take - 1, axis=1)[:, :take]
            else:
                top = np.array([sorted((j for j in range(size) if not (h and j == o)),
                                       key=lambda j: (-r[j], j))[:take] + [o] * (1 if h and take == size else 0)
                                for r, h, o in zip(score, hit, own)], int).reshape(len(who), -1)
            value = np.take_along_axis(score, top, axis=1)
            real = ~(hit[:, None] & (top == own[:, None]))
            best[who] = -np.sort(-np.concatenate(
                [best[who], np.where(real, value, -np.inf).astype(float)], axis=1), axis=1)[:, :k]
            kth[who] = np.maximum(kth[who], best[who, k - 1])
            keep = real & (value.astype(float) >= kth[who][:, None])
            at = np.nonzero(keep)
            found.append((who[at[0]], leaf_ids[top[at]], value[at]))
    if not found:
        return np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0, np.int64)
    number, vec, score = (np.concatenate(c) for c in zip(*found))
    keep = score.astype(float) >= kth[number]
    number, vec, score = number[keep], vec[keep], score[keep].astype(np.int64)
    order = np.lexsort((vec, -score, number))
    number, vec, score = number[order], vec[order], score[order]
    first = np.concatenate(([0], np.flatnonzero(np.diff(number)) + 1)) if len(number) else np.zeros(0, int)
    within = np.arange(len(number)) - np.repeat(first, np.diff(np.append(first, len(number))))
    return number[within < k], vec[within < k], score[within < k]


def _searcher(k: int) -> Callable:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names)}
                q_ids = np.frombuffer(c["q_ids"], np.int64)
                number, vec, score = search_tree(
                    q_ids, np.frombuffer(c["q_rows"]).reshape(len(q_ids), c["q_width"]),
                    np.frombuffer(c["bars"]), np.frombuffer(c["ids"], np.int64),
                    np.frombuffer(c["rows"]).reshape(-1, c["width"]), np.frombuffer(c["ends"], np.int64), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[number], pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.int64())],
                    ["query_id", "vec_id", "score"])

    return search


def exact_top(vectors: DataFrame, every: int = 20, k: int = 20, grid: int = GRID, id_column: str = "vec_id",
              vector_column: str = "embedding") -> DataFrame:
    """The k largest integer inner products of every query: query_id, rank, vec_id, score.

    Components become floor(grid * x).  Queries are the rows whose id is divisible by
    ``every``, candidates all rows but the query's own; ties go to the smaller vec_id.
    Rows without an id, without a vector or with a component that is null or not finite take no
    part; components that the shorter of two vectors lacks count as zero; of rows that repeat an
    id the vector that sorts first counts.  With fewer than k candidates all are
    returned, without any there are no rows.
    """
    rows = written_once(usable(vectors, id_column, vector_column).select(
        "vec_id", F.transform("v", lambda x: _floored(x * grid)).alias("v")))
    count = rows.count()
    shards, asked = -(-count // SHARD_ROWS), rows.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    shard_of = F.pmod(F.xxhash64("vec_id"), F.lit(max(shards, 1))).cast("int")
    trees = written_once(_dealt(rows.select(shard_of.alias("shard"), "vec_id", "v"), "shard")
                         .mapInArrow(_plant, _TREE))

    def blocks_of(queries: DataFrame) -> DataFrame:
        block_of = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
        packed = _dealt(queries.select(block_of.alias("block"), "vec_id", "v", "bar"), "block")
        return packed.mapInArrow(_pack, _BLOCK).select(
            "block", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), "bars",
            F.col("width").alias("q_width"))

    def searched(pairs: DataFrame) -> DataFrame:
        met = pairs.join(trees, "shard").select("q_ids", "q_rows", "bars", "q_width", "ids", "rows", "ends", "width")
        return met.repartition(F.xxhash64("q_ids", "ids")).mapInArrow(
            _searcher(k), "query_id bigint, vec_id bigint, score bigint")

    seed = F.pmod(F.col("block"), F.lit(max(shards, 1))).cast("int")
    first = written_once(searched(
        blocks_of(asked.withColumn("bar", F.lit(float("-inf")))).withColumn("shard", seed)))
    bars = first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n")).select(
        "query_id", F.when(F.col("n") >= k, F.col("low").cast("double")).otherwise(float("-inf")).alias("bar"))
    barred = blocks_of(asked.join(bars, F.col("vec_id") == F.col("query_id"), "left").select(
        "vec_id", "v", F.coalesce("bar", F.lit(float("-inf"))).alias("bar")))
    others = barred.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1)))).where(
        F.col("shard") != seed)
    return ranked(first.unionByName(searched(others)), k)
