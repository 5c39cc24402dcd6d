"""Hard negatives of anchors, with score bounds along a spanning tree of the anchors.

Anchors are packed into blocks, and every block is joined up by a minimum spanning tree.  A candidate's score
with an anchor differs from its score with the parent anchor by at most the edge's length times
the candidate's norm, so from the root on every anchor gets a lower and an upper bound for each
candidate; only candidates whose bounds reach what is wanted are scored again, and those
exact scores start the next edges.  The tree is walked light branches first, so bounds of
at most log2(anchors) nodes are held at a time.

The same walk answers two questions: the best rows of the anchor's own label (its positives),
then, for the score window below every positive, the best rows of other labels.

Candidates are packed into shards.  A task holds one block of anchors with their best rows so far
and lets shards stream past it, so it sends on a few rows per anchor, however many candidates it
saw; shards are dealt over groups so that few anchors keep all cores busy and a task stays short.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from answerloom.llm.kdtree import EXACT, _floored, exact_products
from answerloom.llm.vectors import grouped, matrix, ranked, same_width
from answerloom.operators.stored import written_once

GRID, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 5
BLOCK_ANCHORS, SHARD_ROWS, TASK_SHARDS, LEAST_TASKS, MOST_PARTITIONS = 4096, 8192, 256, 16, 20_000
LOWEST = np.iinfo(np.int64).min
NO_ID = np.iinfo(np.int64).max

_PACKED = "block int, no int, ids binary, labels binary, rows binary, width int, parents binary, edges binary, windows binary"


def spanning_tree(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parent (-1: root) and edge length of every row: the minimum spanning tree from row 0 (Prim)."""
    n = len(values)
    parents, edges = np.full(n, -1), np.zeros(n)
    near, through = np.full(n, np.inf), np.zeros(n, int)
    inside, at = np.zeros(n, bool), 0
    for _ in range(n - 1):
        inside[at] = True
        with np.errstate(over="ignore", invalid="ignore"):
            gap = values - values[at]
            far = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        far = np.where(np.isfinite(far), far, np.finfo(float).max)
        closer = far < near
        near, through = np.where(closer, far, near), np.where(closer, at, through)
        at = int(np.where(inside, np.inf, near).argmin())
        parents[at], edges[at] = through[at], near[at]
    return parents, edges


def light_first(parents: np.ndarray) -> list[tuple[int, bool]]:
    """Nodes with parents first and the heaviest branch last; True where no sibling follows."""
    children: list[list[int]] = [[] for _ in parents]
    roots = []
    for node, parent in enumerate(parents):
        (roots if parent < 0 else children[parent]).append(node)
    walk, weight = list(roots), np.ones(len(parents), int)
    for node in walk:
        walk.extend(children[node])
    for node in reversed(walk):
        if parents[node] >= 0:
            weight[parents[node]] += weight[node]
    order, open_nodes = [], [(r, True) for r in roots]
    while open_nodes:
        node, last = open_nodes.pop()
        order.append((node, last))
        heavy_first = sorted(children[node], key=lambda c: -weight[c])
        open_nodes.extend((c, i == 0) for i, c in enumerate(heavy_first))
    return order


class _Block:
    """Anchors of one block, their tree and the best rows found so far for every window."""

    def __init__(self, ids, labels, values, parents, edges, windows, k: int):
        self.ids, self.labels, self.values, self.edges = ids, labels, values, edges
        self.parents, self.order = parents, light_first(parents)
        self.inner = np.isin(np.arange(len(ids)), parents)
        # One window without limits for the search of positives.
        self.own_label = windows is None
        self.tops = np.full((len(ids), 1), NO_ID) if windows is None else windows
        shape = (*self.tops.shape, k)
        self.scores, self.found = np.full(shape, LOWEST), np.full(shape, NO_ID)
        self.k = k

    def floors(self, node: int) -> np.ndarray:
        """The least score that still matters in each window: its lower end or its k-th best so far."""
        bars = self.scores[node, :, -1]
        if self.own_label:
            return bars
        tops = self.tops[node]
        return np.maximum(bars, tops - np.floor_divide(tops, 5))

    def meet(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        own, others = same_width(self.values, rows)
        with np.errstate(over="ignore"):
            norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
            largest = np.abs(own).max(initial=0) * np.abs(others).max(initial=0) * max(own.shape[1], 1)
        # Beyond exact doubles bounds say nothing, and every eligible row is scored.
        bounded = largest < EXACT and np.isfinite(self.edges).all()
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for node, last in self.order:
            eligible = (labels == self.labels[node]) if self.own_label else (labels != self.labels[node])
            eligible &= ids != self.ids[node]
            parent, floors, tops = self.parents[node], self.floors(node), self.tops[node]
            if parent >= 0 and bounded:
                # Rounding of lengths and sums is far below this slack.
                reach = self.edges[node] * norms * (1 + 1e-9) + 1.0
                low, high = held[parent][0] - reach, held[parent][1] + reach
                wanted = np.zeros(len(ids), bool)
                for floor, top in zip(floors.tolist(), tops.tolist()):
                    if floor <= top:
                        wanted |= (high >= floor) & (low <= top)
                chosen = np.flatnonzero(eligible & wanted)
            else:
                low = high = None
                chosen = np.flatnonzero(eligible)
            if last and parent >= 0:
                held.pop(parent, None)
            scored = np.arange(len(ids)) if bounded and parent < 0 else chosen
            # Where most rows are wanted, one product with all of them is cheaper than a copy of the rows.
            if not bounded:
                values = exact_products(own[node:node + 1], others[scored])[0]
            elif len(scored) * 2 > len(ids):
                values = (others @ own[node])[scored]
            else:
                values = others[scored] @ own[node]
            if self.inner[node] and bounded:
                if low is None:
                    low, high = np.zeros(len(ids)), np.zeros(len(ids))
                low[scored] = high[scored] = values
                held[node] = (low, high)
            whole = values.astype(np.int64)
            if len(scored) != len(chosen):
                whole = whole[chosen]
            self._keep(node, floors, whole, ids[chosen])

    def _keep(self, node: int, floors: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        for w, (floor, top) in enumerate(zip(floors, self.tops[node])):
            fits = scores >= floor if self.own_label else (scores >= floor) & (scores <= top)
            if not fits.any():
                continue
            s, i = scores[fits], ids[fits]
            if len(s) > self.k:
                reach = s >= np.partition(s, len(s) - self.k)[len(s) - self.k]
                s, i = s[reach], i[reach]
            s, i = np.concatenate((self.scores[node, w], s)), np.concatenate((self.found[node, w], i))
            # ~s falls as s rises, and unlike -s never runs over.
            best = np.lexsort((i, ~s))[:self.k]
            self.scores[node, w], self.found[node, w] = s[best], i[best]

    def result(self) -> pa.RecordBatch:
        node, window, place = np.nonzero(self.found != NO_ID)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.ids[node]), pa.array(self.tops[node, window]), pa.array(self.found[node, window, place]),
             pa.array(self.scores[node, window, place])], ["query_id", "top", "vec_id", "score"])


_FOUND = "query_id bigint, top bigint, vec_id bigint, score bigint"


def _packer(tree: bool) -> Callable:
    """Runs of equal first column (no, vec_id, label, v, tops) as one row; anchors get their tree."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped(batches, 0):
            ids = rows.column(1).to_numpy()
            first = np.argsort(ids, kind="stable")
            ids, values = ids[first], matrix(rows.column(3))[first]
            labels = rows.column(2).to_numpy().astype(np.int64)[first]
            number = rows.column(0)[0].as_py()
            parents, edges, windows = (None,) * 3
            if tree:
                parents, edges = (x.tobytes() for x in spanning_tree(values))
                tops = rows.column(4).combine_chunks()
                if tops.null_count == 0:
                    # Anchors with fewer windows are filled up with one that nothing fits.
                    width = max(tops.value_lengths().to_numpy().max(), 1)
                    padded = [(t + [LOWEST] * width)[:width] for t in tops.to_pylist()]
                    windows = np.array(padded, np.int64)[first].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number if tree else None], pa.int32()), pa.array([-1 if tree else number], pa.int32()),
                 pa.array([ids.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary()),
                 pa.array([values.tobytes()], pa.binary()), pa.array([values.shape[1]], pa.int32()),
                 pa.array([parents], pa.binary()), pa.array([edges], pa.binary()), pa.array([windows], pa.binary())],
                [part.split()[0] for part in _PACKED.split(", ")])

    return pack


def _miner(k: int) -> Callable:
    """Rows (task, no, ...) in order: a task's block of anchors (no -1), then its shards."""
    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, block = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                c = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names)}
                ids, labels = np.frombuffer(c["ids"], np.int64), np.frombuffer(c["labels"], np.int64)
                values = np.frombuffer(c["rows"]).reshape(len(ids), c["width"])
                if c["task"] != task:
                    if block is not None:
                        yield block.result()
                    task, block = c["task"], None
                if c["no"] < 0:
                    windows = c["windows"] and np.frombuffer(c["windows"], np.int64).reshape(len(ids), -1)
                    block = _Block(ids, labels, values, np.frombuffer(c["parents"], np.int64),
                                   np.frombuffer(c["edges"]), windows, k)
                elif block is not None:
                    block.meet(ids, labels, values)
        if block is not None:
            yield block.result()

    return mine


def _packed(rows: DataFrame, number: str, tree: bool) -> DataFrame:
    dealt = rows.repartition(number).sortWithinPartitions(number)
    return written_once(dealt.select(number, "vec_id", "label", "v", "tops").mapInArrow(_packer(tree), _PACKED))


def labelled(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, grid: int) -> DataFrame:
    """vec_id, label, v (floor(grid * x) as doubles): rows with an id, a label and finite components only.

    Of rows that repeat an id, the one whose vector, then label, sorts first counts.
    """
    raw = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), raw.alias("v"),
                          F.col(label_column).cast("bigint").alias("label")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    return rows.groupBy("vec_id").agg(F.min(F.struct("v", "label")).alias("row")).select(
        "vec_id", "row.label", F.transform("row.v", lambda x: _floored(x * grid)).alias("v"))


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   grid: int = GRID, id_column: str = "vec_id", vector_column: str = "embedding",
                   label_column: str = "label", block_anchors: int = BLOCK_ANCHORS,
                   shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(grid * x); scores are integer inner products, higher ones first,
    ties by smaller vec_id.  Anchors are the rows whose id is divisible by ``every``; the ``positives``
    best other rows of an anchor's label are its positives.  For each positive the ``negatives``
    best rows of other labels score at least 80 and at most 100 per cent of the positive's score.

    Rows without id, label or vector, or with a component that is null or not finite, take no part;
    components that the shorter of two vectors lacks count as zero.  An anchor without
    positives, or a positive without negatives in its window (always so if it scores below zero),
    gives no rows; neither does an empty table.
    """
    spark = vectors.sparkSession
    rows = written_once(labelled(vectors, id_column, vector_column, label_column, grid))
    anchors = rows.where(F.col("vec_id") % every == 0)
    n, n_anchors = rows.count(), anchors.count()
    blocks = max(1, -(-n_anchors // block_anchors))
    shards = max(1, LEAST_TASKS // blocks, -(-n // shard_rows))
    groups = max(min(shards, -(-LEAST_TASKS // blocks)), -(-shards // TASK_SHARDS))
    partitions = min(4 * blocks * groups, MOST_PARTITIONS)

    def dealt(part: DataFrame, count: int, salt: int) -> DataFrame:
        return part.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(count)).cast("int"))

    nothing = F.lit(None).cast("array<bigint>").alias("tops")
    stored = _packed(dealt(rows, shards, 0).select("part", "vec_id", "label", "v", nothing), "part", tree=False)

    def searched(asked: DataFrame, k: int) -> DataFrame:
        """The k best rows of every anchor and window in each group of shards."""
        planted = _packed(dealt(asked, blocks, 1).select("part", "vec_id", "label", "v", "tops"), "part", tree=True)
        columns = [c.split()[0] for c in _PACKED.split(", ")][1:]
        of_task = F.col("block") * groups + F.col("group")
        here = planted.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).select(
            of_task.alias("task"), *columns)
        passing = (
            stored.drop("block").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
            .withColumn("group", F.pmod("no", F.lit(groups))).select(of_task.alias("task"), *columns))
        met = here.unionByName(passing).repartition(partitions, "task").sortWithinPartitions("task", "no")
        return met.mapInArrow(_miner(k), _FOUND)

    of_label = written_once(ranked(searched(anchors.withColumn("tops", nothing), positives), positives).select(
        F.col("query_id").alias("anchor_id"), F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score")))
    windows = of_label.groupBy("anchor_id").agg(F.array_sort(F.collect_set("positive_score")).alias("tops"))
    asked = anchors.join(windows, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "v", "tops")
    found = searched(asked, negatives)
    order = Window.partitionBy("query_id", "top").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return of_label.join(
        best.select(F.col("query_id").alias("anchor_id"), F.col("top").alias("positive_score"),
                    F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    F.col("score").alias("negative_score")), ["anchor_id", "positive_score"]
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
