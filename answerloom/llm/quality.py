"""Text quality: random-indexing word vectors, pooled per document, and a small network.

A word has a fixed sparse random index vector.  Its word vector is the sum of the index
vectors of the words beside it, over the whole corpus: words that occur in like company get
like vectors.  Words share 16,384 hash rows, so the table of word vectors has a fixed size
(3 MB) whatever the corpus; tasks sum their part of it and the sums are added up.

A document pools its words' vectors: their mean, their spread, and how far neighbours lie
apart, together with length and repetition figures of the text.  A network of two layers
reads them; its probabilities are calibrated by a temperature fitted on rows kept aside.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.llm.sampling import hashed_sample
from answerloom.llm.words import WordHashes, mixed, words_of

ROWS, DIMENSIONS, SPARSE, REACH = 1 << 14, 48, 6, 2
SLICES = 64
FIGURES = 5
POOLED = 3 * DIMENSIONS + FIGURES
HIDDEN, ROUNDS = 32, 400
SAMPLE = 12_000
FOLDS, THRESHOLD = 5, 0.3
_PIECE = 1 << 16


def index_vectors() -> np.ndarray:
    """Sparse index vectors of +1 and -1 by hash row, the same on every machine."""
    draw = np.random.Generator(np.random.PCG64(7))
    table = np.zeros((ROWS, DIMENSIONS), np.float32)
    at = draw.random((ROWS, DIMENSIONS)).argpartition(SPARSE, axis=1)[:, :SPARSE]
    np.put_along_axis(table, at, draw.choice(np.array([-1, 1], np.float32), (ROWS, SPARSE)), axis=1)
    return table


def rows_of(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) >> np.uint64(50)).astype(np.int64)


def _company(rows: np.ndarray, index: np.ndarray) -> np.ndarray:
    """For every word of a text the sum of its neighbours' index vectors."""
    own = index[rows]
    total = np.zeros_like(own)
    for step in range(1, REACH + 1):
        if len(rows) > step:
            total[step:] += own[:-step]
            total[:-step] += own[step:]
    return total


def _sum_company(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, hashes = index_vectors(), WordHashes()
    sums = np.zeros((ROWS, DIMENSIONS))
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            rows = rows_of(hashes.of(words_of(text.as_py())))
            for at in range(0, len(rows), _PIECE):
                low = max(0, at - REACH)
                piece = rows[low:at + _PIECE + REACH]
                company = _company(piece, index)[at - low:at - low + _PIECE]
                own = rows[at:at + _PIECE]
                order = np.argsort(own, kind="stable")
                found, first = np.unique(own[order], return_index=True)
                sums[found] += np.add.reduceat(company[order], first, axis=0)
    parts = sums.astype(np.int64).reshape(SLICES, -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(SLICES), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())],
        ["slice", "sums"])


def _add_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for no, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
            part = np.frombuffer(sums.as_buffer(), np.int64)
            totals[no] = totals[no] + part if no in totals else part.copy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(totals.keys(), pa.int32()), pa.array([x.tobytes() for x in totals.values()], pa.binary())],
        ["slice", "sums"])


def word_vectors(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """Unit word vectors by hash row, from all words of all texts.

    Every task sends its sums in slices, slices of one number meet in one task and come to the
    driver as one: ROWS x DIMENSIONS integers, whatever the corpus.  Rows of words that
    never occur, or only alone, are zero.
    """
    schema = "slice int, sums binary"
    slices = (
        docs.select(F.col(text_column).cast("string").alias("text")).mapInArrow(_sum_company, schema)
        .repartition("slice").mapInArrow(_add_slices, schema).collect()
    )
    table = np.zeros((SLICES, ROWS // SLICES * DIMENSIONS))
    for row in slices:
        table[row["slice"]] = np.frombuffer(row["sums"], np.int64)
    table = table.reshape(ROWS, DIMENSIONS)
    # Common words stand beside everything; what they have in common is taken out.
    table = np.where(table.any(axis=1, keepdims=True), table / np.maximum(
        np.linalg.norm(table, axis=1, keepdims=True), 1e-9), 0)
    centre = table[table.any(axis=1)].mean(axis=0) if table.any() else 0
    table = np.where(table.any(axis=1, keepdims=True), table - centre, 0)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(data: bytes | None, vectors: np.ndarray, hashes: WordHashes) -> np.ndarray:
    """The document's features; a text without words gives zeros."""
    out = np.zeros(POOLED, np.float32)
    words = words_of(data)
    n = len(words)
    if n == 0:
        return out
    codes = hashes.of(words)
    rows = rows_of(codes)
    total, square, apart = (np.zeros(DIMENSIONS) for _ in range(3))
    near = 0.0
    for at in range(0, n, _PIECE):
        piece = vectors[rows[at:at + _PIECE + 1]]
        own = piece[:_PIECE]
        total += own.sum(axis=0)
        square += (own * own).sum(axis=0)
        if len(piece) > 1:
            apart += np.abs(np.diff(piece, axis=0)).sum(axis=0)
            near += float((piece[1:] * piece[:-1]).sum())
    mean = total / n
    out[:DIMENSIONS] = mean
    out[DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(square / n - mean * mean, 0))
    out[2 * DIMENSIONS:3 * DIMENSIONS] = apart / max(n - 1, 1)
    same = float((codes[1:] == codes[:-1]).mean()) if n > 1 else 0.0
    out[3 * DIMENSIONS:] = (np.log1p(n), len(np.unique(codes)) / n, same, near / max(n - 1, 1),
                            len(data) / n / 10)
    return out


def _pool(vectors: np.ndarray) -> Callable:
    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [pooled(t.as_py(), vectors, hashes) for t in batch.column(2).cast(pa.binary())]
            values = np.concatenate(found) if found else np.zeros(0, np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.FixedSizeListArray.from_arrays(
                    pa.array(values, pa.float32()), POOLED).cast(pa.list_(pa.float32()))],
                ["doc_id", "label", "features"])

    return pool


class Network:
    """Two layers on standardised features, trained by Adam on balanced classes."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3, rounds: int = ROUNDS):
        draw = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = self.standard(x)
        self.layers = [draw.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                       draw.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6))
        self.shift = float(np.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6)))
        first, second = ([np.zeros_like(p) for p in self.layers] for _ in range(2))
        for step in range(1, rounds + 1):
            pick = draw.integers(0, len(x), min(512, len(x)))
            for p, g, m, v in zip(self.layers, self._gradients(x[pick], y[pick], weight[pick]), first, second):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                p -= 0.01 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _gradients(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        w1, b1, w2, b2 = self.layers
        hidden = np.maximum(x @ w1 + b1, 0)
        error = weight * (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -30, 30))) - y) / len(y)
        back = np.outer(error, w2) * (hidden > 0)
        return [x.T @ back + 1e-4 * w1, back.sum(axis=0), hidden.T @ error + 1e-4 * w2,
                np.array([error.sum()])]

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Log odds of class 1 at the share of the training rows, not yet calibrated."""
        w1, b1, w2, b2 = self.layers
        return np.maximum(self.standard(x) @ w1 + b1, 0) @ w2 + b2 + self.shift

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the smallest log loss on rows not trained on."""
        if len(y) == 0:
            return
        z = self.logit(x)

        def loss(t: float) -> float:
            return float(np.logaddexp(0, np.where(y == 1, -z, z) / t).mean())

        self.temperature = min((float(t) for t in np.geomspace(0.2, 20, 60)), key=loss)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fold(id_column: str):
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, vectors: np.ndarray, id_column: str,
          text_column: str, label_column: str, sample: int) -> Network | None:
    """A network on at most ``sample`` labelled rows outside fold 0; fold 1 fits the temperature.

    The sample is the rows with the smallest md5 of the id, so it does not depend on
    partitions.  Without labels of both classes there is no network.
    """
    chosen = hashed_sample(
        labels.select(F.col(id_column).cast("bigint").alias("label_id"),
                      F.col(label_column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("label_id").isNotNull() & (fold("label_id") != 0))
        .groupBy("label_id").agg(F.max("label").alias("label")), F.col("label_id"), sample)
    rows = (
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"),
                    F.col(text_column).cast("string").alias("text"))
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "label", "text")
        .mapInArrow(_pool(vectors), "doc_id bigint, label int, features array<float>")
        .select("label", fold("doc_id").alias("fold"), "features", "doc_id").toArrow()
    )
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    y = rows.column("label").to_numpy().astype(float)[order]
    if len(y) == 0 or y.min() == y.max():
        return None
    x = rows.column("features").combine_chunks().flatten().to_numpy().reshape(len(y), POOLED).astype(float)[order]
    aside = rows.column("fold").to_numpy()[order] == 1
    seen = ~aside if 0 < y[~aside].sum() < len(y[~aside]) else np.ones(len(y), bool)
    network = Network(x[seen], y[seen])
    network.calibrate(x[aside], y[aside])
    return network


def _scorer(vectors: np.ndarray, network: Network | None) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [pooled(t.as_py(), vectors, hashes) for t in batch.column(1).cast(pa.binary())]
            if network is None or not found:
                p = np.full(len(found), 0.5)
            else:
                p = network.probability(np.array(found, float))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(p, pa.float64())],
                                             [*batch.schema.names[2:], "score"])

    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  label_column: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, held_out (fold 0), score (probability of label 1), predicted.

    Only the text is scored.  Null and blank texts get the score of a text without words.
    Without usable labels every score is 0.5.  Of repeated labels the larger one counts;
    ids may be null or repeat.  No rows give no rows.
    """
    vectors = word_vectors(docs, text_column)
    network = train(docs.sparkSession, docs, labels, vectors, id_column, text_column, label_column, sample)
    return (
        docs.select(F.lit(1).alias("_"), F.col(text_column).cast("string").alias("text"),
                    F.col(id_column).cast("bigint").alias("doc_id"))
        .mapInArrow(_scorer(vectors, network), "doc_id bigint, score double")
        .select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              label_column: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, with all their columns."""
    vectors = word_vectors(docs, text_column)
    network = train(docs.sparkSession, docs, labels, vectors, id_column, text_column, label_column, sample)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch.column(at).cast(pa.binary())
            found = np.array([pooled(t.as_py(), vectors, hashes) for t in texts], float).reshape(-1, POOLED)
            good = network.probability(found) >= THRESHOLD if network else np.ones(len(found), bool)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
