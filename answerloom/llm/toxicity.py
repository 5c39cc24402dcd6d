"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after the other.  Each model reads the document's words and
the probabilities of the categories before it.  For training, those come from models that
did not see the document (out-of-fold predictions), so a later model learns to weigh them as
they will be when it is used.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.llm.sampling import hashed_sample
from answerloom.llm.words import WordHashes, mixed, words_of

FEATURES = 1 << 20
FOLDS, SAMPLE = 3, 6000
# A feature needs three documents; a model keeps the 400 that set its class apart most.
RARE, KEPT = 3, 400
ROUNDS, RATE, PENALTY = 150, 0.03, 0.3
PREFIXES = (4, 5)
THRESHOLD = 0.5
#: Weak labels of the inner categories: a toxic document belongs to those whose words it uses.
CATEGORIES = {
    "insult": ("idiot", "moron", "stupid", "loser", "clown", "fool", "dumb"),
    "contempt": ("pathetic", "worthless", "disgusting", "useless", "ridiculous"),
    "dehumanising": ("scum", "trash", "vermin", "filth", "garbage"),
}
_STRIP = b".,;:!?\"'()[]{}*#$%&-"


def word_features(data: bytes | None, hashes: WordHashes) -> np.ndarray:
    """Distinct hash numbers of the document's words and of the beginnings of longer ones.

    Punctuation at a word's ends is left out.  Beginnings tell inflected and compound
    forms that are rare one by one.
    """
    words = {w.strip(_STRIP) for w in words_of(data)}
    words.discard(b"")
    if not words:
        return np.zeros(0, np.int64)
    for size in PREFIXES:
        words |= {w[:size] + b"~" for w in words if len(w) > size and w[-1:] != b"~"}
    return np.unique((mixed(hashes.of(list(words))) >> np.uint64(44)).astype(np.int64))


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        found = [word_features(t.as_py(), hashes).astype(np.int32) for t in batch.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32())),
                                          *batch.columns[3:]], ["doc_id", "label", "features", *batch.schema.names[3:]])


class Linear:
    """Logistic regression on binary features and a few dense ones.

    Only the KEPT features that differ most between the classes (by the z-score of their
    counts) get a weight; words of single documents would be learned by heart.
    """

    def __init__(self, size: int, dense: int):
        self.weights, self.dense, self.bias = np.zeros(size), np.zeros(dense), 0.0

    def fit(self, rows: np.ndarray, columns: np.ndarray, extra: np.ndarray, y: np.ndarray) -> Linear:
        n = len(y)
        if n == 0:
            return self
        share = min(max(y.mean(), 0.5 / n), 1 - 0.5 / n)
        spread = share * (1 - share)
        held = np.bincount(columns, minlength=len(self.weights)).astype(float)
        positive = np.bincount(columns, y[rows], len(self.weights))
        z = (positive - held * share) / np.sqrt(np.maximum(held * (1 - held / n), 0.5) * spread)
        used = np.argsort(-np.where(held >= RARE, np.abs(z), 0), kind="stable")[:KEPT]
        place = np.full(len(self.weights), -1)
        place[used] = np.arange(len(used))
        column = place[columns]
        row, column = rows[column >= 0], column[column >= 0]
        weights, dense, bias = np.zeros(len(used)), self.dense.copy(), float(np.log(share / (1 - share)))
        scale, scale_dense = held[used] * spread + PENALTY, (extra * extra).sum(axis=0) * spread + PENALTY
        push, push_dense, push_bias = np.zeros(len(used)), np.zeros(len(dense)), 0.0
        for _ in range(ROUNDS):
            logit = np.bincount(row, weights[column], n) + extra @ dense + bias
            error = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y
            push = 0.9 * push + (np.bincount(column, error[row], len(used)) + PENALTY * weights) / scale
            push_dense = 0.9 * push_dense + (extra.T @ error + PENALTY * dense) / scale_dense
            push_bias = 0.9 * push_bias + error.sum() / (n * spread)
            weights -= RATE * push
            dense -= RATE * push_dense
            bias -= RATE * push_bias
        self.weights[used], self.dense, self.bias = weights, dense, bias
        return self

    def probability(self, rows: np.ndarray, columns: np.ndarray, extra: np.ndarray, n: int) -> np.ndarray:
        z = np.bincount(rows, self.weights[columns], n) + extra @ self.dense + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """Models in order; ``place`` gives the column of a hash number, -1 for unused ones."""

    names: list[str]
    models: list[Linear]
    place: np.ndarray

    def probabilities(self, documents: list[np.ndarray]) -> np.ndarray:
        columns = [self.place[d] for d in documents]
        columns = [c[c >= 0] for c in columns]
        rows = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
        flat = np.concatenate([np.zeros(0, np.int64), *columns]).astype(np.int64)
        extra = np.zeros((len(documents), 0))
        for model in self.models:
            p = model.probability(rows, flat, extra, len(documents))
            extra = np.column_stack([extra, p])
        return extra


def fit_chain(documents: list[np.ndarray], fold: np.ndarray, labels: np.ndarray, names: list[str]) -> Chain:
    """A chain over ``labels`` (documents x categories); words of fewer than three documents are left out."""
    counts = np.bincount(np.concatenate([np.zeros(0, np.int64), *documents]).astype(np.int64), minlength=FEATURES)
    used = np.flatnonzero(counts >= RARE)
    place = np.full(FEATURES, -1, np.int32)
    place[used] = np.arange(len(used))
    columns = [place[d] for d in documents]
    columns = [c[c >= 0] for c in columns]
    rows = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    flat = np.concatenate([np.zeros(0, np.int64), *columns]).astype(np.int64)
    n, extra, models = len(documents), np.zeros((len(documents), 0)), []
    for j in range(len(names)):
        y = labels[:, j].astype(float)
        aside = np.zeros(n)
        for f in range(FOLDS):
            seen = fold != f
            number = np.cumsum(seen) - 1
            inside = seen[rows]
            model = Linear(len(used), extra.shape[1]).fit(number[rows[inside]], flat[inside], extra[seen], y[seen])
            aside[~seen] = model.probability(rows, flat, extra, n)[~seen]
        models.append(Linear(len(used), extra.shape[1]).fit(rows, flat, extra, y))
        extra = np.column_stack([extra, aside])
    return Chain(list(names), models, place)


def trained(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, ...]], id_column: str,
            text_column: str, label_column: str, sample: int) -> Chain | None:
    """A chain on at most ``sample`` labelled rows, those with the smallest md5 of the id.

    The label itself is the last category.  Without labels of both classes there is no chain.
    """
    chosen = hashed_sample(
        labels.select(F.col(id_column).cast("bigint").alias("label_id"),
                      F.col(label_column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("label_id").isNotNull())
        .groupBy("label_id").agg(F.max("label").alias("label")), F.col("label_id"), sample)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    uses = [text.rlike(r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(words) + r")(?![\p{L}\p{N}])").cast("int").alias(name)
            for name, words in categories.items()]
    rows = (
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text.alias("text"), *uses)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "label", "text", *categories)
        .mapInArrow(_sparse, "doc_id bigint, label int, features array<int>, "
                    + ", ".join(f"{c} int" for c in categories)).toArrow()
    )
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    y = rows.column("label").to_numpy()[order]
    if len(y) == 0 or y.min() == y.max():
        return None
    features = rows.column("features").combine_chunks()
    documents = [features[int(i)].values.to_numpy().astype(np.int64) for i in order]
    inner = [rows.column(c).to_numpy()[order] * y for c in categories]
    fold = (mixed(rows.column("doc_id").to_numpy()[order].view(np.uint64)) % np.uint64(FOLDS)).astype(int)
    return fit_chain(documents, fold, np.column_stack([*inner, y]), [*categories, label_column])


def _scorer(chain: Chain | None, width: int) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [word_features(t.as_py(), hashes) for t in batch.column(1).cast(pa.binary())]
            p = chain.probabilities(found) if chain else np.zeros((len(found), width))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(p[:, j], pa.float64()) for j in range(width))],
                ["doc_id", *(f"p{j}" for j in range(width))])

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, ...]] | None = None,
                   id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
                   sample: int = SAMPLE) -> DataFrame:
    """Per row: doc_id, probability of every category in chain order, predicted (the last >= 0.5).

    Whole texts are read; null and blank texts have no words and get the chain's base
    rates.  Without usable labels all probabilities are 0.  Of repeated labels the larger one
    counts; ids may be null or repeat.  No rows give no rows.
    """
    categories = CATEGORIES if categories is None else categories
    names = [*categories, label_column]
    chain = trained(docs, labels, categories, id_column, text_column, label_column, sample)
    schema = "doc_id bigint, " + ", ".join(f"p{j} double" for j in range(len(names)))
    return (
        docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
        .mapInArrow(_scorer(chain, len(names)), schema)
        .select("doc_id", *(F.col(f"p{j}").alias(f"p_{name}") for j, name in enumerate(names)),
                (F.col(f"p{len(names) - 1}") >= THRESHOLD).cast("int").alias("predicted"))
    )
