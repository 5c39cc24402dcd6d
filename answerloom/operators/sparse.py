"""BM25 ranking and its fusion with dense results."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.text import words
from answerloom.operators.scoring import SCORE_DIGITS, BestK, TopK, rank_top
from answerloom.operators.skew import computed_once, fits
from answerloom.operators.stored import written_once

BROADCAST_TERMS = 500_000
SLICE_SCORES = 1_000_000  # pairs of a passage's and a question's term held at once


def bm25_top(questions: DataFrame, passages: DataFrame, k: int, k1: float = 1.2, b: float = 0.75,
             broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """Top ``k`` passages per question (Robertson and Zaragoza 2009).

    ``questions``: question_id, text; ``passages``: passage_id and text, or in its place
    the list ``words``, best a stored table, since it is read for the term statistics
    and again for the scores.

    Question terms are broadcast with their weights and every scan task counts and scores its own
    passages; no text is shuffled, a frequent word costs time, never one task, and only the
    best ``k`` per question and task leave it.  More than ``broadcast_terms`` question terms
    are dealt into blocks of whole questions, and each block is one scan.  Every passage
    that shares a word with the question has a score, however small it is when rounded.
    """
    asked = (
        questions.select("question_id", F.explode(words(F.col("text"))).alias("term"))
        .groupBy("question_id", "term").agg(F.count("*").alias("qtf"))
    )
    if "words" in passages.columns:
        split = passages.select("passage_id", F.coalesce("words", F.expr("cast(array() as array<string>)")).alias("words"))
    else:
        split = computed_once(passages.select("passage_id", "text"), "words", words(F.coalesce("text", F.lit(""))))
    blocks = 1 if fits(asked, broadcast_terms) else -(-asked.count() // max(1, broadcast_terms))
    # The empty term stands for the whole passage: its document frequency is the
    # number of passages and its length sum the corpus length, all from one scan.
    if blocks == 1:
        counted = _counted_by_scan(split, asked.select("term").distinct().toArrow()["term"])
    else:
        counted = (
            split.select(F.explode(F.concat(F.array_distinct("words"), F.array(F.lit("")))).alias("term"),
                         F.size("words").alias("length"))
            .groupBy("term").agg(F.count("*").alias("df"), F.sum("length").alias("words")))
    counts = written_once(counted)
    whole = counts.where(F.col("term") == "").first()
    n, mean = (whole["df"], whole["words"] / whole["df"]) if whole else (0, 0.0)
    idf = F.log(1 + (n - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weights = asked.join(counts, "term").select("term", "question_id",
                                                (F.col("qtf") * idf).alias("weight"))
    if blocks > 1:
        weights = written_once(weights)
    block = F.pmod(F.xxhash64("question_id"), F.lit(blocks))
    scored = [_score_by_scan(split, weights.where(block == i).toArrow(), mean, k, k1, b)
              for i in range(blocks)]
    return rank_top(reduce(DataFrame.unionByName, scored), k)


def _cells(column: pa.Array, terms: pa.Array) -> tuple[np.ndarray, ...]:
    """Number of words of every row, then row, number in ``terms`` and count of the terms it holds."""
    sizes = column.value_lengths().to_numpy()
    listed = column.flatten()
    term = pc.fill_null(pc.index_in(listed, value_set=terms.cast(listed.type)), -1).to_numpy()
    row = np.repeat(np.arange(len(sizes)), sizes)[term >= 0]
    cell, tf = np.unique(row * len(terms) + term[term >= 0], return_counts=True)
    return sizes, *np.divmod(cell, max(1, len(terms))), tf


def _counted_by_scan(split: DataFrame, terms: pa.ChunkedArray) -> DataFrame:
    """term, df, words (its passages' lengths) of the given terms and of the empty one, added up in every task."""
    shared = split.sparkSession.sparkContext.broadcast(terms.combine_chunks())

    def run(batches):
        terms = shared.value
        df, length = np.zeros(len(terms) + 1, np.int64), np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            sizes, row, term, _ = _cells(batch.column(1), terms)
            df[:-1] += np.bincount(term, minlength=len(terms))
            length[:-1] += np.bincount(term, sizes[row], len(terms)).astype(np.int64)
            df[-1] += len(sizes)
            length[-1] += sizes.sum(dtype=np.int64)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([terms.cast(pa.string()), pa.array([""])]).take(pa.array(held)), pa.array(df[held]),
             pa.array(length[held])], ["term", "df", "words"])

    parts = split.select("passage_id", "words").mapInArrow(run, "term string, df bigint, words bigint")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.sum("words").alias("words"))


def _score_by_scan(split: DataFrame, weights: pa.Table, mean: float, k: int, k1: float,
                   b: float) -> DataFrame:
    """Broadcast term weights as rows of a sparse matrix, fold the best ``k``.

    Only pairs that share a term are ever held, at most about SLICE_SCORES at once.
    """
    weights = weights.sort_by("term")
    runs = weights["term"].combine_chunks().dictionary_encode()
    starts = np.searchsorted(runs.indices.to_numpy(), np.arange(len(runs.dictionary) + 1))
    qids, columns = np.unique(weights["question_id"].to_numpy(), return_inverse=True)
    shared = split.sparkSession.sparkContext.broadcast(
        (runs.dictionary, starts, qids, columns, weights["weight"].to_numpy()))

    def run(batches):
        terms, starts, qids, columns, values = shared.value
        fans = np.diff(starts)
        best = BestK(len(qids), k)
        for batch in batches if len(qids) else ():
            pids = batch.column(0).to_numpy()
            sizes, row, term, tf = _cells(batch.column(1), terms)
            gain = tf * (k1 + 1) / (tf + k1 * (1 - b + b * sizes[row] / mean))
            fan = fans[term]
            # Cut where a row begins and the entries so far fill a slice.
            full = np.cumsum(np.bincount(row, fan, len(sizes))) // SLICE_SCORES
            for cells in np.split(np.arange(len(row)), np.flatnonzero(np.diff(full[row])) + 1):
                many = fan[cells]
                source = np.repeat(cells, many)
                entry = starts[term][source] + np.arange(len(source)) - np.repeat(
                    np.cumsum(many) - many, many)
                passage, question, score = _pair_sums(row[source], columns[entry], len(qids),
                                                      values[entry] * gain[source])
                best.add_cells(question, pids[passage], np.round(score, SCORE_DIGITS))
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[best.row]), pa.array(best.pid), pa.array(best.score)],
            ["question_id", "passage_id", "score"])

    return split.select("passage_id", "words").mapInArrow(run, TopK.schema)


def _pair_sums(row: np.ndarray, column: np.ndarray, columns: int, value: np.ndarray):
    """Sums of the values of equal (row, column): row, column, sum, for pairs that occur.

    Where the entries fill a good part of the table from first to last row, they are added up in
    that table; elsewhere only pairs that occur are held.
    """
    if not len(row):
        return row, column, value
    first = row.min()
    pair, space = (row - first) * columns + column, int(row.max() - first + 1) * columns
    if space <= 4 * len(pair):
        found = np.flatnonzero(np.bincount(pair, minlength=space))
        total = np.bincount(pair, weights=value, minlength=space)[found]
    else:
        found, at = np.unique(pair, return_inverse=True)
        total = np.bincount(at, weights=value, minlength=len(found))
    row, column = np.divmod(found, columns)
    return row + first, column, total


def unpack_sparse(results: DataFrame) -> DataFrame:
    """Stored sparse results (parallel ``ids`` and ``scores`` lists) as ranked rows."""
    return (
        results.select("question_id", F.posexplode(F.arrays_zip("ids", "scores"))
                       .alias("_at", "_hit"))
        .select("question_id", (F.col("_at") + 1).alias("rank"),
                F.col("_hit.ids").alias("passage_id"), F.col("_hit.scores").alias("score"))
    )


def _scaled(results: DataFrame, name: str) -> DataFrame:
    """Min-max scaled scores per question; a single distinct score becomes 1."""
    per_question = Window.partitionBy("question_id")
    low, high = F.min("score").over(per_question), F.max("score").over(per_question)
    return results.select(
        "question_id", "passage_id",
        F.when(high > low, (F.col("score") - low) / (high - low)).otherwise(1.0).alias(name))


def fuse(dense: DataFrame, sparse: DataFrame, k: int, dense_weight: float = 0.5) -> DataFrame:
    """Weighted sum of scaled scores over the union of both lists.

    Both inputs are top lists, so a question has at most the sum of their lengths.
    """
    both = _scaled(dense, "dense").join(_scaled(sparse, "sparse"),
                                        ["question_id", "passage_id"], "full")
    score = (dense_weight * F.coalesce("dense", F.lit(0.0))
             + (1 - dense_weight) * F.coalesce("sparse", F.lit(0.0)))
    return rank_top(both.select("question_id", "passage_id",
                                F.round(score, SCORE_DIGITS).alias("score")), k)


def fuse_ranks(dense: DataFrame, sparse: DataFrame, k: int, constant: int = 60) -> DataFrame:
    """Reciprocal-rank fusion: sum of ``1 / (constant + rank)``."""
    parts = dense.select("question_id", "passage_id", "rank").unionByName(
        sparse.select("question_id", "passage_id", "rank"))
    scored = parts.groupBy("question_id", "passage_id").agg(
        F.round(F.sum(1 / (F.lit(constant) + F.col("rank"))), SCORE_DIGITS).alias("score"))
    return rank_top(scored, k)
