"""Lossy passage vectors: product quantisation, table scoring, exact rescoring.

A vector is cut into subspaces of a few components.  Every subspace has a codebook of up to 256 centres, and a
passage keeps one byte for each subspace, the number of its nearest centre: 1/16 of its vector with four components of
four bytes.  A search scores the codes where they are scanned, keeps more candidates than asked for, and
only these meet their vectors again.

Codebooks start by rule, from the passages with the smallest md5 of the id, so a code can be stated in SQL;
``refined_books`` moves the centres to the means of all passages' parts, a scan for each round.
Codebooks have as many numbers as 256 vectors, whatever the table's size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.operators.held import BLOCK_ROWS, block_count, emitted, packed, past_held, unpacked
from answerloom.operators.retrieval import rescore, rescore_held
from answerloom.operators.scoring import (
    BROADCAST_QUESTIONS, SCORE_DIGITS, TopK, _matrix, best_folded, few_questions, rank_top, top_passages)
from answerloom.operators.stored import written_once

WIDTH, CENTRES = 4, 256
BOOK_DIGITS, ROUNDS = 6, 4
SAMPLE_QUESTIONS, LEAST_RECALL = 128, 0.9
TILE = 4_000_000  # distances held at once
_LOWEST = -128  # codes are stored as signed bytes


def _parts(vectors: np.ndarray) -> np.ndarray:
    """rows x subspaces x WIDTH; a last subspace that is too narrow is filled with zeros."""
    rows, dimensions = vectors.shape
    subspaces = -(-dimensions // WIDTH)
    filled = np.zeros((rows, subspaces * WIDTH))
    filled[:, :dimensions] = vectors
    return filled.reshape(rows, subspaces, WIDTH)


def rule_books(passages: DataFrame) -> np.ndarray:
    """subspaces x centres x WIDTH: the parts of the 256 passages (all, if fewer) with the smallest md5 of the id."""
    rows = passages.select("passage_id", F.col("vector").cast("array<double>").alias("vector"))
    chosen = rows.orderBy(F.md5(F.col("passage_id").cast("string")), "passage_id").limit(CENTRES).toArrow()
    return _parts(_matrix(chosen["vector"])).transpose(1, 0, 2)


def nearest_centres(vectors: np.ndarray, books: np.ndarray) -> np.ndarray:
    """rows x subspaces: number of the nearest centre, ties to the smaller number."""
    parts = _parts(vectors)
    out = np.empty(parts.shape[:2], np.int64)
    step = max(1, TILE // max(1, books.shape[1]))
    for m, book in enumerate(books):
        norms = (book * book).sum(axis=1)
        for at in range(0, len(parts), step):
            distance = np.round(norms - 2 * parts[at:at + step, m] @ book.T, SCORE_DIGITS)
            out[at:at + step, m] = distance.argmin(axis=1)
    return out


def refined_books(passages: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Centres moved to the mean of the parts they are nearest to, ``rounds`` times, over all passages.

    A task sends one sum for each centre, whatever its number of rows.  A centre without parts
    stays.  Means are rounded, so they hardly depend on the order of the sums.
    """
    rows = passages.select(F.col("vector").cast("array<double>").alias("vector"))
    for _ in range(rounds if books.size else 0):
        sums = _sums(rows, books).groupBy("subspace", "centre").agg(
            F.sum("n").alias("n"), *[F.sum(f"x{j}").alias(f"x{j}") for j in range(WIDTH)]).toArrow()
        moved = books.copy()
        at = sums["subspace"].to_numpy(), sums["centre"].to_numpy()
        whole = np.stack([sums[f"x{j}"].to_numpy() for j in range(WIDTH)], axis=1)
        moved[at] = np.round(whole / sums["n"].to_numpy()[:, None], BOOK_DIGITS)
        books = moved
    return books


def _sums(rows: DataFrame, books: np.ndarray) -> DataFrame:
    def run(batches):
        subspaces, centres = books.shape[:2]
        n = np.zeros(subspaces * centres)
        total = np.zeros((subspaces * centres, WIDTH))
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch.column(0))
                cell = (nearest_centres(vectors, books) + np.arange(subspaces) * centres).ravel()
                flat = _parts(vectors).reshape(-1, WIDTH)
                n += np.bincount(cell, minlength=len(n))
                total += np.stack([np.bincount(cell, flat[:, j], len(n)) for j in range(WIDTH)], axis=1)
        used = np.flatnonzero(n)
        subspace, centre = np.divmod(used, centres)
        yield pa.RecordBatch.from_pydict({
            "subspace": subspace, "centre": centre, "n": n[used].astype(np.int64),
            **{f"x{j}": total[used, j] for j in range(WIDTH)}})

    sums = ", ".join(f"x{j} double" for j in range(WIDTH))
    return rows.mapInArrow(run, f"subspace bigint, centre bigint, n bigint, {sums}")


def coded(passages: DataFrame, books: np.ndarray) -> DataFrame:
    """passage_id, codes: one signed byte per subspace, the centre's number less 128.

    A narrow step, so new passages are coded with the same books and appended.
    """
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                numbers = nearest_centres(_matrix(batch.column(1)), books)
                starts = np.arange(len(numbers) + 1, dtype=np.int32) * numbers.shape[1]
                codes = pa.array((numbers + _LOWEST).astype(np.int8).ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.ListArray.from_arrays(pa.array(starts), codes)], ["passage_id", "codes"])

    rows = passages.select(F.col("passage_id").cast("bigint").alias("passage_id"),
                           F.col("vector").cast("array<double>").alias("vector"))
    return rows.mapInArrow(run, "passage_id bigint, codes array<tinyint>")


class CodedTop(TopK):
    """Best ``k`` by codes: the sums of a question's products with the centres that a passage names.

    A block of codes is looked up in the codebooks and multiplied at once, which gives these sums
    as a matrix product.
    """

    def __init__(self, k: int, books: np.ndarray, dimensions: int):
        super().__init__(k)
        self.books, self.dimensions = books, dimensions

    def fold(self, table, blocks):
        subspace = np.arange(len(self.books))

        def looked_up():
            for ids, codes in blocks:
                centres = self.books[subspace, codes.astype(np.int64) - _LOWEST]
                yield ids, centres.reshape(len(ids), -1)[:, :self.dimensions]
        return super().fold(table, looked_up())


def coded_candidates(questions: DataFrame, codes: DataFrame, books: np.ndarray, n: int,
                     broadcast_questions: int = BROADCAST_QUESTIONS, question_block: int = BLOCK_ROWS, **layout) -> DataFrame:
    """The ``n`` best passages of every question by codes: question_id, rank, passage_id, score.

    More questions than may be broadcast are held in blocks while the codes stream past.
    """
    first = questions.select(F.size("vector").alias("n")).first()
    fold = CodedTop(n, books, first["n"] if first else 0)
    stored = codes.withColumnRenamed("codes", "vector")
    if few_questions(questions, broadcast_questions):
        return best_folded(questions, stored, fold, broadcast_questions=broadcast_questions, **layout)

    def run(table: pa.Table, batches):
        found = fold.fold(table, ((b.column(0).to_numpy(), unpacked(b.column(1), np.int8)) for b in batches))
        yield from emitted(pa.table(dict(zip(("question_id", "passage_id", "score"), found))))

    asked = questions.select("question_id", F.col("vector").cast("array<double>").alias("vector"))
    blocks = block_count(asked.count(), n, question_block)
    passing = packed(codes.select("passage_id", F.col("codes").cast("array<tinyint>").alias("codes")), "codes")
    return rank_top(past_held(asked, passing, run, TopK.schema, blocks), n, False)


def coded_search(questions: DataFrame, passages: DataFrame, codes: DataFrame, books: np.ndarray, k: int,
                 n_candidates: int, **layout) -> DataFrame:
    """Approximate top ``k`` with exact scores: the best ``n_candidates`` by codes, scored anew from their vectors."""
    n = max(k, n_candidates)
    found = coded_candidates(questions, codes, books, n, **layout)
    if few_questions(questions, layout.get("broadcast_questions", BROADCAST_QUESTIONS)):
        return rescore(found, questions, passages, k)
    return rescore_held(found, questions, passages, k, n, layout.get("question_block", BLOCK_ROWS))


def fitted_candidates(questions: DataFrame, passages: DataFrame, codes: DataFrame, books: np.ndarray, k: int) -> int:
    """The smallest doubled number of candidates with a recall of LEAST_RECALL on a sample of questions.

    The sample is the SAMPLE_QUESTIONS questions with the smallest md5 of the id; its recall less two standard errors
    must reach the goal.  As many candidates as passages are exact and end the fit.
    """
    sample = written_once(questions.orderBy(F.md5(F.col("question_id").cast("string")), "question_id").limit(SAMPLE_QUESTIONS))
    truth = written_once(top_passages(sample, passages, k).select("question_id", "passage_id"))
    n_passages = codes.count()
    n = k
    while n < n_passages:
        hit = coded_candidates(sample, codes, books, n).select("question_id", "passage_id", F.lit(1).alias("hit"))
        share = truth.join(hit, ["question_id", "passage_id"], "left").groupBy("question_id").agg(
            F.avg(F.coalesce("hit", F.lit(0))).alias("share"))
        got = share.agg(F.avg("share").alias("mean"), F.stddev_pop("share").alias("spread"), F.count("*").alias("n")).first()
        if not got["n"] or got["mean"] - 2 * got["spread"] / math.sqrt(got["n"]) >= LEAST_RECALL:
            return n
        n *= 2
    return max(1, n_passages)
