"""Inner products of question vectors with all passage vectors, in blocks.

Scoring a question against the whole corpus is a matrix product.  Pairs are never
emitted: each task multiplies a block of questions with a block of passages and
folds the scores into what the caller needs (best k, log-sum-exp, a count), and
only the folded rows are shuffled.

Two layouts, chosen by a size check on the question side:

* few questions - they are broadcast and every scan task folds its own passages;
  the passage table is not shuffled at all;
* many questions - both sides are dealt into blocks of bounded size and met block
  by block (``cogroup``).  There are at most MOST_PARTS blocks of a side until they reach
  LARGEST_BLOCK rows, so the rows repeated in the shuffle stay in proportion to the input.
  Inside a group the same layout meets only the blocks of one group.

The best k are found in two steps: products in single precision, with a bound on their error, tell
which few passages may reach a question's k-th best score, and only these are scored in doubles.

Scores are rounded to SCORE_DIGITS before they are compared, so a ranking does
not depend on the order of a floating-point sum; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SCORE_DIGITS = 9
BROADCAST_QUESTIONS = 20_000
BROADCAST_BYTES = 256 << 20
QUESTION_BLOCK = 8_192
PASSAGE_BLOCK = 32_768
MOST_PARTS, LARGEST_BLOCK = 24, 131_072
MERGE_PARTS = 32
TILE_ROWS = 1024  # questions and passages of a tile that stays in the cache
PAIRS_HELD = 100_000  # candidates whose vectors are gathered at once
LARGEST_NORM = 1e15  # longer vectors are not multiplied in single precision


def _matrix(column) -> np.ndarray:
    """Arrow list column -> 2-d float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.empty((0, 0))
    lengths = column.value_lengths()
    if column.null_count or lengths.to_numpy(zero_copy_only=False).min() != lengths.to_numpy(
            zero_copy_only=False).max() or column.flatten().null_count:
        raise ValueError("vectors must not be NULL, hold NULLs or differ in length")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _tiles(questions: np.ndarray, ids: np.ndarray, passages: np.ndarray):
    """(question rows, ids, scores) of tiles small enough to stay in the cache."""
    for first in range(0, len(questions), TILE_ROWS):
        rows = slice(first, min(first + TILE_ROWS, len(questions)))
        step = max(TILE_ROWS, TILE_ROWS * TILE_ROWS // max(1, rows.stop - first))
        for at in range(0, len(ids), step):
            scores = questions[rows] @ passages[at:at + step].T
            yield rows, ids[at:at + step], np.round(scores, SCORE_DIGITS, out=scores)


class BestK:
    """Running best ``k`` of several rows of scores, ties to the smaller id."""

    def __init__(self, rows: int, k: int, lowest: float = -np.inf):
        self.k, self.bound = k, np.full(rows, lowest)
        self.row, self.pid = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` is rows x passages; only those reaching the bound are sorted."""
        self.add_rows(np.arange(len(self.bound)), ids, scores)

    def add_rows(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """The same for some rows only: ``scores`` is len(rows) x passages."""
        k, floor = self.k, self.bound[rows]
        if scores.shape[1] > k:
            floor = np.maximum(floor, np.partition(scores, scores.shape[1] - k, axis=1)[:, -k])
        new_row, new_col = np.nonzero(scores >= floor[:, None])
        self._merge(rows[new_row], ids[new_col], scores[new_row, new_col])

    def add_cells(self, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Single scores of (row, passage); those below the row's bound are left out."""
        keep = scores >= self.bound[row]
        self._merge(row[keep], ids[keep], scores[keep])

    def _merge(self, new_row: np.ndarray, new_pid: np.ndarray, new_score: np.ndarray) -> None:
        k = self.k
        row = np.concatenate([self.row, new_row])
        pid = np.concatenate([self.pid, new_pid])
        score = np.concatenate([self.score, new_score])
        order = np.lexsort((pid, -score, row))
        row, pid, score = row[order], pid[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        kth, keep = rank == k - 1, rank < k
        self.bound[row[kth]] = score[kth]
        self.row, self.pid, self.score = row[keep], pid[keep], score[keep]


def _first_copies(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows but those with ``k`` smaller ids of the same vector, which no best ``k`` can hold."""
    bits = np.ascontiguousarray(vectors).view(np.int64)
    mix = np.random.default_rng(0).integers(-2**62, 2**62, bits.shape[1]) | 1
    key = bits @ mix
    order = np.lexsort((ids, key))
    new = np.ones(len(ids), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    maybe = np.flatnonzero(~new)
    new[maybe] = (bits[order[maybe]] != bits[order[maybe - 1]]).any(axis=1)
    start = np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
    return np.sort(order[np.arange(len(ids)) - start < k])


class Nearest:
    """Running best ``k`` passages of question vectors, exact, from blocks of passage vectors.

    Products in single precision differ from exact ones by at most a bound that follows from
    the norms; what reaches the k-th best score within it is scored in doubles.  Questions are
    taken by TILE_ROWS, so that merging a few candidates sorts little.
    """

    def __init__(self, questions: np.ndarray, k: int):
        self.k, self.parts = k, [_NearestPart(questions[at:at + TILE_ROWS], k)
                                 for at in range(0, len(questions), TILE_ROWS)]

    def add(self, ids: np.ndarray, passages: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Passages that all questions meet, or only those numbered ``rows``, in rising order."""
        if not len(ids):
            return
        if len(ids) > self.k:
            kept = _first_copies(ids, passages, self.k)
            ids, passages = ids[kept], passages[kept]
        with np.errstate(over="ignore", under="ignore"):
            longest = np.sqrt((passages * passages).sum(axis=1).max())
            rough = passages.astype(np.float32)
        if rows is not None:
            cuts = np.searchsorted(rows, np.arange(len(self.parts) + 1) * TILE_ROWS)
        for no, part in enumerate(self.parts):
            own = slice(None) if rows is None else rows[cuts[no]:cuts[no + 1]] - no * TILE_ROWS
            if rows is None or len(own):
                part.add(ids, passages, rough, longest, np.arange(len(part.questions))[own])

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(question row, passage id, score)"""
        found = [part.result() for part in self.parts]
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        return (np.concatenate([best.row + no * TILE_ROWS for no, best in enumerate(found)]),
                np.concatenate([best.pid for best in found]), np.concatenate([best.score for best in found]))


class _NearestPart:
    def __init__(self, questions: np.ndarray, k: int):
        self.questions, self.k, self.best = questions, k, BestK(len(questions), k)
        with np.errstate(over="ignore", under="ignore"):
            self.rough, self.norms = questions.astype(np.float32), np.sqrt((questions * questions).sum(axis=1))
        self.waiting, self.n_waiting = [], 0

    def add(self, ids, passages, rough, longest, rows) -> None:
        step = max(TILE_ROWS, TILE_ROWS * TILE_ROWS // len(rows))
        asked = self.rough[rows]
        small = longest < LARGEST_NORM and self.norms.max() < LARGEST_NORM
        error = (passages.shape[1] + 4) * 2.0 ** -23 * longest * self.norms[rows] + 10.0 ** -SCORE_DIGITS if small else None
        for at in range(0, len(ids), step):
            part = slice(at, at + step)
            if not small or not self._add_tile(rows, asked, ids[part], passages[part], rough[part], error):
                # Long vectors, or a tile that mostly counts: ties, fewer passages than asked for.
                self._flush()
                self.best.add_rows(rows, ids[part], np.round(self.questions[rows] @ passages[part].T, SCORE_DIGITS))

    def _add_tile(self, rows, asked, ids, passages, rough, error) -> bool:
        scores = asked @ rough.T
        if len(ids) > self.k and np.isneginf(self.best.bound[rows]).any():
            kth = np.partition(scores, len(ids) - self.k, axis=1)[:, -self.k].astype(np.float64) - error
            self.best.bound[rows] = np.maximum(self.best.bound[rows], kth)
        floor = np.nextafter((self.best.bound[rows] - error).astype(np.float32), np.float32(-np.inf))
        found = np.flatnonzero(scores >= floor[:, None])
        if len(found) > max(2 * self.k * len(rows), scores.size // 8):
            return False
        row, column = np.divmod(found, len(ids))
        row, score = rows[row], np.empty(len(found))
        for at in range(0, len(row), PAIRS_HELD):
            part = slice(at, at + PAIRS_HELD)
            score[part] = np.einsum("ij,ij->i", self.questions[row[part]], passages[column[part]])
        self.waiting.append((row, ids[column], np.round(score, SCORE_DIGITS)))
        self.n_waiting += len(row)
        if self.n_waiting > max(10_000, self.k * len(self.questions)):
            self._flush()
        return True

    def _flush(self) -> None:
        if self.waiting:
            self.best.add_cells(*(np.concatenate(c) for c in zip(*self.waiting)))
        self.waiting, self.n_waiting = [], 0

    def result(self) -> BestK:
        self._flush()
        return self.best


class TopK:
    """Best ``k`` passages of every question."""

    schema = "question_id bigint, passage_id bigint, score double"

    def __init__(self, k: int):
        self.k = k

    def fold(self, table: pa.Table, blocks: Iterator[tuple[np.ndarray, np.ndarray]]):
        qids = table["question_id"].to_numpy()
        nearest = Nearest(_matrix(table["vector"]), self.k)
        for ids, passages in blocks:
            nearest.add(ids, passages)
        row, ids, score = nearest.result()
        return [qids[row], ids, score]


class NegativeMass:
    """Log-sum-exp of all passages as negatives, and how many beat the positive.

    Scores are multiplied by ``scale``, logits are scores over ``temperature``; the
    exponential sum is carried as (peak, mass) so that parts can be merged.
    """

    schema = "question_id bigint, peak double, mass double, n bigint, above bigint"

    def __init__(self, scale: float = 1.0, temperature: float = 1.0):
        self.scale, self.temperature = scale, temperature

    def fold(self, table: pa.Table, blocks: Iterator[tuple[np.ndarray, np.ndarray]]):
        return [table["question_id"].to_numpy(), *self.fold_arrays(
            _matrix(table["vector"]), table["gold_score"].to_numpy(), blocks)]

    def fold_arrays(self, questions, gold, blocks):
        gold = np.round(gold, SCORE_DIGITS)[:, None]
        peak, mass = np.full(len(questions), -np.inf), np.zeros(len(questions))
        n, above = np.zeros(len(questions), np.int64), np.zeros(len(questions), np.int64)
        for ids, passages in blocks:
            for rows, tile_ids, scores in _tiles(questions, ids, passages):
                if self.scale != 1.0:
                    scores *= self.scale
                    np.round(scores, SCORE_DIGITS, out=scores)
                above[rows] += np.count_nonzero(scores > gold[rows], axis=1)
                if self.temperature != 1.0:
                    scores /= self.temperature
                top = np.maximum(peak[rows], scores.max(axis=1))
                scores -= top[:, None]
                np.exp(scores, out=scores)
                mass[rows] = mass[rows] * np.exp(peak[rows] - top) + scores.sum(axis=1)
                peak[rows] = top
                n[rows] += len(tile_ids)
        return [peak, mass, n, above]


class CountAbove:
    """How many passages beat (gold_score, gold_id); ties go to the smaller id."""

    schema = "question_id bigint, above bigint"

    def fold(self, table: pa.Table, blocks: Iterator[tuple[np.ndarray, np.ndarray]]):
        qids = table["question_id"].to_numpy()
        questions = _matrix(table["vector"])
        gold = np.round(table["gold_score"].to_numpy(), SCORE_DIGITS)[:, None]
        gold_id = table["gold_id"].to_numpy()[:, None]
        above = np.zeros(len(qids), np.int64)
        for ids, passages in blocks:
            for rows, tile_ids, scores in _tiles(questions, ids, passages):
                beats = (scores > gold[rows]) | ((scores == gold[rows]) & (tile_ids[None, :] < gold_id[rows]))
                above[rows] += np.count_nonzero(beats, axis=1)
        return [qids, above]


class CountScaledAbove:
    """How many scaled scores beat gold_score, as NegativeMass counts them, without its sums.

    Single precision with its error bound tells all but the few scores next to the gold one, which are
    computed in doubles; where many reach it the whole tile is.
    """

    schema = CountAbove.schema

    def __init__(self, scale: float):
        self.scale = scale

    def _beats(self, scores: np.ndarray, gold: np.ndarray) -> np.ndarray:
        return np.round(np.round(scores, SCORE_DIGITS) * self.scale, SCORE_DIGITS) > gold

    def fold(self, table: pa.Table, blocks: Iterator[tuple[np.ndarray, np.ndarray]]):
        qids, questions = table["question_id"].to_numpy(), _matrix(table["vector"])
        gold = np.round(table["gold_score"].to_numpy(), SCORE_DIGITS)
        with np.errstate(over="ignore", under="ignore"):
            rough, norms = questions.astype(np.float32), np.sqrt((questions * questions).sum(axis=1))
        above = np.zeros(len(qids), np.int64)
        for _, passages in blocks:
            with np.errstate(over="ignore", under="ignore"):
                rough_passages = passages.astype(np.float32)
                longest = np.sqrt((passages * passages).sum(axis=1).max())
            for first in range(0, len(qids), TILE_ROWS):
                rows = slice(first, first + TILE_ROWS)
                small = longest < LARGEST_NORM and norms[rows].max() < LARGEST_NORM and self.scale > 0
                # Beyond the products, two roundings move a score by half a last digit each.
                error = (passages.shape[1] + 4) * 2.0 ** -23 * longest * norms[rows] + (
                    (1 + 1 / self.scale) * 10.0 ** -SCORE_DIGITS) if small else None
                for at in range(0, len(passages), TILE_ROWS):
                    part = slice(at, at + TILE_ROWS)
                    above[rows] += self._tile(questions[rows], gold[rows], passages[part], rough[rows],
                                              rough_passages[part], error)
        return [qids, above]

    def _tile(self, questions, gold, passages, rough, rough_passages, error) -> np.ndarray:
        if error is not None:
            scores = rough @ rough_passages.T
            low = np.nextafter((gold / self.scale - error).astype(np.float32), np.float32(-np.inf))
            reach = scores >= low[:, None]
            if np.count_nonzero(reach) <= scores.size // 8:
                row, column = np.divmod(np.flatnonzero(reach), len(passages))
                high = np.nextafter((gold / self.scale + error).astype(np.float32), np.float32(np.inf))
                beats = scores[row, column] > high[row]
                near = np.flatnonzero(~beats)
                exact = np.einsum("ij,ij->i", questions[row[near]], passages[column[near]])
                beats[near] = self._beats(exact, gold[row[near]])
                return np.bincount(row[beats], minlength=len(questions))
        return np.count_nonzero(self._beats(questions @ passages.T, gold[:, None]), axis=1)


def _emit(fold, columns) -> pa.Table:
    names = [part.split()[0] for part in fold.schema.split(", ")]
    return pa.table(dict(zip(names, columns)))


def _worker_functions(fold) -> tuple[Callable, Callable]:
    """Functions that run on executors, for the two layouts."""

    def scan(shared):
        def run(batches):
            def blocks():
                for batch in batches:
                    if batch.num_rows:
                        yield batch.column("passage_id").to_numpy(), _matrix(batch.column("vector"))
            table = shared.value
            if table.num_rows:
                yield from _emit(fold, fold.fold(table, blocks())).to_batches()
        return run

    def meet(questions: pa.Table, passages: pa.Table) -> pa.Table:
        if questions.num_rows == 0 or passages.num_rows == 0:
            return _emit(fold, fold.fold(questions.slice(0, 0), iter(())))
        block = (passages["passage_id"].to_numpy(), _matrix(passages["vector"]))
        return _emit(fold, fold.fold(questions, iter((block,))))

    return scan, meet


def score_blocks(questions: DataFrame, passages: DataFrame, fold, group: str | None = None,
                 broadcast_questions: int = BROADCAST_QUESTIONS,
                 question_block: int = QUESTION_BLOCK,
                 passage_block: int = PASSAGE_BLOCK) -> DataFrame:
    """Partial folds of all (question, passage) scores, several rows per question.

    ``questions``: question_id, vector and what the fold reads besides;
    ``passages``: passage_id, vector.  With ``group`` both sides also carry that
    column and only equal groups meet.
    """
    return _score_blocks(questions, passages, fold, group, broadcast_questions, question_block, passage_block)[0]


def _score_blocks(questions: DataFrame, passages: DataFrame, fold, group: str | None = None,
                  broadcast_questions: int = BROADCAST_QUESTIONS, question_block: int = QUESTION_BLOCK,
                  passage_block: int = PASSAGE_BLOCK) -> tuple[DataFrame, bool]:
    """The folds, and whether the questions were few."""
    scan, meet = _worker_functions(fold)
    if group is None:
        # Reads at most one row more than may be broadcast; long vectors also meet
        # the byte limit.
        head = questions.limit(broadcast_questions + 1).toArrow()
        if head.num_rows <= broadcast_questions and head.nbytes <= BROADCAST_BYTES:
            shared = questions.sparkSession.sparkContext.broadcast(head)
            return passages.select("passage_id", "vector").mapInArrow(scan(shared), fold.schema), True

    keys = [group] if group else []
    q_parts, p_parts = _parts(questions, keys, question_block), _parts(passages, keys, passage_block)
    sizes = _meet_sizes(q_parts, p_parts, keys)
    # New names for all columns: both sides may come from one table, and a cogroup mixes up columns they share.
    questions = questions.select(*[F.col(c).alias(c) for c in questions.columns])
    passages = passages.select(*[F.col(c).alias(c) for c in ("passage_id", "vector", *keys)])
    left = (
        _with_sizes(questions, sizes, keys)
        .withColumn("_q", F.pmod(F.xxhash64("question_id"), F.col("_qn")))
        .withColumn("_p", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_pn") - 1)))
        .drop("_qn", "_pn")
    )
    right = (
        _with_sizes(passages, sizes, keys)
        .withColumn("_p", F.pmod(F.xxhash64("passage_id"), F.col("_pn")))
        .withColumn("_q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_qn") - 1)))
        .drop("_qn", "_pn")
    )
    on = [*keys, "_q", "_p"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(meet, fold.schema), False


def few_questions(questions: DataFrame, most: int = BROADCAST_QUESTIONS) -> bool:
    """Whether the questions may be broadcast; reads at most one more than that."""
    head = questions.limit(most + 1).agg(F.count("*").alias("n"), F.sum(F.size("vector")).alias("size")).first()
    return head["n"] <= most and 8 * ((head["size"] or 0) + 3 * head["n"]) <= BROADCAST_BYTES


def _parts(rows: DataFrame, keys: list[str], block: int) -> DataFrame:
    """Blocks of ``block`` rows; more than MOST_PARTS only where they would pass LARGEST_BLOCK rows."""
    least = F.ceil(F.count("*") / max(block, LARGEST_BLOCK))
    return rows.groupBy(*keys).agg(
        F.greatest(least, F.least(F.ceil(F.count("*") / block), F.lit(MOST_PARTS))).alias("_n"))


def _meet_sizes(q_parts: DataFrame, p_parts: DataFrame, keys: list[str]) -> DataFrame:
    q, p = q_parts.withColumnRenamed("_n", "_qn"), p_parts.withColumnRenamed("_n", "_pn")
    if keys:
        return q.join(p, keys)
    return q.withColumn("_pn", p.select("_pn").scalar())


def _with_sizes(rows: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Block counts per group: one row per index cell, or a single row."""
    if keys:
        return rows.join(F.broadcast(sizes), keys)
    return (rows.withColumn("_qn", sizes.select("_qn").scalar())
            .withColumn("_pn", sizes.select("_pn").scalar()))


def rank_top(scored: DataFrame, k: int, few_questions: bool = True) -> DataFrame:
    """Global top ``k`` per question from partial results; adds ``rank``.

    Partial rows meet in two levels, by question and a hash of the passage first, so few
    questions with very many partial rows do not gather in few tasks.  The rank filters are
    planned as group limits on both sides of their exchanges.  Many questions with at most some rows
    of every block meet at once.
    """
    order = [F.desc("score"), "passage_id"]
    part = F.pmod(F.xxhash64("passage_id"), F.lit(MERGE_PARTS))
    near = Window.partitionBy("question_id", "_part").orderBy(*order)
    best = Window.partitionBy("question_id").orderBy(*order)
    if few_questions:
        scored = (scored.withColumn("_part", part).withColumn("_near", F.row_number().over(near))
                  .where(F.col("_near") <= k).drop("_part", "_near"))
    return (
        scored
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("question_id", "rank", "passage_id", "score")
    )


def top_passages(questions: DataFrame, passages: DataFrame, k: int, **layout) -> DataFrame:
    """Exact top ``k``: question_id, rank, passage_id, score."""
    return best_folded(questions, passages, TopK(k), **layout)


def best_folded(questions: DataFrame, passages: DataFrame, fold: TopK, **layout) -> DataFrame:
    """The best ``fold.k`` that a fold of the kind of TopK finds."""
    scored, few = _score_blocks(questions, passages, fold, **layout)
    return rank_top(scored, fold.k, few)


def merge_mass(partials: DataFrame) -> DataFrame:
    """One (question_id, log_sum, n, above) row per question.

    Sums combine before the exchange: the mass of every whole number of its peak is summed
    on its own, which leaves a few rows per question and task, then those are brought to the
    question's peak.  A part that saw no passage has peak -infinity and mass 0; a question
    without any negative gets a log_sum of -infinity.
    """
    level = F.when(F.col("mass") > 0, F.floor("peak")).alias("_level")
    steps = partials.groupBy("question_id", level).agg(
        F.sum(F.when(F.col("mass") > 0, F.col("mass") * F.exp(F.col("peak") - F.floor("peak")))).alias("_mass"),
        F.sum("n").alias("n"), F.sum("above").alias("above"))
    peak = F.max("_level").over(Window.partitionBy("question_id"))
    share = F.col("_mass") * F.exp((F.col("_level") - F.col("_peak")).cast("double"))
    return (
        steps.withColumn("_peak", peak)
        .groupBy("question_id")
        .agg(F.max("_peak").alias("_peak"), F.sum(share).alias("_total"), F.sum("n").alias("n"),
             F.sum("above").alias("above"))
        .select("question_id", F.coalesce(F.col("_peak") + F.log("_total"),
                                          F.lit(float("-inf"))).alias("log_sum"), "n", "above")
    )
