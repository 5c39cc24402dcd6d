"""What contrastive training steps compute, as queries over stored vectors.

Pairs are (pair_id, question_vector, passage_vector); the passage of the same row
is the positive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.vectors import inner_product
from answerloom.operators.scoring import (
    SCORE_DIGITS, CountAbove, CountScaledAbove, NegativeMass, _matrix, merge_mass, score_blocks)

# Corpus vectors enter the negative queue scaled by this factor (fixed value), so
# a positive with a positive score beats its own copy among the negatives.
NEGATIVE_SCALE = 0.999
QUEUE_QUESTIONS, QUEUE_KEYS = 8192, 16_384


def _scored_gold(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("pair_id").alias("question_id"), F.col("question_vector").alias("vector"),
        F.round(inner_product(F.col("question_vector"), F.col("passage_vector")),
                SCORE_DIGITS).alias("gold_score"),
        F.col("pair_id").alias("gold_id"))


def gold_ranks(pairs: DataFrame, passages: DataFrame, **layout) -> DataFrame:
    """Rank of the gold passage: one plus the passages that beat it, no sort."""
    gold = _scored_gold(pairs)
    above = (
        score_blocks(gold, passages, CountAbove(), **layout)
        .groupBy("question_id").agg(F.sum("above").alias("_above"))
    )
    return gold.select("question_id", "gold_score").join(above, "question_id", "left").select(
        "question_id", "gold_score", (F.coalesce("_above", F.lit(0)) + 1).alias("gold_rank"))


def precision_at(ranks: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """One row per k: share of questions whose gold rank is at most k, in percent."""
    cells = ", ".join(f"{k}, p{k}" for k in ks)
    return (
        ranks.agg(*[(100 * F.avg((F.col("gold_rank") <= k).cast("int"))).alias(f"p{k}")
                    for k in ks])
        .selectExpr(f"stack({len(ks)}, {cells}) as (k, precision)")
    )


def corpus_loss(pairs: DataFrame, passages: DataFrame, temperature: float = 1.0,
                negative_scale: float = NEGATIVE_SCALE, **layout) -> DataFrame:
    """Cross-entropy of the positive against itself plus the whole scaled corpus.

    Per question: loss, n_negatives, and the rank of the positive among them, all
    from one pass over the blocks; no score is kept.
    """
    gold = _scored_gold(pairs)
    negatives = merge_mass(
        score_blocks(gold, passages, NegativeMass(negative_scale, temperature), **layout))
    return _losses(gold, negatives, temperature)


def corpus_ranks(pairs: DataFrame, passages: DataFrame, negative_scale: float = NEGATIVE_SCALE,
                 **layout) -> DataFrame:
    """Rank of the positive of ``corpus_loss`` alone: scores are counted, no exponential is taken."""
    gold = _scored_gold(pairs)
    above = score_blocks(gold, passages, CountScaledAbove(negative_scale), **layout).groupBy("question_id").agg(
        F.sum("above").alias("_above"))
    return gold.select("question_id").join(above, "question_id", "left").select(
        "question_id", (F.coalesce("_above", F.lit(0)) + 1).alias("positive_rank"))


def _losses(gold: DataFrame, negatives: DataFrame, temperature: float) -> DataFrame:
    """Loss, negatives and the positive's rank; a question without negatives keeps its row."""
    positive = F.col("gold_score") / temperature
    mass = F.coalesce("log_sum", F.lit(float("-inf")))
    high = F.greatest(positive, mass)
    log_total = high + F.log(F.exp(positive - high) + F.exp(mass - high))
    return (
        gold.select("question_id", "gold_score").join(negatives, "question_id", "left")
        .select("question_id", (log_total - positive).alias("loss"),
                F.coalesce("n", F.lit(0)).alias("n_negatives"),
                (F.coalesce("above", F.lit(0)) + 1).alias("positive_rank"))
    )


def in_batch_loss(pairs: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Mean NLL of the diagonal and in-batch accuracy, one row per ``batch_id``.

    A batch is a bounded group (the training batch size), handled as one matrix in
    one task; its score pairs never become rows.
    """
    def loss(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("pair_id")
        scores = np.round(_matrix(table["question_vector"]) @ _matrix(table["passage_vector"]).T,
                          SCORE_DIGITS) / temperature
        peak = scores.max(axis=1, keepdims=True)
        log_total = peak[:, 0] + np.log(np.exp(scores - peak).sum(axis=1))
        hits = scores.argmax(axis=1) == np.arange(len(scores))
        return pa.table({"batch_id": [key[0].as_py()], "n_pairs": [len(scores)],
                         "loss": [float((log_total - scores.diagonal()).mean())],
                         "accuracy": [float(hits.mean())]})

    return (
        pairs.select("batch_id", "pair_id", "question_vector", "passage_vector")
        .groupBy("batch_id")
        .applyInArrow(loss, "batch_id bigint, n_pairs bigint, loss double, accuracy double")
    )


def _check_queue(queue_size: int, batch_size: int) -> int:
    if queue_size % batch_size:
        raise ValueError("queue size must be a multiple of the batch size")
    return queue_size // batch_size


def queue_negatives(keys: DataFrame, queue_size: int, batch_size: int) -> DataFrame:
    """(batch_id, key_seq) for the last ``queue_size`` keys before each batch.

    ``keys`` has a dense 0-based ``seq``; batch b holds seq b*B .. b*B+B-1.  The
    queue moves by whole batches, so the look-back range is an equi-join between
    a key's batch and the batches that still see it, and needs no join at all:
    each key lists its consumers.
    """
    depth = _check_queue(queue_size, batch_size)
    last_batch = keys.select(F.floor(F.max("seq") / batch_size)).scalar()
    own = F.floor(F.col("seq") / batch_size).cast("bigint")
    return (
        keys.select(F.col("seq").alias("key_seq"), own.alias("_own"))
        .withColumn("_end", F.least(F.col("_own") + depth, last_batch))
        .where(F.col("_own") < F.col("_end"))
        .select(F.explode(F.sequence(F.col("_own") + 1, F.col("_end"))).alias("batch_id"),
                "key_seq")
    )


def queue_ranges(keys: DataFrame, queue_size: int, batch_size: int) -> DataFrame:
    """(batch_id, first_seq, last_seq): the same queues as ranges, one row per batch."""
    depth = _check_queue(queue_size, batch_size)
    own = F.floor(F.col("seq") / batch_size).cast("bigint")
    return (
        keys.select(own.alias("batch_id")).distinct().where(F.col("batch_id") > 0)
        .select("batch_id",
                F.greatest(F.lit(0), (F.col("batch_id") - depth) * batch_size).cast("bigint").alias("first_seq"),
                (F.col("batch_id") * batch_size - 1).alias("last_seq"))
    )


def queue_loss(pairs: DataFrame, queue_size: int, batch_size: int, temperature: float = 1.0,
               question_block: int = QUEUE_QUESTIONS, key_block: int = QUEUE_KEYS) -> DataFrame:
    """Per question: loss and rank of the positive against the queued keys.

    Questions and keys are cut into blocks of consecutive numbers; a block of questions
    meets the blocks of keys that one of its batches still sees.  A task holds one block of
    either kind, whatever the queue's size, and gives one partial sum per question.
    """
    depth = _check_queue(queue_size, batch_size)
    last_key = F.floor(F.lit(pairs.select(F.max("seq")).scalar()) / key_block)
    block = F.floor(F.col("seq") / question_block).cast("bigint")
    first = F.greatest(F.lit(0), (F.floor(block * question_block / batch_size) - depth) * batch_size)
    low = F.floor(first / key_block).cast("bigint")
    high = F.least(F.floor(((block + 1) * question_block - 1) / key_block), last_key).cast("bigint")
    gold = _scored_gold(pairs.withColumnRenamed("seq", "pair_id"))
    asked = gold.select("question_id", "vector", "gold_score", F.col("question_id").alias("seq")).withColumn(
        "_q", block).withColumn("_k", F.explode(F.sequence(low, high)))
    # A key is wanted by the question blocks that hold its own batch or one of the ``depth`` after it.
    own = F.floor(F.col("seq") / key_block).cast("bigint")
    top = F.least(F.floor(((own + 1) * key_block - 1 + queue_size + batch_size) / question_block),
                  F.floor(F.lit(pairs.select(F.max("seq")).scalar()) / question_block)).cast("bigint")
    stored = pairs.select("seq", F.col("passage_vector").alias("key_vector"), own.alias("_k")).withColumn(
        "_q", F.explode(F.sequence(F.floor(own * key_block / question_block).cast("bigint"), top)))
    fold = NegativeMass(temperature=temperature)

    def run(questions: pa.Table, keys: pa.Table) -> pa.Table:
        names = ["question_id", "peak", "mass", "n", "above"]
        if questions.num_rows == 0 or keys.num_rows == 0:
            return pa.table({n: pa.array([], t) for n, t in zip(names, [pa.int64(), pa.float64(), pa.float64(),
                                                                       pa.int64(), pa.int64()])})
        questions, keys = questions.sort_by("seq"), keys.sort_by("seq")
        seq, key_seq = questions["seq"].to_numpy(), keys["seq"].to_numpy()
        q, stored_ = _matrix(questions["vector"]), _matrix(keys["key_vector"])
        gold_ = questions["gold_score"].to_numpy()
        parts = []
        for batch in np.unique(seq // batch_size):
            rows = slice(*np.searchsorted(seq, [batch * batch_size, (batch + 1) * batch_size]))
            seen = slice(*np.searchsorted(key_seq, [(batch - depth) * batch_size, batch * batch_size]))
            blocks = [(key_seq[seen], stored_[seen])] if seen.stop > seen.start else []
            parts.append([questions["question_id"].to_numpy()[rows],
                          *fold.fold_arrays(q[rows], gold_[rows], blocks)])
        return pa.table({name: np.concatenate(c) for name, c in zip(names, zip(*parts))})

    partials = asked.groupBy("_q", "_k").cogroup(stored.groupBy("_q", "_k")).applyInArrow(run, NegativeMass.schema)
    return _losses(gold, merge_mass(partials), temperature).withColumnRenamed("question_id", "seq")
