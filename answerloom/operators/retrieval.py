"""From ranked ids back to texts, prompts, exports."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.text import context_prompt
from answerloom.functions.vectors import inner_product
from answerloom.operators.held import (
    BLOCK_ROWS, LARGEST_BLOCK, block_count, element_type, emitted, packed, past_held, unpacked)
from answerloom.operators.scoring import PAIRS_HELD as PAIRS_SCORED
from answerloom.operators.scoring import SCORE_DIGITS, BestK, TopK, _matrix, rank_top
from answerloom.operators.skew import BROADCAST_ROWS, HOT_ROWS, fits, skew_join
from answerloom.operators.stored import written_once


def attach_passages(ranked: DataFrame, passages: DataFrame,
                    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add title and text.

    The ranked rows are stored; while they fit they are broadcast and the texts are
    only scanned.  Beyond that the sides are shuffled, and a passage found for very
    many questions is dealt out.
    """
    ranked = written_once(ranked)
    texts = passages.select("passage_id", "title", "text")
    if fits(ranked, broadcast_rows):
        joined = texts.join(F.broadcast(ranked), "passage_id")
    else:
        joined = skew_join(ranked, texts, ["passage_id"], "inner", F.col("question_id"), hot_rows)
    return joined.select("passage_id", "title", "text", *[c for c in ranked.columns if c != "passage_id"])


def rescore(found: DataFrame, questions: DataFrame, passages: DataFrame, k: int,
            **sizes: int) -> DataFrame:
    """Exact scores of returned (question_id, passage_id) pairs, ranked anew.

    ``questions`` and ``passages`` carry a ``vector``.  Only ids and vectors move.  The pairs are
    stored, because the search for hot passages and the join would both run the search again.
    """
    pairs = written_once(found.select("question_id", "passage_id")).distinct()
    asked = questions.select("question_id", F.col("vector").alias("_q"))
    stored = passages.select("passage_id", F.col("vector").alias("_p"))
    with_p = skew_join(pairs, stored, ["passage_id"], "inner", F.col("question_id"), **sizes)
    both = with_p.join(asked, "question_id")
    return rank_top(both.select("question_id", "passage_id", F.round(
        inner_product(F.col("_q"), F.col("_p")), SCORE_DIGITS).alias("score")), k)


def rescore_held(found: DataFrame, questions: DataFrame, passages: DataFrame, k: int, n: int,
                 question_block: int = BLOCK_ROWS) -> DataFrame:
    """``rescore`` for very many questions with at most ``n`` passages each.

    Blocks of questions are held with their lists of ids while the vectors of all passages stream past, so vectors are
    repeated once for each block and not once for each pair.
    """
    listed = found.groupBy("question_id").agg(F.collect_set("passage_id").alias("wanted"))
    held = written_once(questions.select("question_id", F.col("vector").cast("array<double>").alias("vector")).join(
        listed, "question_id"))

    def run(table: pa.Table, batches):
        wanted = table["wanted"].combine_chunks()
        ids, owner = wanted.flatten().to_numpy(), np.repeat(np.arange(len(wanted)), wanted.value_lengths().to_numpy())
        order = np.argsort(ids, kind="stable")
        ids, owner, asked = ids[order], owner[order], _matrix(table["vector"])
        best = BestK(len(asked), k)
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            low, high = np.searchsorted(ids, names, "left"), np.searchsorted(ids, names, "right")
            row = np.repeat(np.arange(len(names)), high - low)
            if len(row):
                pair = np.arange(len(row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[row]
                vectors, score = unpacked(batch.column(1), kind).astype(np.float64), np.empty(len(row))
                for at in range(0, len(row), PAIRS_SCORED):
                    part = slice(at, at + PAIRS_SCORED)
                    score[part] = np.einsum("ij,ij->i", asked[owner[pair[part]]], vectors[row[part]])
                best.add_cells(owner[pair], names[row], np.round(score, SCORE_DIGITS))
        yield from emitted(pa.table({"question_id": table["question_id"].combine_chunks().take(pa.array(best.row)),
                                     "passage_id": best.pid, "score": best.score}))

    blocks = block_count(held.count(), n, question_block, 2 * LARGEST_BLOCK)
    stored = passages.where("passage_id is not null").select(
        F.col("passage_id").cast("bigint").alias("passage_id"), F.col("vector").alias("known"))
    kind = element_type(stored, "known")
    return rank_top(written_once(past_held(held, packed(stored, "known"), run, TopK.schema, blocks)), k, False)


def context_prompts(retrieved: DataFrame, questions: DataFrame) -> DataFrame:
    """One generator prompt per retrieved passage."""
    asked = questions.select("question_id", F.col("text").alias("question"))
    return retrieved.join(asked, "question_id").select(
        "question_id", "rank", "passage_id",
        context_prompt(F.col("title"), F.col("text"), F.col("question")).alias("prompt"))


def export_lists(retrieved: DataFrame) -> DataFrame:
    """One row per question: parallel lists of texts and scores in rank order.

    Lists are as long as the retrieval depth.
    """
    hits = F.array_sort(F.collect_list(F.struct("rank", "text", "score")))
    return (
        retrieved.groupBy("question_id").agg(hits.alias("_hits"))
        .select("question_id", F.col("_hits.text").alias("texts"),
                F.col("_hits.score").alias("scores"))
    )


def prediction_lines(predictions: DataFrame) -> DataFrame:
    """One JSON object per line, non-ASCII characters kept as they are."""
    return predictions.select(
        F.to_json(F.struct(F.col("id").cast("string").alias("id"), "answer")).alias("line"))
