"""Questions in, ranked passages out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.operators import embedding, retrieval, scoring
from answerloom.plans.corpus import input_words, passage_input


def dense_retrieval(questions: DataFrame, passages: DataFrame, k: int,
                    dimensions: int = embedding.DIMENSIONS) -> DataFrame:
    """question_id, rank, passage_id, score with the built-in encoder.

    ``passages`` may come from ``passage_words``, with a ``words`` column in place of the text.
    """
    asked = embedding.hashed_vectors(questions, "question_id", "text", dimensions)
    if "words" in passages.columns:
        stored = embedding.word_vectors(input_words(passages), "passage_id", "words", dimensions)
    else:
        stored = embedding.hashed_vectors(passage_input(passages), "passage_id", "text", dimensions)
    return scoring.top_passages(asked, stored, k)


def retrieved_passages(questions: DataFrame, passages: DataFrame, k: int) -> DataFrame:
    """Ranked passages with their title and text."""
    ranked = dense_retrieval(questions, passages, k)
    return retrieval.attach_passages(ranked, passages)


def answer_coverage(retrieved: DataFrame, answers: DataFrame, ks: tuple[int, ...]) -> DataFrame:
    """Share of questions with the gold passage text among the first k results."""
    hits = (
        retrieved.join(answers.withColumnRenamed("passage_id", "_gold"), "question_id", "right")
        .groupBy("question_id")
        .agg(F.min(F.when(F.col("passage_id") == F.col("_gold"), F.col("rank"))).alias("gold_rank"))
    )
    return hits.agg(F.count("*").alias("n_questions"), *[
        F.avg(F.coalesce((F.col("gold_rank") <= k).cast("int"), F.lit(0))).alias(f"top_{k}")
        for k in ks])
