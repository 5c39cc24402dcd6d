"""One question set answered end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.ids import passage_id
from answerloom.operators import qa
from answerloom.operators.stored import written_once
from answerloom.plans.corpus import build_passages, pair_rows
from answerloom.plans.retrieve import retrieved_passages


def question_hits(articles: DataFrame, qa_rows: DataFrame, k: int) -> DataFrame:
    """question_id, rank, passage_id, title, text, score, is_gold."""
    passages = written_once(build_passages(articles))
    pairs = qa.assign_passage_ids(pair_rows(qa_rows, articles), passages)
    gold = pairs.select(
        F.col("qa_id").alias("question_id"), F.col("question").alias("text"),
        passage_id(F.col("passage_article_id"), F.col("passage_paragraph_id")).alias("gold_id"))
    found = retrieved_passages(gold.select("question_id", "text"), passages, k)
    return found.join(gold.select("question_id", "gold_id"), "question_id").select(
        "question_id", "rank", "passage_id", "title", "text", "score",
        (F.col("passage_id") == F.col("gold_id")).alias("is_gold"))
