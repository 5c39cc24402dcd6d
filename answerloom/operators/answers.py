"""Scoring of predicted answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from answerloom.functions.text import answer_tokens, normalize_answer


def exact_match(rows: DataFrame) -> DataFrame:
    """Add ``exact_match`` (0/1): equality after normalisation; two empty texts match."""
    same = normalize_answer(F.col("prediction")) == normalize_answer(F.col("gold"))
    return rows.withColumn("exact_match", same.cast("int"))


def token_f1(rows: DataFrame, ids: list[str]) -> DataFrame:
    """(ids, n_same, n_prediction, n_gold, f1) with repeated tokens counted.

    ``ids`` identify a row, and may hold further columns that depend on them.  Rows are
    hashed by them once; token counts of both sides are then grouped in place.  No overlap
    gives 0, two empty texts too.
    """
    def tagged(name: str, prediction: int, gold: int):
        return F.transform(answer_tokens(F.coalesce(name, F.lit(""))), lambda t: F.struct(
            t.alias("token"), F.lit(prediction).alias("p"), F.lit(gold).alias("g")))

    tokens = (
        rows.select(*ids, "prediction", "gold").repartition(*ids)
        .select(*ids, F.explode_outer(F.concat(tagged("prediction", 1, 0), tagged("gold", 0, 1)))
                .alias("_t"))
    )
    sides = tokens.groupBy(*ids, F.col("_t.token").alias("_token")).agg(
        F.sum("_t.p").alias("_p"), F.sum("_t.g").alias("_g"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias
    counted = sides.groupBy(*ids).agg(
        total(F.least("_p", "_g"))("n_same"), total(F.col("_p"))("n_prediction"),
        total(F.col("_g"))("n_gold"))
    precision, recall = F.col("n_same") / F.col("n_prediction"), F.col("n_same") / F.col("n_gold")
    return counted.withColumn("f1", F.when(F.col("n_same") > 0, 2 * precision * recall
                                           / (precision + recall)).otherwise(0.0))


def corpus_exact_match(rows: DataFrame) -> DataFrame:
    """Share of exact matches; 0 for an empty table."""
    return exact_match(rows).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.avg("exact_match"), F.lit(0.0)).alias("em"))


def squad_scores(rows: DataFrame, id_col: str, gold_no: str) -> DataFrame:
    """Corpus EM and F1 in percent, best gold answer per question."""
    scored = token_f1(exact_match(rows), [id_col, gold_no, "exact_match"])
    best = scored.groupBy(id_col).agg(F.max("exact_match").alias("em"), F.max("f1").alias("f1"))
    return best.agg(F.count("*").alias("n_questions"),
                    (100 * F.coalesce(F.avg("em"), F.lit(0.0))).alias("exact_match"),
                    (100 * F.coalesce(F.avg("f1"), F.lit(0.0))).alias("f1"))


def marginalize_answers(rows: DataFrame) -> DataFrame:
    """Best answer per question under p(y) = sum over passages of p(z) p(y given z).

    Input: question_id, passage_id, doc_score, answer, logprob, at most one row per
    (question, passage, answer); p(z) is the softmax of doc_score over the
    question's passages, each counted once.  Groups are one question's retrieved
    passages.  Ties go to the smaller answer text.
    """
    question = Window.partitionBy("question_id")
    first = Window.partitionBy("question_id", "passage_id").orderBy("answer")
    weighted = (
        rows.withColumn("_peak", F.max("doc_score").over(question))
        .withColumn("_once", F.row_number().over(first) == 1)
        .withColumn("_mass", F.sum(F.when(F.col("_once"), F.exp(F.col("doc_score") - F.col("_peak")))
                                   ).over(question))
        .withColumn("_joint", F.col("doc_score") - F.col("_peak") - F.log("_mass")
                    + F.col("logprob"))
    )
    answer = Window.partitionBy("question_id", "answer")
    per_answer = (
        weighted.withColumn("_top", F.max("_joint").over(answer))
        .groupBy("question_id", "answer")
        .agg((F.max("_top") + F.log(F.sum(F.exp(F.col("_joint") - F.col("_top"))))).alias("logprob"))
        .withColumn("logprob", F.round("logprob", 9))
    )
    best = Window.partitionBy("question_id").orderBy(F.desc("logprob"), "answer")
    return (
        per_answer.withColumn("_rank", F.row_number().over(best))
        .where(F.col("_rank") == 1).drop("_rank")
    )
