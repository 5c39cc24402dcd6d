"""Question/answer tables: id repair, passage ids, splits, quality."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from answerloom.functions.ids import article_of, content_key, paragraph_of, passage_id
from answerloom.operators.skew import BROADCAST_ROWS, HOT_ROWS, lookup
from answerloom.operators.stored import shared_folder

# Largest article id of the encyclopedia part of the corpus (fixed value).
WIKI_LAST_ARTICLE = 56736


def below_threshold(rows: DataFrame, id_col: str, last_id: int = WIKI_LAST_ARTICLE) -> DataFrame:
    return rows.where(F.col(id_col) <= last_id)


def above_threshold(rows: DataFrame, id_col: str, last_id: int = WIKI_LAST_ARTICLE) -> DataFrame:
    return rows.where(F.col(id_col) > last_id)


def has_question(rows: DataFrame) -> DataFrame:
    """Empty string and NULL both mean "no question"."""
    return rows.where(F.coalesce("question", F.lit("")) != "")


def _by_content(rows: DataFrame, title: str, text: str) -> DataFrame:
    return rows.withColumn("_key", content_key(F.col(title), F.col(text)))


def repair_article_ids(qa: DataFrame, articles: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Look the article id up by (title, context); ``article_id`` is NULL on a miss.

    Inner-join semantics are one ``where(article_id is not null)`` away, the miss
    report is the complement.
    """
    known = (
        _by_content(articles, "title", "text")
        .groupBy("_key").agg(F.min("article_id").alias("article_id"))
    )
    return lookup(_by_content(qa, "title", "context"), known, ["_key"], "left", F.col("qa_id"),
                  broadcast_rows, hot_rows).drop("_key")


def missed(repaired: DataFrame) -> DataFrame:
    """The miss report: rows for which no article was found."""
    return repaired.where(F.col("article_id").isNull())


def assign_passage_ids(pairs: DataFrame, passages: DataFrame, broadcast_rows: int = BROADCAST_ROWS,
                       hot_rows: int = HOT_ROWS) -> DataFrame:
    """Give each QA row the smallest passage with its (title, text); NULL on a miss."""
    known = (
        _by_content(passages, "title", "text")
        .withColumn("_id", passage_id(F.col("article_id"), F.col("paragraph_id")))
        .groupBy("_key").agg(F.min("_id").alias("_id"))
    )
    found = lookup(_by_content(pairs, "title", "text"), known, ["_key"], "left", F.col("qa_id"),
                   broadcast_rows, hot_rows)
    return (
        found.withColumn("passage_article_id", article_of(F.col("_id")))
        .withColumn("passage_paragraph_id", paragraph_of(F.col("_id")))
        .drop("_key", "_id")
    )


def strict(rows: DataFrame, id_col: str) -> DataFrame:
    """Fail the job on the first unmatched row instead of passing a NULL id on."""
    return rows.withColumn(id_col, F.when(F.col(id_col).isNull(), F.raise_error(
        F.lit(f"no match for {id_col}"))).otherwise(F.col(id_col)))


def _question_key(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_key", content_key(F.col("question")))


def _held_out(qa: DataFrame, validation: DataFrame, how: str, spread: str, broadcast_rows: int,
              hot_rows: int) -> DataFrame:
    keys = _question_key(validation.select("question")).select("_key").distinct()
    return lookup(_question_key(qa), keys, ["_key"], how, F.col(spread), broadcast_rows,
                  hot_rows).drop("_key")


def train_rows(qa: DataFrame, validation: DataFrame, spread: str,
               broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose question is not a validation question."""
    return _held_out(qa, validation, "left_anti", spread, broadcast_rows, hot_rows)


def validation_rows(qa: DataFrame, validation: DataFrame, spread: str,
                    broadcast_rows: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose question is a validation question."""
    return _held_out(qa, validation, "left_semi", spread, broadcast_rows, hot_rows)


def passages_without_question(passages: DataFrame, pairs: DataFrame,
                              broadcast_rows: int = BROADCAST_ROWS,
                              hot_rows: int = HOT_ROWS) -> DataFrame:
    """Passages (with a ``passage_id``) whose (title, text) has no question anywhere."""
    asked = _by_content(has_question(pairs), "title", "text").select("_key").distinct()
    return lookup(_by_content(passages, "title", "text"), asked, ["_key"], "left_anti",
                  F.col("passage_id"), broadcast_rows, hot_rows).drop("_key")


def quality_report(qa: DataFrame) -> DataFrame:
    """How many rows lack a question or an answer."""
    no_question = F.coalesce("question", F.lit("")) == ""
    no_answer = F.coalesce("answer", F.lit("")) == ""
    return qa.agg(
        F.count("*").alias("n_rows"),
        F.count_if(no_question).alias("n_no_question"),
        F.count_if(no_answer).alias("n_no_answer"),
        F.count_if(~no_question & ~no_answer).alias("n_usable"),
    )


def require_complete(qa: DataFrame) -> DataFrame:
    """Fail the job on a row with an empty question or answer."""
    empty = (F.coalesce("question", F.lit("")) == "") | (F.coalesce("answer", F.lit("")) == "")
    return qa.withColumn("question", F.when(empty, F.raise_error(
        F.lit("empty question or answer"))).otherwise(F.col("question")))


# What makes a question row unfit for training.
COMPLETE = {"no question": "coalesce(question, '') = ''", "no answer": "coalesce(answer, '') = ''"}


def quarantine(rows: DataFrame, rules: dict[str, Column | str] | None = None,
               path: str | None = None) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Accepted rows, refused rows with their ``reasons``, and counts by reason (also "rows" and "accepted").

    A row is refused for every rule that is true for it; a rule that gives NULL does not refuse.  Rows are scanned
    once: the write that parts accepted from refused rows into two folders of one table also
    carries the counts, so they are those of the rows written.  ``path`` names the table's
    folder, by default one in the shared folder.
    """
    rules = COMPLETE if rules is None else rules
    spark = rows.sparkSession
    path = path or f"{shared_folder(spark)}/quarantine-{uuid.uuid4().hex}"
    hit = {name: F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False)) for name, rule in rules.items()}
    reasons = F.filter(F.array(*[F.when(h, F.lit(name)) for name, h in hit.items()]), lambda r: r.isNotNull())
    observation = Observation(f"quarantine {uuid.uuid4().hex}")
    judged = rows.withColumn("reasons", reasons).withColumn("refused", F.size("reasons") > 0)
    counted = judged.observe(
        observation, F.count("*").alias("rows"), F.count_if(~F.col("refused")).alias("accepted"),
        *[F.count_if(F.array_contains("reasons", name)).alias(name) for name in rules])
    counted.write.mode("overwrite").partitionBy("refused").parquet(path)
    stored = spark.read.schema(judged.schema).parquet(path)
    accepted = stored.where(~F.col("refused")).drop("reasons", "refused")
    return accepted, stored.where("refused").drop("refused"), {k: int(v or 0) for k, v in observation.get.items()}
