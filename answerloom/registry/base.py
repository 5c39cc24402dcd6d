"""The query table and the inputs the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.ids import hash_number, in_test_split
from answerloom.functions.text import BREAK
from answerloom.operators.skew import use_all_cores
from answerloom.operators.stored import written_once
from answerloom.plans.corpus import build_passages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

VALIDATION_SEED, VALIDATION_SHARE = 1, 0.1
# Turns a packed dialogue id can tell apart; longer conversations are refused, not mixed up.
DIALOG_TURNS = 1_000_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL when there is one."""
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("article_id"), F.col("lang").alias("title"), "text")


def wide_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return use_all_cores(articles(spark, sf_dir), "article_id")


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_passages(articles(spark, sf_dir))


def passage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same passages, written once for queries that read them several times."""
    return written_once(passages(spark, sf_dir))


def qa_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per document: its first sentence asks for a middle sentence."""
    parts = F.split("text", "(?<=[.!?])" + BREAK, -1)
    answer = F.get("_parts", F.floor(F.size("_parts") / 2).cast("int"))
    return (
        wide_articles(spark, sf_dir).withColumn("_parts", parts).withColumn("answer", answer)
        .select(F.col("article_id").alias("qa_id"), "article_id", "title",
                F.col("text").alias("context"), F.get("_parts", F.lit(0)).alias("question"),
                "answer", F.when(F.col("answer") != "",
                                 F.position(F.col("answer"), F.col("text")) - 1)
                .alias("answer_start"))
    )


def dialogues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it; (conv_id, turn) is unique."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("question"))
    said = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    packed = F.when(F.col("turn") < DIALOG_TURNS, F.col("conv_id") * DIALOG_TURNS + F.col("turn")).otherwise(
        F.raise_error(F.lit("a conversation is too long for packed ids")).cast("bigint"))
    return asked.join(said, ["conv_id", "turn"]).withColumn("dialog_id", packed)


def validation_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(spark, sf_dir).where(
        in_test_split(VALIDATION_SHARE, VALIDATION_SEED, F.col("conv_id"))).select(
        "question").distinct()


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the predictions repeat the answer in other clothes, half the question."""
    repeats = hash_number(3, F.col("dialog_id")) % 2 == 0
    return dialogues(spark, sf_dir).select(
        "dialog_id", "question", F.col("answer").alias("gold"),
        F.when(repeats, F.concat(F.lit("The "), F.col("answer"), F.lit(" !")))
        .otherwise(F.col("question")).alias("prediction"))


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("question_id"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("passage_id"), F.col("embedding").alias("vector"), "label")


def vector_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passage i is vector i, question i the sum of the vectors i .. i+6 (cyclic)."""
    stored = vectors(spark, sf_dir)
    n = stored.select(F.max("passage_id") + 1).scalar()
    shares = (
        stored.withColumn("_n", n)
        .select(F.col("vector").cast("array<double>").alias("v"), "passage_id", "_n",
                F.explode(F.sequence(F.lit(0), F.lit(6))).alias("o"))
        .select(F.pmod(F.col("passage_id") - F.col("o"), F.col("_n")).alias("pair_id"), "o", "v")
    )
    start = F.transform(F.col("_s")[0]["v"], lambda x: F.lit(0.0))
    summed = F.aggregate("_s", start, lambda acc, s: F.zip_with(acc, s["v"], lambda a, b: a + b))
    questions = (
        shares.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("o", "v"))).alias("_s"))
        .select("pair_id", summed.alias("question_vector"))
    )
    return questions.join(
        stored.select(F.col("passage_id").alias("pair_id"),
                      F.col("vector").cast("array<double>").alias("passage_vector")), "pair_id")


def vector_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_pairs(spark, sf_dir).select(
        F.col("pair_id").alias("question_id"), F.col("question_vector").alias("vector"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means of the event values as the history of five metrics."""
    epoch = F.date_diff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("name"), epoch.alias("epoch"))
        .agg(F.avg("value").alias("value"))
        .select(F.lit("main").alias("run"), "name", "epoch", F.round("value", 9).alias("value"))
    )
