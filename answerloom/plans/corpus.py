"""Article dump to passage table, and question/answer rows to training tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.ids import passage_id
from answerloom.functions.text import clean_newlines, decorate_title, words
from answerloom.operators import chunking, dedup, qa
from answerloom.operators.skew import use_all_cores
from answerloom.sources.tables import write_splits, write_table


def clean_articles(articles: DataFrame) -> DataFrame:
    """Cleaned text, one row per distinct (title, text)."""
    cleaned = use_all_cores(articles, "article_id").withColumn(
        "text", clean_newlines(F.col("text")))
    return dedup.dedup_articles(cleaned)


def build_passages(articles: DataFrame, max_chars: int = chunking.MAX_CHARS,
                   hard_wrap: bool = False) -> DataFrame:
    """Distinct passages with a packed ``passage_id``."""
    passages = chunking.chunk_articles(clean_articles(articles), max_chars, hard_wrap, cleaned=True)
    return dedup.dedup_passages(passages).withColumn(
        "passage_id", passage_id(F.col("article_id"), F.col("paragraph_id")))


def passage_input(passages: DataFrame) -> DataFrame:
    """passage_id and the text an encoder sees: decorated title, then the passage."""
    return passages.select("passage_id", F.concat(decorate_title(F.col("title")), F.col("text"))
                           .alias("text"))


def passage_words(passages: DataFrame) -> DataFrame:
    """passage_id, title and the words of the text, for plans that read the words several times."""
    return passages.select("passage_id", "title", words(F.col("text")).alias("words"))


def input_words(passages: DataFrame) -> DataFrame:
    """passage_id and the words of ``passage_input``, from ``passage_words``: no word goes over the title's tag."""
    return passages.select("passage_id", F.concat(words(decorate_title(F.col("title"))), F.col("words"))
                           .alias("words"))


def pair_rows(qa_rows: DataFrame, articles: DataFrame) -> DataFrame:
    """QA rows with repaired article ids, cut to the passage holding the answer.

    Rows whose context is in no article are left out here; they are the NULL ids
    of ``repair_article_ids``.
    """
    repaired = qa.repair_article_ids(qa_rows.drop("article_id"), articles)
    return qa.has_question(chunking.chunk_qa(repaired.where(F.col("article_id").isNotNull())))


def write_corpus(spark: SparkSession, articles: DataFrame, qa_rows: DataFrame,
                 validation: DataFrame, out: str) -> None:
    """The whole corpus build; stages with several readers are written once."""
    write_table(clean_articles(articles), f"{out}/articles")
    kept = spark.read.parquet(f"{out}/articles")
    passages = dedup.dedup_passages(chunking.chunk_articles(kept, cleaned=True)).withColumn(
        "passage_id", passage_id(F.col("article_id"), F.col("paragraph_id")))
    write_table(passages, f"{out}/passages")
    cleaned_qa = qa_rows.withColumn("raw_context", F.col("context")).withColumn(
        "context", clean_newlines(F.col("context")))
    repaired = (
        qa.repair_article_ids(cleaned_qa.drop("article_id"), kept)
        .where(F.col("article_id").isNotNull())
        .withColumn("context", F.col("raw_context")).drop("raw_context")
    )
    pairs = qa.assign_passage_ids(qa.has_question(chunking.chunk_qa(repaired)),
                                  spark.read.parquet(f"{out}/passages"))
    write_table(pairs, f"{out}/pairs")
    stored = spark.read.parquet(f"{out}/pairs")
    write_splits({"train": qa.train_rows(stored, validation, "qa_id"),
                  "test": qa.validation_rows(stored, validation, "qa_id")}, f"{out}/splits")
