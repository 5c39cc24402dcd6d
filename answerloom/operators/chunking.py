"""Cut articles into sentence-aligned passages and place answers in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.ids import passage_label
from answerloom.functions.text import canonical_offset, sentences
from answerloom.operators.skew import HOT_ROWS, computed_once, skew_join

MAX_CHARS = 470
# Offsets are bucketed by this width so that the interval join has an equi-key;
# a passage of up to MAX_CHARS touches at most two buckets.
BIN_CHARS = 512


def chunk_column(text: Column, max_chars: int = MAX_CHARS, hard_wrap: bool = False,
                 cleaned: bool = False) -> Column:
    """array<struct<start,text>>: sentences packed greedily up to ``max_chars``.

    A sentence longer than the limit is a chunk of its own; ``hard_wrap`` then
    cuts it every ``max_chars`` characters.  Starts are offsets in the canonical
    text.  Empty text gives one empty chunk, NULL gives NULL.  Only lengths are
    added up sentence by sentence; texts are joined once per chunk.
    """
    empty = F.expr("cast(array() as array<struct<end:int,start:int>>)")
    zero = F.struct(empty.alias("done"), F.lit(0).alias("start"), F.lit(0).alias("at"), F.lit(0).alias("n"))

    def flushed(acc: Column) -> Column:
        return F.concat(acc["done"], F.array(F.struct(acc["n"].alias("end"), acc["start"].alias("start"))))

    def step(acc: Column, sentence: Column) -> Column:
        # ``at`` is where the sentence starts, one behind the end of the chunk so far.
        room = (acc["n"] == 0) | (acc["at"] - acc["start"] + F.length(sentence) <= max_chars)
        seen = ((acc["at"] + F.length(sentence) + 1).alias("at"), (acc["n"] + 1).alias("n"))
        return F.when(room, F.struct(acc["done"].alias("done"), acc["start"].alias("start"), *seen)).otherwise(
            F.struct(flushed(acc).alias("done"), acc["at"].alias("start"), *seen))

    def joined(parts: Column) -> Column:
        def packed(ends: Column) -> Column:
            def chunk(end: Column, i: Column) -> Column:
                first = F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)["end"])
                return F.struct(end["start"].alias("start"), F.array_join(
                    F.slice(parts, first + 1, end["end"] - first), " ").alias("text"))
            return F.transform(ends, chunk)
        return _bound(F.aggregate(parts, zero, step, flushed), packed)

    chunks = _bound(sentences(text, cleaned), joined)
    if not hard_wrap:
        return chunks
    piece = F.lit("(?s).{1,%d}" % max_chars)

    def wrap(chunk: Column) -> Column:
        pieces = F.regexp_extract_all(chunk["text"], piece, F.lit(0))
        return F.when(F.length(chunk["text"]) <= max_chars, F.array(chunk)).otherwise(
            F.transform(pieces, lambda p, i: F.struct(
                (chunk["start"] + i * max_chars).alias("start"), p.alias("text"))))

    return F.flatten(F.transform(chunks, wrap))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def chunk_articles(articles: DataFrame, max_chars: int = MAX_CHARS,
                   hard_wrap: bool = False, cleaned: bool = False) -> DataFrame:
    """One row per passage: article_id, paragraph_id, title, start, text."""
    return (
        articles
        .select("article_id", "title",
                F.posexplode(chunk_column(F.col("text"), max_chars, hard_wrap, cleaned))
                .alias("paragraph_id", "_chunk"))
        .select("article_id", "paragraph_id", "title",
                F.col("_chunk.start").alias("start"), F.col("_chunk.text").alias("text"))
    )


def chunk_qa(qa: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """Chunk each QA context; only the chunk holding the answer keeps the question.

    Expects qa_id, article_id, title, context, question, answer, answer_start.
    An offset in front of the first chunk cannot occur (the first chunk starts at
    0) unless ``answer_start`` is negative or NULL; such rows keep all chunks and
    attach the question to none of them.
    """
    offset = canonical_offset(F.col("context"), F.col("answer_start"))
    located = F.size(F.filter("_chunks", lambda c: c["start"] <= F.col("_offset"))) - 1
    hit = F.col("paragraph_id") == F.col("_hit")
    return (
        computed_once(qa, "_chunks", chunk_column(F.col("context"), max_chars))
        .withColumn("_offset", F.when(F.col("answer_start") >= 0, offset))
        .withColumn("_hit", F.when(F.col("_offset").isNotNull(), located))
        .select("qa_id", "article_id", "title", "question", "answer", "_hit",
                F.posexplode("_chunks").alias("paragraph_id", "_chunk"))
        .select("qa_id", "article_id", "paragraph_id",
                passage_label(F.col("article_id"), F.col("paragraph_id")).alias("passage_label"),
                "title", F.col("_chunk.text").alias("text"),
                F.when(hit, F.col("question")).alias("question"),
                F.when(hit, F.col("answer")).alias("answer"))
    )


def locate_answers(answers: DataFrame, passages: DataFrame,
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """Passage whose ``[start, start of the next)`` holds each answer offset.

    ``answers`` has qa_id, article_id, offset (canonical); ``passages`` has
    article_id, paragraph_id, start, text.  Both sides meet on (article, offset
    bucket), so a long article never multiplies with all its answers; offsets
    beyond the article's last chunk belong to that chunk.  Answers whose article
    is unknown, or with a negative offset, come back with a NULL paragraph.
    """
    last = passages.groupBy("article_id").agg(F.max("start").alias("last_start"))
    clipped = (
        skew_join(answers, last, ["article_id"], "left", F.col("qa_id"), hot_rows)
        .withColumn("_at", F.when(F.col("offset").isNotNull(), F.least("offset", "last_start")))
        .withColumn("_bin", F.floor(F.col("_at") / BIN_CHARS).cast("bigint"))
    )
    reach = F.greatest(F.length("text"), F.lit(0))
    spans = passages.select(
        "article_id", "paragraph_id", "start", (F.col("start") + reach).alias("_end"),
        F.explode(F.sequence(F.floor(F.col("start") / BIN_CHARS),
                             F.floor((F.col("start") + reach) / BIN_CHARS))).alias("_bin"))
    placed = skew_join(clipped, spans, ["article_id", "_bin"], "inner", F.col("qa_id"), hot_rows)
    # A hard-wrapped piece ends where the next one starts, other chunks end one
    # space earlier: of two candidates the later start is the right one.
    placed = (
        placed.where((F.col("_at") >= F.col("start")) & (F.col("_at") <= F.col("_end")))
        .groupBy("qa_id").agg(F.max("paragraph_id").alias("paragraph_id"))
    )
    return answers.join(placed, "qa_id", "left")
