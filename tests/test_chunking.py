import random
import re

import pytest
from pyspark.sql import functions as F

from answerloom.functions.text import canonical, canonical_offset, clean_newlines
from answerloom.operators import chunking


def chunk_texts(spark, text, **options):
    frame = spark.createDataFrame([(text,)], "x string")
    column = chunking.chunk_column(F.col("x"), **options)
    return [(c["start"], c["text"]) for c in frame.select(column).first()[0]]


def sentence(size):
    return "x" * (size - 1) + "."


def test_sizes(spark):
    assert chunk_texts(spark, "") == [(0, "")]
    assert [len(t) for _, t in chunk_texts(spark, "y" * 1000)] == [1000]
    assert [(s, len(t)) for s, t in chunk_texts(spark, "y" * 1000, hard_wrap=True)] == [
        (0, 470), (470, 470), (940, 60)]
    three = " ".join([sentence(235), sentence(234), "z"])
    assert [len(t) for _, t in chunk_texts(spark, three)] == [470, 1]
    assert [len(t) for _, t in chunk_texts(spark, f"{sentence(235)} {sentence(235)}")] == [235, 235]


def python_chunks(text, limit):
    flat = text
    for mark in ("\\n\\n", "\n\n", "\\n", "\n"):
        flat = flat.replace(mark, " ")
    parts = re.sub(r"([.!?])[\t\n\x0b\f\r ]+", "\\1\x1e", flat).split("\x1e")
    chunks, start = [], 0
    current = parts[0]
    for part in parts[1:]:
        if len(current) + 1 + len(part) <= limit:
            current += " " + part
        else:
            chunks.append((start, current))
            start += len(current) + 1
            current = part
    return chunks + [(start, current)]


def test_random_texts_match_the_rule_and_join_back(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice("ab😀é. !?\n") for _ in range(draw.randrange(1, 300)))
             for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, x string").repartition(5)
    got = frame.select("i", chunking.chunk_column(F.col("x"), 40).alias("c"),
                       canonical(F.col("x")).alias("canon")).collect()
    for row in got:
        chunks = [(c["start"], c["text"]) for c in row["c"]]
        assert chunks == python_chunks(texts[row["i"]], 40)
        assert " ".join(t for _, t in chunks) == row["canon"]


def test_cleaned_texts_are_not_cleaned_again(spark):
    """Written and real breaks in all mixtures; a cleaned text gives the same chunks, missing ones none."""
    draw = random.Random(4)
    texts = ["".join(draw.choice(["\\n", "\n", "\\", "n", ".", "é", " "]) for _ in range(draw.randrange(0, 200)))
             for _ in range(200)]
    frame = spark.createDataFrame([*enumerate(texts), (200, None)], "i int, x string")
    cleaned = clean_newlines(F.col("x"))
    got = frame.select("i", chunking.chunk_column(F.col("x"), 20).alias("c"), cleaned.alias("x")).select(
        "i", "c", chunking.chunk_column(F.col("x"), 20, cleaned=True).alias("again")).collect()
    for row in got:
        assert row["c"] == row["again"]
        assert row["i"] == 200 or [(c["start"], c["text"]) for c in row["c"]] == python_chunks(texts[row["i"]], 20)
    assert len(got) == 201 and got[200]["c"] is None
    plan = str(frame.select(chunking.chunk_column(F.col("x"), cleaned=True))._jdf.queryExecution().analyzed())
    assert "split(" in plan and "replace(" not in plan


def test_wrapped_pieces_keep_the_whole_text(spark):
    text = "".join(random.Random(4).choice("abc") for _ in range(5001))
    pieces = chunk_texts(spark, text, max_chars=100, hard_wrap=True)
    assert "".join(t for _, t in pieces) == text
    assert [s for s, _ in pieces] == list(range(0, 5001, 100))


def test_offset_moves_with_cleaning(spark):
    frame = spark.createDataFrame([("ab.\n\ncd", 5)], "x string, at int")
    assert frame.select(canonical_offset(F.col("x"), F.col("at"))).first()[0] == 4


@pytest.fixture
def cut(spark):
    return spark.createDataFrame(
        [(1, 0, 0, "a" * 9), (1, 1, 10, "b" * 9), (1, 2, 20, "c" * 9), (2, 0, 0, "d" * 2000)],
        "article_id long, paragraph_id int, start int, text string")


@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_locate(spark, rows, cut, hot_rows):
    asked = spark.createDataFrame(
        [(1, 1, 0), (2, 1, 9), (3, 1, 10), (4, 1, 25), (5, 1, 999), (6, 2, 1500), (7, 3, 0),
         (8, 1, None), (9, 1, -1)], "qa_id long, article_id long, offset int")
    got = chunking.locate_answers(asked, cut, hot_rows)
    assert rows(got, "qa_id", "paragraph_id") == [
        (1, 0), (2, 0), (3, 1), (4, 2), (5, 2), (6, 0), (7, None), (8, None), (9, None)]


def test_locate_wrapped_pieces(spark, rows):
    text = "y" * 1000
    articles = spark.createDataFrame([(1, "t", text)], "article_id long, title string, text string")
    cut = chunking.chunk_articles(articles, hard_wrap=True)
    asked = spark.createDataFrame([(i, 1, at) for i, at in enumerate((0, 469, 470, 939, 940, 999))],
                                  "qa_id long, article_id long, offset int")
    assert [r[1] for r in rows(chunking.locate_answers(asked, cut), "qa_id", "paragraph_id")] == [
        0, 0, 1, 1, 2, 2]


def test_chunk_qa_puts_the_question_on_the_answer_chunk(spark, rows):
    context = f"{sentence(300)}\n\n{sentence(300)} The answer."
    at = context.index("The answer")
    qa = spark.createDataFrame(
        [(1, 5, "t", context, "q?", "The answer", at), (2, 5, "t", context, "q2", "x", None)],
        "qa_id long, article_id long, title string, context string, question string, "
        "answer string, answer_start int")
    got = rows(chunking.chunk_qa(qa), "qa_id", "passage_label", "question", "answer")
    assert got == [(1, "5-0", None, None), (1, "5-1", "q?", "The answer"),
                   (2, "5-0", None, None), (2, "5-1", None, None)]
