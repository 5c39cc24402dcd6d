"""Sentence borders learned from texts with abbreviations."""

import pytest
from pyspark.sql import functions as F

from answerloom.operators.sentences import _outer_word, neighbours, sentence_model, trained_sentences

NAMES = ["Smith", "Jones", "Miller", "Brown", "Clark", "Lewis", "Young", "Hall"]
FILL = ["walked", "home", "quickly", "yesterday", "morning", "garden", "letter", "window", "river", "market"]


def corpus():
    texts = []
    for i in range(240):
        a, b, c = NAMES[i % 8], FILL[i % 10], FILL[(i * 7 + 3) % 10]
        texts.append((i, f"The doctor saw Dr. {a} near the {b}. The {c} was bought by e.g. {NAMES[(i + 3) % 8]} for Mrs. {a}. "
                         f"The {b} of the {c} is old! Was it the {c}? The end came with the {b}."))
    return texts


@pytest.fixture(scope="module")
def model(spark):
    return sentence_model(spark.createDataFrame(corpus(), "doc_id bigint, text string")).cache()


def test_model(model):
    found = {}
    for r in model.collect():
        found.setdefault(r["kind"], set()).add((r["word"], r["next"]))
    assert {w for w, _ in found["abbreviation"]} == {"dr", "e.g", "mrs"}
    assert ("the", "") in found["starter"]
    assert not {w for w, _ in found["abbreviation"]} & set(FILL)


def test_borders(spark, model):
    rows = [(1, "He met Dr. Smith. The river rose."), (2, "It is e.g. Jones. The garden! Is it?\nYes."), (3, "Plain text. The end."),
            (4, None), (5, ""), (1, "Mrs.  Hall came."), (None, "By Dr. Hall and Mrs. Lewis. The market."), (6, "...  .")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, row string")
    got = sorted(((r["doc_id"], r["sentences"]) for r in trained_sentences(frame, model, "doc_id").collect()), key=repr)
    assert got == sorted([
        (1, ["He met Dr. Smith.", "The river rose."]), (2, ["It is e.g. Jones.", "The garden!", "Is it?", "Yes."]),
        (3, ["Plain text.", "The end."]), (4, None), (5, [""]), (1, ["Mrs. Hall came."]),
        (None, ["By Dr. Hall and Mrs. Lewis.", "The market."]), (6, ["...", "."])], key=repr)


def test_a_starter_ends_a_sentence_behind_an_abbreviation(spark, model):
    frame = spark.createDataFrame([(1, "He saw the Dr. The river rose.")], "doc_id bigint, text string")
    assert trained_sentences(frame, model, "doc_id").first()["sentences"] == ["He saw the Dr.", "The river rose."]


def test_without_texts(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id bigint, text string")
    nothing = sentence_model(frame)
    assert nothing.count() == 0 and sentence_model(frame.limit(0)).count() == 0
    assert [r["sentences"] for r in trained_sentences(frame, nothing, "doc_id").orderBy("doc_id").collect()] == [None, [""], [" "]]


def test_words_without_a_period_are_counted_alone(spark):
    """Which word follows is kept behind a period only, so rows grow with words and not with pairs of words."""
    frame = spark.createDataFrame([(1, "One two one. Two (one) two, ONE, ... end."), (2, None), (3, " "), (4, "one. two")],
                                  "doc_id bigint, text string")
    got = [tuple(r) for r in neighbours(frame, "text").select("word", "dotted", "next", "n").collect()]
    assert sorted(got) == [("", True, "end", 1), ("end", True, "", 1), ("one", False, "", 3), ("one", True, "two", 2),
                           ("two", False, "", 4)]


def test_outer_words(spark):
    texts = ["a b", "a\tb c\x0Bd", " a ", "a\r", "", "one", "a  \fb", None, "x\ny z\n"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    first, last = _outer_word(F.col("x"), 1), _outer_word(F.col("x"), -1)
    parts = F.split("x", r"[\t\n\x0B\f\r ]+", -1)
    for r in frame.select("x", first.alias("first"), last.alias("last"), parts.alias("p")).collect():
        assert (r["first"], r["last"]) == ((r["p"][0], r["p"][-1]) if r["x"] is not None else (None, None))
