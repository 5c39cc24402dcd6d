import pytest

from answerloom.operators import qa
from answerloom.operators.skew import skew_join
from pyspark.sql import functions as F


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(
        [(9, "t", "x"), (4, "t", "x"), (5, "ab", "c")], "article_id long, title string, text string")


@pytest.fixture
def asked(spark):
    return spark.createDataFrame(
        [(1, "t", "x"), (2, "ab", "c"), (3, "a", "bc"), (4, None, None)],
        "qa_id long, title string, context string")


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_repair(spark, rows, articles, asked, limit, hot_rows):
    got = qa.repair_article_ids(asked, articles, limit, hot_rows)
    assert rows(got, "qa_id", "article_id") == [(1, 4), (2, 5), (3, None), (4, None)]


def test_strict_raises_on_a_miss(articles, asked):
    fixed = qa.strict(qa.repair_article_ids(asked, articles), "article_id")
    with pytest.raises(Exception, match="no match for article_id"):
        fixed.collect()
    assert qa.strict(qa.repair_article_ids(asked.where("qa_id < 3"), articles),
                     "article_id").count() == 2


@pytest.mark.parametrize("limit", [0, 1000])
def test_assign_passage_ids(spark, rows, limit):
    passages = spark.createDataFrame(
        [(9, 2, "t", "x"), (9, 1, "t", "x"), (10, 0, "t", "x")],
        "article_id long, paragraph_id int, title string, text string")
    pairs = spark.createDataFrame([(1, "t", "x"), (2, "t", "y")],
                                  "qa_id long, title string, text string")
    got = qa.assign_passage_ids(pairs, passages, limit)
    assert rows(got, "qa_id", "passage_article_id", "passage_paragraph_id") == [
        (1, 9, 1), (2, None, None)]


@pytest.mark.parametrize("limit", [0, 1000])
def test_split_by_validation_questions(spark, rows, limit):
    table = [(i, "hot" if i % 3 else f"q{i % 7}") for i in range(300)]
    frame = spark.createDataFrame(table, "qa_id long, question string")
    held_out = spark.createDataFrame([("hot",), ("hot",), ("q3",)], "question string")
    train = rows(qa.train_rows(frame, held_out, "qa_id", limit, hot_rows=10), "qa_id")
    test = rows(qa.validation_rows(frame, held_out, "qa_id", limit, hot_rows=10), "qa_id")
    want = {i for i, q in table if q in ("hot", "q3")}
    assert {r[0] for r in test} == want and len(test) == len(want)
    assert {r[0] for r in train} == {i for i, _ in table} - want


def test_has_question_and_quality(spark, rows):
    frame = spark.createDataFrame([(1, "q", "a"), (2, "", "a"), (3, None, None), (4, "q", "")],
                                  "qa_id long, question string, answer string")
    assert rows(qa.has_question(frame), "qa_id") == [(1,), (4,)]
    assert rows(qa.quality_report(frame)) == [(4, 2, 2, 1)]
    with pytest.raises(Exception, match="empty question or answer"):
        qa.require_complete(frame).collect()


@pytest.mark.parametrize("limit", [0, 1000])
def test_passages_without_question(spark, rows, limit):
    passages = spark.createDataFrame([(1, "t", "x"), (2, "t", "y")],
                                     "passage_id long, title string, text string")
    pairs = spark.createDataFrame([("t", "x", None), ("t", "x", "q"), ("t", "y", "")],
                                  "title string, text string, question string")
    assert rows(qa.passages_without_question(passages, pairs, limit), "passage_id") == [(2,)]


def test_threshold(spark, rows):
    frame = spark.createDataFrame([(56736,), (56737,)], "article_id long")
    assert rows(qa.below_threshold(frame, "article_id")) == [(56736,)]
    assert rows(qa.above_threshold(frame, "article_id")) == [(56737,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [3, 50, 10**6])
def test_skew_join_equals_a_plain_join(spark, rows, how, hot_rows):
    left = spark.range(2000).selectExpr(
        "id", "case when id % 3 = 0 then 1 when id % 11 = 0 then null else id % 50 end as k")
    right = spark.range(0, 40, 2).selectExpr("id as k", "id * 10 as v").unionByName(
        spark.range(0, 4).selectExpr("id as k", "-id as v"))
    want = left.join(right, "k", how)
    got = skew_join(left, right, ["k"], how, F.col("id"), hot_rows)
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))
