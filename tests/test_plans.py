import types

import pytest

import __spark_entry__ as contract
from answerloom.operators import stored
from answerloom.plans import corpus, retrieve
from answerloom.sources import tables

ARTICLES = [
    (3, "cats", "Cats sleep.\n\nCats eat fish. " + "x" * 480 + ". Cats purr."),
    (9, "cats", "Cats sleep.\n\nCats eat fish. " + "x" * 480 + ". Cats purr."),
    (4, "dogs", "Dogs bark loudly."),
]


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(ARTICLES, "article_id long, title string, text string")


@pytest.fixture
def asked(spark):
    context = ARTICLES[0][2]
    return spark.createDataFrame(
        [(1, 9, "cats", context, "what do cats do?", "Cats purr", context.index("Cats purr")),
         (2, 9, "cats", context, "what do cats eat?", "fish", context.index("fish")),
         (3, 4, "dogs", ARTICLES[2][2], "what do dogs do?", "bark", 5),
         (4, 1, "birds", "unknown", "who?", "x", 0)],
        "qa_id long, article_id long, title string, context string, question string, "
        "answer string, answer_start int")


def test_corpus_build(spark, rows, articles, asked, tmp_path):
    validation = spark.createDataFrame([("what do dogs do?",)], "question string")
    out = str(tmp_path)
    corpus.write_corpus(spark, articles, asked, validation, out)
    assert rows(spark.read.parquet(f"{out}/articles"), "article_id") == [(3,), (4,)]
    assert rows(spark.read.parquet(f"{out}/passages"), "article_id", "paragraph_id") == [
        (3, 0), (3, 1), (3, 2), (4, 0)]
    train = tables.read_split(spark, f"{out}/splits", "train")
    assert rows(train, "qa_id", "passage_article_id", "passage_paragraph_id", "answer") == [
        (1, 3, 2, "Cats purr"), (2, 3, 0, "fish")]
    test = tables.read_split(spark, f"{out}/splits", "test")
    assert rows(test, "qa_id", "text") == [(3, "Dogs bark loudly.")]


def test_answer_coverage(spark, rows):
    found = spark.createDataFrame([(1, 1, 10), (1, 2, 11), (2, 1, 10)],
                                  "question_id long, rank int, passage_id long")
    gold = spark.createDataFrame([(1, 11), (2, 99), (3, 10)], "question_id long, passage_id long")
    got = retrieve.answer_coverage(found, gold, (1, 2)).first()
    assert (got.n_questions, got.top_1, got.top_2) == (3, 0.0, pytest.approx(1 / 3))


def test_shared_folder_comes_from_the_session(spark):
    conf = types.SimpleNamespace(get=lambda key, default: f"hdfs://{key}")
    assert stored.shared_folder(types.SimpleNamespace(conf=conf)) == "hdfs://spark.checkpoint.dir"
    own = stored.shared_folder(spark)
    assert own == stored.shared_folder(spark) and own
    assert stored.written_once(spark.range(5)).count() == 5


def test_entry(spark):
    got = contract.entry(spark)
    assert {"question_id", "rank", "passage_id", "is_gold"} <= set(got.columns)
    assert got.count() > 0


def test_contract_names():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert len(contract.queries()) > 65
