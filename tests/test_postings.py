"""The stored inverted index against the scan of all texts."""

import random

import numpy as np
import pytest

from answerloom.operators import postings
from answerloom.operators.sparse import bm25_top


@pytest.fixture(scope="module")
def texts(spark):
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    rows = [(i, " ".join(draw.choices(vocabulary, weights, k=draw.randint(1, 60)))) for i in range(900)]
    rows += [(900, None), (901, ""), (902, "W0, w1!"), *[(1000 + i, "w0 w7 w9") for i in range(50)]]
    asked = [(i, " ".join(draw.choices(vocabulary, weights, k=6))) for i in range(40)] + [(98, "unheard of"), (99, ""), (100, None)]
    return (spark.createDataFrame(rows, "passage_id bigint, text string"),
            spark.createDataFrame(asked, "question_id bigint, text string"))


@pytest.mark.parametrize("terms", [500_000, 40])
def test_equals_the_scan(spark, texts, rows, tmp_path, terms):
    passages, questions = texts
    path = str(tmp_path / "index")
    postings.write_postings(passages.where("passage_id % 4 < 2"), path, slice_passages=100)
    postings.append_postings(passages.where("passage_id % 4 >= 2"), path, slice_passages=70)
    found = postings.search_postings(questions, spark, path, 10, broadcast_terms=terms)
    assert rows(found) == rows(bm25_top(questions, passages, 10))
    lists = spark.read.parquet(f"{path}/lists")
    # Frequent words are cut into as many lists as there are slices.
    assert lists.where("term = 'w0'").count() > 10 and lists.selectExpr("max(n)").first()[0] <= 130


def test_only_asked_buckets_are_read(spark, texts, tmp_path):
    path = str(tmp_path / "index")
    postings.write_postings(texts[0], path)
    terms = spark.createDataFrame([("w3",), ("w5",)], "term string")
    plan = postings.asked_lists(terms, spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    files = {f.split("bucket=")[1].split("/")[0] for f in postings.asked_lists(terms, spark, path).inputFiles()}
    assert len(files) <= 64 and postings.asked_lists(terms, spark, path).select("bucket").distinct().count() <= 2


def test_empty_index(spark, texts, tmp_path):
    path = str(tmp_path / "index")
    postings.write_postings(texts[0].limit(0), path)
    assert postings.search_postings(texts[1], spark, path, 5).count() == 0
    assert postings.search_postings(texts[1].limit(0), spark, path, 5).count() == 0


def test_lists_are_left_unread():
    draw = np.random.default_rng(1)
    rare = (9.0, np.arange(30), draw.uniform(5, 9, 30))
    common = [(0.01, np.arange(1000), draw.uniform(0, 0.01, 1000)) for _ in range(5)]
    at, score, read = postings.best_of_slice([*common, rare], 1000, 1)
    whole = np.zeros(1000)
    for _, places, gains in [rare, *common]:
        whole[places] += gains
    assert at[score.argmax()] == whole.argmax()
    alone = (9.0, np.arange(30), np.concatenate([[9.0], np.full(29, 1.0)]))
    assert postings.best_of_slice([*common, alone], 1000, 1)[0].tolist() == [0]
    for seed in range(30):
        draw = np.random.default_rng(seed)
        terms = []
        for _ in range(8):
            places = np.flatnonzero(draw.random(200) < draw.random())
            gains = draw.random(len(places)) * draw.uniform(0.1, 4)
            terms.append((gains.max(initial=0.0), places, gains))
        whole, touched = np.zeros(200), np.zeros(200, bool)
        for _, places, gains in terms:
            whole[places] += gains
            touched[places] = True
        at, score, _ = postings.best_of_slice(terms, 200, 5)
        order = sorted(np.flatnonzero(touched), key=lambda i: (-round(whole[i], 9), i))[:5]
        assert sorted(at, key=lambda i: (-round(dict(zip(at, score))[i], 9), i))[:5] == order


def test_files_follow_the_passages_not_the_tasks(spark, texts, tmp_path):
    """Few slices give one file per bucket, and texts are moved once, not word by word."""
    path = str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        postings.write_postings(texts[0], path, slice_passages=100)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    lists = spark.read.parquet(f"{path}/lists")
    assert len(lists.inputFiles()) == lists.select("bucket").distinct().count() <= postings.BUCKETS
    whole = lists.where("term = ''").selectExpr("count(*)", "sum(n)", "sum(aggregate(counts, 0, (a, b) -> a + b))").first()
    sums = spark.read.parquet(f"{path}/sums").first()
    assert tuple(whole) == (sums["slices"], sums["passages"], sums["words"])
    assert sums["passages"] == texts[0].count()
