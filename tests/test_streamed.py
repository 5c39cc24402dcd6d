"""Streamed question blocks: the same answer as brute force, bounded blocks, no shuffle of passages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.operators import streamed

PASSAGES, QUESTIONS = "passage_id bigint, vector array<float>", "question_id bigint, vector array<double>"


@pytest.fixture(scope="module")
def tables(spark):
    draw = np.random.default_rng(8)
    points = draw.integers(-3, 4, size=(900, 6)).astype(float)
    asked = draw.integers(-3, 4, size=(230, 6)).astype(float)
    return (spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], PASSAGES).repartition(5),
            spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(asked)], QUESTIONS).repartition(3), points, asked)


@pytest.mark.parametrize("most", [1000, 230, 50])
def test_equals_brute_force(tables, most):
    passages, questions, points, asked = tables
    got = sorted((r["question_id"], r["rank"], r["passage_id"], r["score"])
                 for r in streamed.top_streamed(questions, passages, 5, most).collect())
    scores = asked @ points.T
    want = [(q, n + 1, int(p), scores[q, p]) for q in range(230)
            for n, p in enumerate(np.lexsort((np.arange(900), -scores[q]))[:5])]
    assert got == want


def test_blocks_keep_their_bound(spark, tables, tmp_path):
    same = spark.range(333).select(F.lit(None).cast("bigint").alias("question_id"), F.array(F.lit(1.0)).alias("vector"))
    assert streamed.stored_blocks(same.repartition(4), 40, str(tmp_path)) == 9
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "blocks")).groupBy("block").count().collect()]
    assert sorted(sizes) == [13, *[40] * 8]
    assert streamed.block_rows(same, 1000) == 1000
    assert streamed.block_rows(same, 1000, 7200) == 100


def test_partial_rows_and_plan(spark, tables):
    passages, questions, _, _ = tables
    found = streamed.top_streamed(questions, passages, 5, 100)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "vector" not in plan
    parts = passages.rdd.getNumPartitions()
    assert spark.read.parquet(found.inputFiles()[0].rsplit("/", 1)[0]).count() <= 230 * 5 * parts


def test_no_rows(tables):
    passages, questions, _, _ = tables
    assert streamed.top_streamed(questions.limit(0), passages, 5).count() == 0
    assert streamed.top_streamed(questions, passages.limit(0), 5).count() == 0
    assert streamed.top_streamed(questions, passages, 5, 64).columns == ["question_id", "rank", "passage_id", "score"]
