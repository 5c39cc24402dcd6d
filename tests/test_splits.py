"""Splits of an exact size, and the quarantine."""

import hashlib

import pytest

from answerloom.operators import qa, splits


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_exact_size_and_order(spark, monkeypatch, share):
    monkeypatch.setattr(splits, "SMALL", 3)
    frame = spark.range(10_007).withColumnRenamed("id", "doc_id")
    got = {r["doc_id"]: r["split"] for r in splits.exact_split(frame, "doc_id", share, 5).collect()}
    order = sorted(got, key=lambda i: (hashlib.md5(f"5-{i}".encode()).hexdigest(), i))
    wanted = int(10_007 * share + 0.5)
    assert {i for i, s in got.items() if s == "test"} == set(order[:wanted])


def test_repeated_and_missing_ids(spark):
    rows = [(7, "a")] * 900 + [(None, "b")] * 50 + [(i, "c") for i in range(8, 58)]
    frame = spark.createDataFrame(rows, "doc_id bigint, split_ string")
    for wanted in (0, 1, 49, 500, 949, 951, 999, 1000):
        marked = splits.exact_split(frame, "doc_id", 0.0, 3, wanted=wanted)
        assert marked.where("split = 'test'").count() == wanted and marked.count() == 1000
        if wanted <= 950:
            assert marked.where("split = 'test' and doc_id is null").count() == 0
    assert splits.exact_split(frame.limit(0), "doc_id", 0.5, 3).count() == 0


def test_few_scans_and_no_sort(spark):
    frame = spark.range(100_000).withColumnRenamed("id", "doc_id")
    plan = splits.exact_split(frame, "doc_id", 0.3, 1)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan


def test_quarantine(spark, rows):
    frame = spark.createDataFrame(
        [(1, "q", "a"), (2, "", "a"), (3, None, ""), (4, "q", None), (5, "q2", "b"), (5, "q2", "b")],
        "qa_id bigint, question string, answer string")
    good, bad, counts = qa.quarantine(frame)
    assert rows(good) == [(1, "q", "a"), (5, "q2", "b"), (5, "q2", "b")] and good.columns == frame.columns
    assert sorted((r["qa_id"], r["reasons"]) for r in bad.collect()) == [
        (2, ["no question"]), (3, ["no question", "no answer"]), (4, ["no answer"])]
    assert counts == {"rows": 6, "accepted": 3, "no question": 2, "no answer": 2}
    good, bad, counts = qa.quarantine(frame.limit(0))
    assert good.count() == bad.count() == 0 and set(counts.values()) == {0}


def test_quarantine_scans_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    frame = spark.createDataFrame([(i, "q", "a" if i % 2 else "") for i in range(100)], "qa_id bigint, question string, answer string")
    good, bad, counts = qa.quarantine(frame.mapInArrow(count, frame.schema))
    assert good.count() == bad.count() == 50 and counts["rows"] == 100 and seen.value == 100
