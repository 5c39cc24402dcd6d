"""Targets, schedule and pieces of the mix."""

import math
from collections import Counter

import pytest

import corpus_pipeline
from answerloom.llm import mixing
from answerloom.llm.mixing import mix, mixed_documents, schedule, targets


def test_targets_share_out_what_caps_cut():
    shares = targets([("a", 10), ("b", 100), ("c", 1000)], [1, 2, 3], 1110)
    assert [s.target for s in shares] == [30.0, 300.0, 780.0]
    assert [s.target for s in targets([("a", 50), ("b", 50)], [1, 3], 100)] == [25.0, 75.0]
    assert targets([], [], 0) == []
    assert [s.target for s in targets([("a", 0)], [1], 0)] == [0.0]


def test_schedule_keeps_to_the_weights(spark):
    shares = targets([("a", 9000), ("b", 9000), ("c", 12000)], [1, 2, 3], 30000)
    rows = schedule(spark, shares, 3).collect()
    ranks = {no: sorted(r["rank"] for r in rows if r["source_no"] == no) for no in range(3)}
    for no, share in enumerate(shares):
        assert ranks[no] == list(range(len(ranks[no])))
        assert abs(3 * len(ranks[no]) - share.target) <= 3 * math.log2(10000)
    assert sorted(r["slot"] for r in rows) == list(range(10000))


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(5 + i * 7 % 60)), None if i % 9 == 0 else f"s{i % 4}", 0, "x")
            for i in range(240)]
    rows += [(900, None, "s1", 0, "x"), (901, " \n", "s1", 0, "x"), (902, "a b c", "sé", 0, "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, rank string")


def test_mix(documents):
    rows = mix(documents, [1, 2, 3]).collect()
    assert len(rows) == 243 and rows and sorted(map(tuple, rows)) == sorted(map(tuple, mix(documents, [1, 2, 3]).collect()))
    by_target = Counter()
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_target[r["target"], r["source_size"]] += r["taken"]
    total = sum(r["size"] for r in rows)
    assert abs(sum(by_target.values()) - total) <= 20
    for (target, _), taken in by_target.items():
        assert abs(taken - target) <= 0.5
    assert all((r["first_slot"] is None) == (r["taken"] == 0) for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (900, 901)} == {0}
    assert {r["size"] for r in rows if r["doc_id"] == 902} == {2}


def test_mixed_documents_hold_the_taken_words(documents):
    taken = {r["doc_id"]: r["taken"] for r in mix(documents, [1, 2, 3]).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    found = Counter()
    mixed = mixed_documents(documents, [1, 2, 3], length_column="n_chars")
    assert mixed.columns == documents.columns
    for r in mixed.collect():
        words = r["text"].split(" ")
        found[r["doc_id"]] += len(words)
        assert r["text"] in texts[r["doc_id"]]
    assert found == Counter({k: v for k, v in taken.items() if v})


def test_query_and_stage_meet_small_targets(spark, monkeypatch):
    """40 sources whose targets are far below a slot get their words, in the query and in the stage."""
    monkeypatch.setattr(mixing, "LEAST_SLOTS", 4)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)), "big" if i < 150 else f"s{i:03}", 0) for i in range(190)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_chars bigint")
    keyed = frame.withColumn("row", frame.doc_id)
    shares = mixing.planned(mixing.sized(keyed, "doc_id", "source", "text"), corpus_pipeline.WEIGHTS)
    goals = {s.source: s.goal for s in shares}
    found, first = Counter(), {}
    for r in corpus_pipeline.mix_sources(spark, frame, "").collect():
        found[r["source"]] += len(r["text"].split(" "))
    assert found == goals and len(found) == 41
    sources = {i: s for i, _, s, _ in rows}
    found = Counter()
    for r in mix(frame, corpus_pipeline.WEIGHTS).collect():
        found[sources[r["doc_id"]]] += r["taken"]
        assert abs(r["target"] - goals[sources[r["doc_id"]]]) <= 0.5
        if r["taken"]:
            first[r["doc_id"]] = r["first_slot"]
    assert found == goals
    slots = mixed_documents(frame, corpus_pipeline.WEIGHTS, slot_column="at").groupBy("doc_id").min("at").collect()
    assert {r["doc_id"]: r["min(at)"] for r in slots} == first


def test_rows_count_one_by_one(spark):
    """Missing and repeated ids: every source gets its rounded target, whatever the ids."""
    rows = [(None, "a b c d e f g h i", "s"), (None, "k l m n o p q r s t u", "t"), (5, "x y z", "s"), (5, "x y z", "s"), (5, "u v", "t")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = Counter()
    for r in mixed_documents(frame, [1, 2]).collect():
        found[r["source"]] += len(r["text"].split(" "))
    assert found == {"s": 9, "t": 19}
    taken = Counter()
    for r in mix(frame, [1, 2]).collect():
        taken[r["source_size"]] += r["taken"]
    assert taken == {15: 9, 13: 19}


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, source string"
    assert mix(spark.createDataFrame([], schema), [1, 2]).count() == 0
    assert mixed_documents(spark.createDataFrame([], schema), [1, 2]).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (None, "", None)], schema)
    assert {(r["doc_id"], r["taken"]) for r in mix(blank, [1, 2]).collect()} == {(1, 0), (None, 0)}
    repeated = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c d", "s"), (2, "e f", "t")], schema)
    rows = mix(repeated, [1, 1]).collect()
    assert len(rows) == 4 and all(r["taken"] <= 3 * r["size"] for r in rows)
