import pytest

from answerloom.operators.numbering import fixed_batches, numbered, numbered_within


def test_positions_are_dense_and_stable(spark, rows):
    frame = spark.range(5000).selectExpr("id as a", "id % 3 as b")
    first = rows(numbered(frame.repartition(1), ["a", "b"], seed=4))
    assert rows(numbered(frame.repartition(17), ["a", "b"], seed=4)) == first
    got = numbered(frame, ["a", "b"], seed=4)
    assert sorted(r.position for r in got.collect()) == list(range(5000))
    assert {r.total for r in got.collect()} == {5000}


@pytest.mark.parametrize("partitions", [1, 9])
def test_numbers_inside_groups(spark, partitions):
    """One group holds most of the rows."""
    frame = spark.range(3000).selectExpr(
        "id", "case when id % 3 > 0 then -1 else id % 40 end as g").repartition(partitions)
    groups = {}
    for r in numbered_within(frame, ["g"], ["id"], parts=8).collect():
        groups.setdefault(r.g, []).append((r["index"], r["index_size"]))
    assert sum(map(len, groups.values())) == 3000
    for members in groups.values():
        assert sorted(i for i, _ in members) == list(range(len(members)))
        assert {n for _, n in members} == {len(members)}


def test_last_partial_batch(spark):
    frame = spark.range(103)
    full = fixed_batches(frame, ["id"], 10).collect()
    assert len(full) == 100 and {r.batch_id for r in full} == set(range(10))
    assert sorted(r.slot for r in full if r.batch_id == 3) == list(range(10))
    assert fixed_batches(frame, ["id"], 10, drop_last=False).count() == 103
