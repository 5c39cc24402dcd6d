import collections

import pytest
from pyspark.sql import functions as F

from answerloom.operators import redraw


@pytest.fixture(scope="module")
def table(spark):
    """40 articles; one holds a third of 900 rows, the last ones a single row, and some rows have no article."""
    rows = [(i, 0 if i % 3 == 0 else i % 40 if i < 800 else 10 + i % 30, i % 7 if i % 5 else 0) for i in range(900)]
    rows += [(900 + i, 100 + i, 0) for i in range(6)]
    frame = spark.createDataFrame(rows, "row_id long, article_id long, paragraph_id int")
    return rows, frame.union(spark.createDataFrame([(2000, None, 0), (2001, None, 1)], frame.schema))


def grouped(frame):
    out = collections.defaultdict(dict)
    for r in frame.collect():
        assert r.slot not in out[r.batch_id]
        out[r.batch_id][r.slot] = r
    return out


@pytest.mark.parametrize("size", [1, 2, 3, 5, 16, 17, 100, 997, 4099])
def test_every_key_permutes_all_numbers(spark, size):
    got = spark.range(size).crossJoin(spark.range(3).withColumnRenamed("id", "key")).select(
        "key", redraw.permuted(F.col("id"), F.col("key"), size, 5).alias("to")).collect()
    orders = collections.defaultdict(list)
    for r in got:
        orders[r.key].append(r.to)
    assert all(sorted(x) == list(range(size)) for x in orders.values())
    if size > 16:
        assert len({tuple(x) for x in orders.values()}) == 3


def test_chances_are_even(spark):
    """Every number comes first about as often: chi-square with 22 degrees of freedom below its 0.9999 quantile."""
    firsts = spark.range(23_000).select(redraw.permuted(F.lit(0), F.col("id"), 23, 1).alias("x")).groupBy("x").count()
    counts = [r["count"] for r in firsts.collect()]
    assert len(counts) == 23 and sum((c - 1000) ** 2 / 1000 for c in counts) < 56


@pytest.mark.parametrize("batch_size", [1, 7, 16])
def test_redrawn_batches(table, batch_size):
    rows, frame = table
    home = {r: a for r, a, _ in rows}
    got = grouped(redraw.redrawn_batches(frame, batch_size))
    assert sorted(got) == list(range(906 // batch_size))
    for batch in got.values():
        assert sorted(batch) == list(range(batch_size))
        assert len({r.article_id for r in batch.values()}) == batch_size
        assert all(home[r.row_id] == r.article_id for r in batch.values())
    articles = collections.Counter(r.article_id for batch in got.values() for r in batch.values())
    assert articles[0] < 3 * 906 / 46  # not in proportion to its rows


@pytest.mark.parametrize("batch_size", [2, 7, 16])
def test_redrawn_hard_batches(table, batch_size):
    rows, frame = table
    passages, home = collections.defaultdict(set), {}
    for r, a, p in rows:
        passages[a].add(p)
        home[r] = (a, p)
    got = grouped(redraw.redrawn_hard_batches(frame, batch_size))
    assert sorted(got) == list(range(906 // batch_size))
    for batch in got.values():
        assert sorted(batch) == list(range(batch_size))
        assert all(home[r.row_id] == (r.article_id, r.paragraph_id) for r in batch.values())
        assert max(collections.Counter(r.article_id for r in batch.values()).values()) <= 2
        for slot in range(0, batch_size - 1, 2):
            even, odd = batch[slot], batch[slot + 1]
            if len(passages[even.article_id]) > 1:
                assert even.article_id == odd.article_id and even.paragraph_id != odd.paragraph_id
            else:
                assert even.article_id != odd.article_id


def test_draws_follow_seed_and_not_partitions(table, rows):
    frame = table[1]
    for make in (redraw.redrawn_batches, redraw.redrawn_hard_batches):
        assert rows(make(frame.repartition(1), 8)) == rows(make(frame.repartition(13), 8))
        assert rows(make(frame, 8, 1)) != rows(make(frame, 8, 2))


def test_too_few_articles_and_no_rows(spark):
    frame = spark.createDataFrame([(i, i % 2, 0) for i in range(20)], "row_id long, article_id long, paragraph_id int")
    for make in (redraw.redrawn_batches, redraw.redrawn_hard_batches):
        with pytest.raises(ValueError, match="fewer articles than the batch size"):
            make(frame, 4)
        assert make(frame.limit(0), 4).count() == 0
