import collections

import pytest

from answerloom.operators import batches


@pytest.fixture(scope="module")
def table(spark):
    """Article 0 holds a third of all rows; many articles have a single passage."""
    rows = [(i, 0 if i % 3 == 0 else 1 + i % 40, i % 5 if i % 3 == 0 or i % 40 < 20 else 0)
            for i in range(900)]
    return rows, spark.createDataFrame(rows, "row_id long, article_id long, paragraph_id int")


def grouped(frame):
    out = collections.defaultdict(dict)
    for r in frame.collect():
        assert r.slot not in out[r.batch_id]
        out[r.batch_id][r.slot] = r
    return out


@pytest.mark.parametrize("batch_size", [4, 7, 32])
def test_easy_batches(table, batch_size):
    rows, frame = table
    home = {r: a for r, a, _ in rows}
    got = grouped(batches.easy_batches(frame, batch_size))
    assert sorted(got) == list(range(900 // batch_size))
    for batch in got.values():
        assert sorted(batch) == list(range(batch_size))
        assert len({r.article_id for r in batch.values()}) == batch_size
        assert all(home[r.row_id] == r.article_id for r in batch.values())


@pytest.mark.parametrize("batch_size", [4, 7, 32])
def test_hard_batches(table, batch_size):
    rows, frame = table
    passages = collections.defaultdict(set)
    for _, a, p in rows:
        passages[a].add(p)
    home = {r: (a, p) for r, a, p in rows}
    got = grouped(batches.hard_batches(frame, batch_size))
    assert sorted(got) == list(range(900 // batch_size))
    for batch in got.values():
        assert sorted(batch) == list(range(batch_size))
        assert all(home[r.row_id] == (r.article_id, r.paragraph_id) for r in batch.values())
        for slot in range(0, batch_size - 1, 2):
            even, odd = batch[slot], batch[slot + 1]
            if len(passages[even.article_id]) > 1:
                assert even.article_id == odd.article_id
                assert even.paragraph_id != odd.paragraph_id
            else:
                assert even.article_id != odd.article_id


def test_draws_do_not_depend_on_partitions(table, rows):
    _, frame = table
    for make in (batches.easy_batches, batches.hard_batches):
        assert rows(make(frame.repartition(1), 8)) == rows(make(frame.repartition(13), 8))
    assert rows(batches.easy_batches(frame, 8, seed=7)) != rows(
        batches.easy_batches(frame, 8, seed=9))


def test_seed_picks_the_kind(table, rows):
    _, frame = table
    assert rows(batches.epoch_batches(frame, 8, 7)) == rows(batches.easy_batches(frame, 8, 7))
    assert rows(batches.epoch_batches(frame, 8, 8)) == rows(
        batches.hard_batches(frame, 8, 8).drop("paragraph_id"))


def test_too_few_articles(spark):
    frame = spark.createDataFrame([(i, i % 2, 0) for i in range(20)],
                                  "row_id long, article_id long, paragraph_id int")
    with pytest.raises(Exception, match="fewer articles than the batch size"):
        batches.easy_batches(frame, 4).collect()
