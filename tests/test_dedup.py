import pytest

from answerloom.operators import dedup

DUPLICATES = [(7, "t", "x"), (3, "t", "x"), (9, "t", "x"), (4, "t", "y"),
              (5, "ab", "c"), (6, "a", "bc")]


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(DUPLICATES, "article_id long, title string, text string")


def test_smallest_article_is_kept(articles, rows):
    assert rows(dedup.dedup_articles(articles), "article_id") == [(3,), (4,), (5,), (6,)]
    groups = rows(dedup.duplicate_groups(articles, ["title", "text"], "article_id"))
    assert groups == [("t", "x", 3, 9, 3)]


@pytest.mark.parametrize("limit", [0, 1000])
@pytest.mark.parametrize("hot_rows", [1, 2, 1_000_000])
def test_canonical_map(articles, rows, limit, hot_rows):
    got = dedup.canonical_map(articles, ["title", "text"], "article_id", limit, hot_rows)
    assert rows(got) == [(7, 3), (9, 3)]


def test_passage_rule_uses_typed_order(spark, rows):
    passages = spark.createDataFrame(
        [(10, 0, "t", "x"), (9, 2, "t", "x"), (9, 1, "t", "x"), (100, 0, "t", "x")],
        "article_id long, paragraph_id int, title string, text string")
    kept = dedup.dedup_passages(passages)
    assert rows(kept, "article_id", "paragraph_id") == [(9, 1)]
    assert rows(dedup.dedup_passages(kept)) == rows(kept)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_hot_group_of_copies(spark, rows, partitions):
    """A third of all rows are copies of one text."""
    table = [(i, "t", "same" if i % 3 == 0 else f"text {i % 1000}") for i in range(6000)]
    frame = spark.createDataFrame(table, "article_id long, title string, text string") \
        .repartition(partitions)
    first = {}
    for i, t, x in table:
        first.setdefault((t, x), i)
    kept = dedup.dedup_articles(frame)
    assert rows(kept) == sorted([(i, t, x) for (t, x), i in first.items()], key=repr)
    id_map = dedup.canonical_map(frame, ["title", "text"], "article_id", 0, hot_rows=100)
    want = sorted([(i, first[t, x]) for i, t, x in table if first[t, x] != i], key=repr)
    assert rows(id_map) == want
    stale = frame.selectExpr("article_id as row_id", "article_id")
    remapped = dedup.remap_ids(stale, id_map, "article_id", "row_id", 0, hot_rows=100)
    assert rows(remapped, "row_id", "article_id") == sorted(
        [(i, first[t, x]) for i, t, x in table], key=repr)


def test_both_ways_agree(spark, rows):
    frame = spark.createDataFrame([(i, "t", f"x{i * i % 50}") for i in range(400)],
                                  "article_id long, title string, text string")
    broadcast = rows(dedup.dedup_articles(frame))
    assert broadcast == rows(dedup.dedup_articles(frame, broadcast_groups=0))
    assert broadcast == rows(dedup.keep_first(frame, ["title", "text"], ["article_id"]))


def test_copies_are_dropped_without_moving_texts(articles):
    plan = dedup.dedup_articles(articles)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_group_limit_runs_before_the_exchange(articles):
    plan = dedup.keep_first(articles, ["title", "text"], ["article_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning(_key")
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange hashpartitioning(_key")
