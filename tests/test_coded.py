"""Coded vectors: codebooks, codes, table scores, recall."""

import os

import numpy as np
import pytest

from answerloom.operators import ann, coded, held
from answerloom.operators.scoring import top_passages

PASSAGES, QUESTIONS = "passage_id bigint, vector array<float>", "question_id bigint, vector array<double>"


@pytest.fixture(scope="module")
def tables(spark):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(2000, 18))
    points[1500:1600] = points[3]
    passages = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], PASSAGES)
    asked = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(draw.normal(size=(150, 18)))], QUESTIONS)
    return passages, asked


def vectors_of(frame, key):
    rows = sorted((r[key], r["vector"]) for r in frame.collect())
    return np.array([r[1] for r in rows])


def test_codes_name_the_nearest_centres(tables):
    passages, _ = tables
    books = coded.rule_books(passages)
    assert books.shape == (5, 256, 4) and not books[4, :, 2:].any()
    got = {r["passage_id"]: r["codes"] for r in coded.coded(passages.repartition(5), books).collect()}
    points = vectors_of(passages, "passage_id")
    for i in range(0, 2000, 37):
        for m in range(5):
            part = np.zeros(4)
            part[:len(points[i, 4 * m:4 * m + 4])] = points[i, 4 * m:4 * m + 4]
            distance = np.round((books[m] ** 2).sum(axis=1) - 2 * books[m] @ part, 9)
            assert got[i][m] + 128 == distance.argmin()


def test_refined_centres_are_means(tables):
    passages, _ = tables
    books = coded.rule_books(passages)
    points = vectors_of(passages, "passage_id")
    want, error = books.copy(), []
    for turn in range(3):
        parts = np.zeros((2000, 20))
        parts[:, :18] = points
        parts = parts.reshape(2000, 5, 4)
        numbers = coded.nearest_centres(points, want)
        error.append(sum(((parts[:, m] - want[m][numbers[:, m]]) ** 2).sum() for m in range(5)))
        if turn < 2:
            for m in range(5):
                for c in set(numbers[:, m].tolist()):
                    want[m, c] = parts[numbers[:, m] == c, m].mean(axis=0)
    assert error[2] < error[1] < error[0]
    assert np.allclose(coded.refined_books(passages.repartition(3), books, 2), want, atol=1e-5)


@pytest.mark.parametrize("layout", [{}, {"broadcast_questions": 0, "question_block": 60, "passage_block": 500}])
def test_scores_are_sums_of_table_entries(tables, layout):
    passages, asked = tables
    books = coded.rule_books(passages)
    codes = coded.coded(passages, books)
    listed = {r["passage_id"]: np.array(r["codes"]) + 128 for r in codes.collect()}
    wanted = vectors_of(asked, "question_id")
    found = coded.coded_candidates(asked, codes, books, 7, **layout).collect()
    assert len(found) == 150 * 7
    for r in found[::50]:
        q = np.zeros(20)
        q[:18] = wanted[r["question_id"]]
        table = np.einsum("mcw,mw->mc", books, q.reshape(5, 4))
        scores = {i: round(table[np.arange(5), c].sum(), 9) for i, c in listed.items()}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        assert abs(scores[order[r["rank"] - 1]] - r["score"]) < 1e-8
        assert abs(scores[r["passage_id"]] - r["score"]) < 1e-8


def test_recall_after_rescoring(tables):
    passages, asked = tables
    books = coded.refined_books(passages, coded.rule_books(passages))
    codes = coded.coded(passages, books)
    exact = top_passages(asked, passages, 20)
    n = coded.fitted_candidates(asked, passages, codes, books, 20)
    assert n < 1000
    found = coded.coded_search(asked, passages, codes, books, 20, n)
    assert ann.recall(found, exact).first()["recall"] >= 0.9
    whole = coded.coded_search(asked, passages, codes, books, 20, 2000)
    key = lambda f: sorted(tuple(r) for r in f.collect())
    assert [r[:3] for r in key(whole)] == [r[:3] for r in key(exact)]


def test_codes_take_a_sixteenth(spark, tmp_path):
    draw = np.random.default_rng(6)
    rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(draw.normal(size=(4000, 64)))], PASSAGES).coalesce(1)
    rows.write.parquet(str(tmp_path / "vectors"))
    coded.coded(rows, coded.rule_books(rows)).write.parquet(str(tmp_path / "codes"))

    def size(name):
        folder = tmp_path / name
        return sum(os.path.getsize(folder / f) for f in os.listdir(folder) if f.endswith(".parquet"))
    ids = 8 * 4000
    assert size("codes") - ids < 1.35 * (size("vectors") - ids) / 16


def test_few_or_no_rows(spark):
    one = spark.createDataFrame([(7, [1.0, 0.0, 2.0])], PASSAGES)
    asked = spark.createDataFrame([(1, [0.5, 0.5, 1.0]), (2, [0.0, 0.0, 0.0])], QUESTIONS)
    books = coded.refined_books(one, coded.rule_books(one))
    codes = coded.coded(one, books)
    n = coded.fitted_candidates(asked, one, codes, books, 5)
    found = coded.coded_search(asked, one, codes, books, 5, n).collect()
    assert sorted((r["question_id"], r["rank"], r["passage_id"], r["score"]) for r in found) == [(1, 1, 7, 2.5), (2, 1, 7, 0.0)]
    none = one.limit(0)
    books = coded.refined_books(none, coded.rule_books(none))
    assert coded.coded_search(asked, none, coded.coded(none, books), books, 5, 5).count() == 0
    assert coded.coded_search(asked.limit(0), one, codes, coded.rule_books(one), 5, 5).count() == 0


def test_held_blocks_give_the_rows_of_the_broadcast(spark, tables):
    """Also for ids that repeat on either side, and for passages without an id."""
    passages, asked = tables
    books = coded.rule_books(passages)
    passages = passages.unionByName(passages.where("passage_id % 9 = 0"))
    asked = asked.unionByName(asked.where("question_id < 5"))
    codes = coded.coded(passages, books)
    unnamed = passages.unionByName(spark.createDataFrame([(None, [100.0] * 18)], PASSAGES))
    few = coded.coded_search(asked, unnamed, codes, books, 10, 40)
    many = coded.coded_search(asked, unnamed, codes, books, 10, 40, broadcast_questions=0, question_block=40)
    key = lambda f: sorted(tuple(r) for r in f.collect())
    assert key(many) == key(few) and many.columns == few.columns
    nothing = coded.coded_search(asked, passages.limit(0), codes.limit(0), books, 10, 40, broadcast_questions=0)
    assert nothing.count() == 0


def test_partial_rows_do_not_grow_with_blocks_of_passages(tables, monkeypatch):
    """A task sends the best of all passages, in batches of bounded size."""
    passages, asked = tables
    books = coded.rule_books(passages)
    partial = []
    ranked = coded.rank_top
    monkeypatch.setattr(coded, "rank_top", lambda found, *a: (partial.append(found), ranked(found, *a))[1])
    coded.coded_candidates(asked, coded.coded(passages, books), books, 7, broadcast_questions=0, question_block=50, passage_block=200)
    assert partial[0].count() == 150 * 7
    sizes = [b.num_rows for b in held.emitted(coded.pa.table({"x": np.arange(150_000)}))]
    assert max(sizes) <= held.EMITTED_ROWS and sum(sizes) == 150_000


def test_candidates_are_found_once(tables):
    """The join and its search for hot passages read stored pairs."""
    passages, asked = tables
    books = coded.rule_books(passages)
    found = coded.coded_search(asked, passages, coded.coded(passages, books), books, 5, 30)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in plan and "CoGroup" not in plan
