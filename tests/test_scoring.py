import numpy as np
import pytest
from pyspark.sql import functions as F

from answerloom.operators import contrastive, metrics, scoring
from answerloom.functions import vectors as V

LAYOUTS = [{}, {"broadcast_questions": 0, "question_block": 7, "passage_block": 13},
           {"broadcast_questions": 0, "question_block": 1000, "passage_block": 1000}]


def vector_frame(spark, matrix, name):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(matrix)],
                                 f"{name} long, vector array<double>")


@pytest.fixture(scope="module")
def data(spark):
    """Small integer vectors, so that many scores tie; a third are one and the same."""
    draw = np.random.default_rng(1)
    passages = draw.integers(-2, 3, (60, 4)).astype(float)
    passages[::3] = passages[0]
    questions = draw.integers(-2, 3, (25, 4)).astype(float)
    return questions, passages


def exact(questions, passages, k):
    out = []
    for q, row in enumerate(questions @ passages.T):
        order = np.lexsort((np.arange(len(row)), -row))[:k]
        out += [(q, r + 1, int(p), float(row[p])) for r, p in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("partitions", [1, 17])
@pytest.mark.parametrize("k", [1, 5, 100])
def test_top_k_equals_a_full_sort(spark, rows, data, layout, partitions, k):
    questions, passages = data
    got = scoring.top_passages(
        vector_frame(spark, questions, "question_id"),
        vector_frame(spark, passages, "passage_id").repartition(partitions), k, **layout)
    assert rows(got) == exact(questions, passages, k)


def test_small_tiles_give_the_same_answer(data):
    questions, passages = data
    for tile in (3, 26, 500):
        best = scoring.BestK(len(questions), 4)
        for at in range(0, len(passages), tile):
            ids = np.arange(at, min(at + tile, len(passages)))
            best.add(ids, questions @ passages[ids].T)
        got = sorted(zip(best.row, best.pid), key=repr)
        assert got == sorted([(q, p) for q, _, p, _ in exact(questions, passages, 4)], key=repr)


def pair_frame(spark, questions, passages):
    return spark.createDataFrame(
        [(i, [float(x) for x in q], [float(x) for x in p])
         for i, (q, p) in enumerate(zip(questions, passages))],
        "pair_id long, question_vector array<double>, passage_vector array<double>")


@pytest.mark.parametrize("layout", LAYOUTS)
def test_gold_rank_and_precision(spark, rows, data, layout):
    questions, passages = data
    pairs = pair_frame(spark, questions, passages)
    got = contrastive.gold_ranks(pairs, vector_frame(spark, passages, "passage_id"), **layout)
    scores = questions @ passages.T
    want = []
    for i, row in enumerate(scores):
        beats = (row > row[i]) | ((row == row[i]) & (np.arange(len(row)) < i))
        want.append((i, 1 + int(beats.sum())))
    assert rows(got, "question_id", "gold_rank") == sorted(want, key=repr)


def test_precision_fixture(spark, rows):
    ranks = spark.createDataFrame([(1,), (3,), (7,)], "gold_rank long")
    got = contrastive.precision_at(ranks, (1, 5, 10))
    assert [(k, round(p, 1)) for k, p in got.orderBy("k").collect()] == [
        (1, 33.3), (5, 66.7), (10, 100.0)]
    assert [round(x, 3) for x in metrics.top_k_accuracy(ranks, (1, 5)).first()] == [3, 0.333, 0.667]


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("temperature", [1.0, 0.002])
def test_corpus_loss(spark, data, layout, temperature):
    questions, passages = data
    pairs = pair_frame(spark, questions, passages)
    got = contrastive.corpus_loss(pairs, vector_frame(spark, passages, "passage_id").repartition(5),
                                  temperature, **layout).collect()
    scores = questions @ passages.T
    for row in got:
        positive = scores[row.question_id, row.question_id]
        logits = np.append(positive, 0.999 * scores[row.question_id]) / temperature
        want = np.logaddexp.reduce(logits) - logits[0]
        assert row.loss == pytest.approx(want, abs=1e-9, rel=1e-9)
        assert row.positive_rank == 1 + (np.round(0.999 * scores[row.question_id], 9)
                                         > positive).sum()
        assert row.n_negatives == len(passages)
    assert len(got) == len(questions)


def test_in_batch_loss(spark, data):
    questions, passages = data
    pairs = pair_frame(spark, questions[:24], passages[:24]).withColumn(
        "batch_id", F.floor(F.col("pair_id") / 8))
    got = {r.batch_id: r for r in contrastive.in_batch_loss(pairs, 0.5).collect()}
    assert len(got) == 3
    for b in range(3):
        part = slice(8 * b, 8 * b + 8)
        scores = questions[part] @ passages[part].T / 0.5
        loss = np.mean(np.logaddexp.reduce(scores, axis=1) - scores.diagonal())
        assert got[b].loss == pytest.approx(loss)
        assert got[b].accuracy == pytest.approx(
            np.mean(scores.argmax(axis=1) == np.arange(8)))


def test_queue_fixture(spark, rows):
    keys = spark.range(12).withColumnRenamed("id", "seq")
    got = rows(contrastive.queue_negatives(keys, 4, 2))
    assert [k for b, k in got if b == 0] == []
    assert [k for b, k in got if b == 3] == [2, 3, 4, 5]
    assert {b for b, _ in got} == {1, 2, 3, 4, 5}
    with pytest.raises(ValueError):
        contrastive.queue_negatives(keys, 5, 2)


def test_queue_loss(spark, data):
    questions, passages = data
    pairs = pair_frame(spark, questions, passages).withColumnRenamed("pair_id", "seq")
    got = {r.seq: r for r in contrastive.queue_loss(pairs, 8, 4, 0.5).collect()}
    assert len(got) == len(questions)
    for i, row in got.items():
        batch = i // 4
        seen = np.arange(max(0, batch * 4 - 8), batch * 4)
        positive = questions[i] @ passages[i]
        scores = passages[seen] @ questions[i]
        logits = np.append(positive, scores) / 0.5
        assert row.loss == pytest.approx(np.logaddexp.reduce(logits) - logits[0])
        assert (row.n_negatives, row.positive_rank) == (len(seen), 1 + (scores > positive).sum())


def test_vector_columns(spark):
    frame = spark.createDataFrame([([3.0, 4.0], [1.0, 2.0]), ([0.0, 0.0], [1.0, 1.0])],
                                  "a array<float>, b array<float>")
    got = frame.select(V.inner_product(F.col("a"), F.col("b")), V.l2_normalize(F.col("a"))).collect()
    assert [tuple(r) for r in got] == [(11.0, [0.6, 0.8]), (0.0, [0.0, 0.0])]


def test_a_table_meets_itself_in_blocks(spark, rows, data):
    """Both sides of the cogroup come from one table, as in the nearest other vectors of all vectors."""
    _, passages = data
    stored = vector_frame(spark, passages, "passage_id")
    asked = stored.select(F.col("passage_id").alias("question_id"), "vector")
    got = scoring.top_passages(asked, stored, 5, broadcast_questions=0, question_block=7, passage_block=13)
    assert rows(got) == exact(passages, passages, 5)


def test_blocks_grow_before_they_multiply(spark):
    """Every block of one side is sent to all blocks of the other, so small blocks must not stay small."""
    many = spark.range(100_000)
    assert scoring._parts(many, [], 300).first()["_n"] == scoring.MOST_PARTS
    assert scoring._parts(many, [], 50_000).first()["_n"] == 2
    assert scoring._parts(spark.range(30 * scoring.LARGEST_BLOCK), [], 300).first()["_n"] == 30
    assert scoring._parts(many, [], 1 << 20).first()["_n"] == 1


def test_few_scores_are_computed_in_doubles(monkeypatch):
    draw = np.random.default_rng(5)
    questions, passages = draw.normal(size=(300, 16)), draw.normal(size=(20_000, 16))
    seen, add = [], scoring.BestK._merge
    monkeypatch.setattr(scoring.BestK, "_merge", lambda self, *new: (seen.append(len(new[0])), add(self, *new)))
    nearest = scoring.Nearest(questions, 10)
    nearest.add(np.arange(20_000), passages)
    row, ids, _ = nearest.result()
    assert sorted(zip(row, ids)) == sorted((q, p) for q, _, p, _ in exact(questions, passages, 10))
    assert sum(seen) < 300 * 20_000 // 50


@pytest.mark.parametrize("factor", [1.0, 2.0 ** -100, 2.0 ** 66, 2.0 ** 600])
def test_nearest_with_copies_rows_and_long_vectors(factor):
    draw = np.random.default_rng(6)
    passages = draw.integers(-3, 4, (4000, 5)).astype(float)
    passages[1000:3000] = passages[3]
    questions = draw.integers(-3, 4, (1500, 5)).astype(float) * factor
    order, asked = draw.permutation(4000), np.flatnonzero(draw.random(1500) < 0.5)
    nearest = scoring.Nearest(questions, 7)
    for at in range(0, 4000, 900):
        ids = order[at:at + 900]
        nearest.add(ids, passages[ids], asked)
    row, ids, score = nearest.result()
    assert set(row) == set(asked)
    for q in asked[::50]:
        exact_ = np.round(passages @ questions[q], 9)
        want = np.lexsort((np.arange(4000), -exact_))[:7]
        assert (ids[row == q] == want).all() and np.allclose(score[row == q], exact_[want], 1e-12)


@pytest.mark.parametrize("factor,shift", [(1.0, 0.0), (1e-4, 0.0), (1e16, 0.0), (1.0, 3.0)])
def test_corpus_ranks_are_those_of_the_loss(spark, factor, shift):
    """Ranks alone need no exponential: counts agree at ties, tiny, huge and mostly higher scores."""
    draw = np.random.default_rng(5)
    passages = np.round(draw.normal(size=(300, 4)) * 2 + shift, 1) * factor
    passages[50:100] = passages[:50] / 0.999
    questions = passages + np.roll(passages, 1, axis=0)
    pairs = spark.createDataFrame([(i, q.tolist(), p.tolist()) for i, (q, p) in enumerate(zip(questions, passages))],
                                  "pair_id long, question_vector array<double>, passage_vector array<double>")
    stored = pairs.select(F.col("pair_id").alias("passage_id"), F.col("passage_vector").alias("vector"))
    want = None
    for layout in ({}, {"broadcast_questions": 10, "question_block": 64, "passage_block": 90}):
        got = {r.question_id: r.positive_rank for r in contrastive.corpus_ranks(pairs, stored, **layout).collect()}
        want = want or {r.question_id: r.positive_rank for r in contrastive.corpus_loss(
            pairs, stored, temperature=0.5 * factor * factor).collect()}
        assert got == want
    assert max(want.values()) > 1
