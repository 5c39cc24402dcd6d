import collections
import hashlib
import math
import random
import tempfile

import numpy as np
import pyarrow as pa
import pytest

from answerloom.plans import corpus, retrieve
from answerloom.registry import retrieval as registry
from answerloom.operators import ann, embedding, retrieval, scoring, sparse


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(2)
    common, rare = ["the", "a", "und"], [f"w{i}" for i in range(60)]
    make = lambda n: " ".join(
        draw.choice(common) if draw.random() < 0.6 else draw.choice(rare) for _ in range(n))
    passages = [make(draw.randrange(0, 40)) for _ in range(150)]
    passages[::3] = [passages[1]] * 50
    return [make(8) for _ in range(12)], passages


def bm25(questions, passages, k, k1=1.2, b=0.75):
    bags = [collections.Counter(p.split()) for p in passages]
    sizes = [sum(bag.values()) for bag in bags]
    mean, n = sum(sizes) / len(sizes), len(bags)
    df = collections.Counter(t for bag in bags for t in bag)
    out = []
    for q, question in enumerate(questions):
        scores = []
        for p, bag in enumerate(bags):
            hit = [t for t in question.split() if t in bag]
            if hit:
                score = sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * bag[t] * (k1 + 1)
                            / (bag[t] + k1 * (1 - b + b * sizes[p] / mean)) for t in hit)
                scores.append((-round(score, 9), p))
        out += [(q, r + 1, p) for r, (_, p) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("terms", [10_000, 0])
@pytest.mark.parametrize("partitions", [1, 9])
def test_bm25_equals_brute_force(spark, rows, texts, terms, partitions):
    questions, passages = texts
    asked = spark.createDataFrame(list(enumerate(questions)), "question_id long, text string")
    stored = spark.createDataFrame(list(enumerate(passages)), "passage_id long, text string") \
        .repartition(partitions)
    got = sparse.bm25_top(asked, stored, 7, broadcast_terms=terms)
    assert rows(got, "question_id", "rank", "passage_id") == bm25(questions, passages, 7)


def test_stored_sparse_results(spark, rows):
    table = spark.createDataFrame([(1, [7, 5], [2.0, 1.0])],
                                  "question_id long, ids array<long>, scores array<double>")
    assert rows(sparse.unpack_sparse(table)) == [(1, 1, 7, 2.0), (1, 2, 5, 1.0)]


def test_fusion(spark, rows):
    schema = "question_id long, rank int, passage_id long, score double"
    dense = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.5), (1, 3, 12, 0.1)], schema)
    words = spark.createDataFrame([(1, 1, 12, 8.0), (1, 2, 13, 4.0)], schema)
    assert rows(sparse.fuse(dense, words, 3)) == [
        (1, 1, 10, 0.5), (1, 2, 12, 0.5), (1, 3, 11, 0.25)]
    got = rows(sparse.fuse_ranks(dense, words, 1))
    assert got == [(1, 1, 12, round(1 / 63 + 1 / 61, 9))]


def clustered(spark, n, centres, name, seed):
    draw = np.random.default_rng(seed)
    points = centres[draw.integers(0, len(centres), n)] + draw.normal(0, 0.05, (n, centres.shape[1]))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(points)],
                                 f"{name} long, vector array<double>")


def test_index_recall_and_storage(spark, rows):
    centres = np.random.default_rng(0).normal(size=(16, 12))
    passages = clustered(spark, 1500, centres, "passage_id", 1).selectExpr(
        "passage_id", "cast(vector as array<float>) as vector")
    questions = clustered(spark, 40, centres, "question_id", 2)
    cells = ann.train_cells(passages, 16)
    folder = tempfile.mkdtemp(prefix="index-")
    ann.write_index(ann.build_index(passages, cells), folder, rows_per_file=50)
    index = ann.read_index(spark, folder)
    assert index.count() == 1500
    exact = scoring.top_passages(questions, passages, 10)
    few = ann.search(questions, index, cells, 10, 2)
    assert ann.recall(few, exact).first().recall >= 0.9
    assert rows(ann.search(questions, index, cells, 10, 16)) == rows(exact)
    plan = index.where("cell = 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan


@pytest.mark.parametrize("limit", [0, 1000])
def test_attach_and_export(spark, rows, limit):
    ranked = spark.createDataFrame([(1, 2, 20, 0.5), (1, 1, 10, 0.9), (2, 1, 10, 0.8)],
                                   "question_id long, rank int, passage_id long, score double")
    passages = spark.createDataFrame([(10, "t", "x"), (20, "u", "y")],
                                     "passage_id long, title string, text string")
    got = retrieval.attach_passages(ranked, passages, limit, hot_rows=1)
    assert rows(retrieval.export_lists(got)) == [(1, ["x", "y"], [0.9, 0.5]), (2, ["x"], [0.8])]
    asked = spark.createDataFrame([(1, "q1"), (2, "q2")], "question_id long, text string")
    prompts = rows(retrieval.context_prompts(got, asked), "question_id", "rank", "prompt")
    assert prompts[1] == (1, 2, "u 글: y질문: q1")


def test_encoders(spark):
    frame = spark.createDataFrame([(1, "A b a"), (2, ""), (3, None)], "passage_id long, text string")
    got = {r[0]: np.array(r[1]) for r in embedding.hashed_vectors(
        frame, "passage_id", "text", 32).collect()}
    assert np.linalg.norm(got[1]) == pytest.approx(1.0)
    assert sorted(got[1][got[1] > 0] ** 2) == pytest.approx([0.2, 0.8])
    assert not got[2].any() and not got[3].any()
    sizes = []

    def lengths(batch):
        sizes.append(len(batch))
        return np.array([[len(t or ""), 1.0] for t in batch])

    own = embedding.embed(frame, "passage_id", "text", lengths, batch_size=2).collect()
    assert sorted(tuple(r.vector) for r in own) == [(0.0, 1.0), (0.0, 1.0), (5.0, 1.0)]


@pytest.mark.parametrize("terms", [10_000, 0])
def test_bm25_without_a_match(spark, terms):
    asked = spark.createDataFrame([(1, "nothing here")], "question_id long, text string")
    stored = spark.createDataFrame([(1, "some words"), (2, "")], "passage_id long, text string")
    assert sparse.bm25_top(asked, stored, 5, broadcast_terms=terms).count() == 0
    assert sparse.bm25_top(asked, stored.where("false"), 5, broadcast_terms=terms).count() == 0


def test_fixed_cells_have_all_centres_of_the_rule(spark, monkeypatch):
    """The SQL takes every 50th vector: no bound on cells may drop centres."""
    monkeypatch.setattr(ann, "MOST_CELLS", 2)
    draw = np.random.default_rng(3).normal(size=(400, 8))
    stored = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(draw)],
                                   "passage_id long, vector array<double>")
    monkeypatch.setattr(registry, "vectors", lambda *a: stored)
    centres = draw[::50]
    near = ((centres * centres).sum(axis=1) - 2 * draw @ centres.T).argmin(axis=1)
    got = {r["passage_id"]: r["cell"] for r in registry.ann_fixed_cells(spark, "").collect()}
    assert got == dict(enumerate(map(int, near)))


def test_registered_search_has_its_recall(spark):
    """Eight probes of 44 cells would find about half of the neighbours."""
    assert registry.ann_recall(spark, "/root/testdata/sf0.1").first().recall >= 0.9


@pytest.mark.parametrize("most", [None, 17])
def test_blocks_of_questions_probe_like_single_ones(spark, rows, most):
    """Probed cells by brute force; a vector is not repeated for its probes."""
    draw = np.random.default_rng(12)
    points, asked = draw.integers(-3, 4, (700, 6)).astype(float), draw.normal(size=(60, 6)).round(2)
    cells = draw.normal(size=(20, 6))
    stored = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "passage_id long, vector array<double>")
    questions = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], "question_id long, vector array<double>")
    index = ann.build_index(stored, cells).repartition(3).cache()
    home = (((cells * cells).sum(axis=1) - 2 * points @ cells.T).round(9)).argmin(axis=1)
    away = np.argsort(((cells * cells).sum(axis=1) - 2 * asked @ cells.T).round(9), axis=1, kind="stable")
    for n in (3, 20):
        want = []
        for q in range(60):
            near = np.flatnonzero(np.isin(home, away[q, :n]))
            score = np.round(points[near] @ asked[q], 9)
            best = np.lexsort((near, -score))[:8]
            want += [(q, r + 1, int(near[b]), float(score[b])) for r, b in enumerate(best)]
        assert rows(ann.search(questions, index, cells, 8, n, most)) == sorted(want, key=repr)
    laid = ann._with_probes(questions.selectExpr("question_id", "vector", "0 as block"), cells, 20)
    assert laid.count() == 60


def test_counting_in_slices_gives_the_same_vectors(spark, rows, monkeypatch):
    frame = spark.createDataFrame([(i, f"w{i % 7} w{i}") for i in range(90)], "passage_id long, text string").coalesce(1)
    whole = rows(embedding.hashed_vectors(frame, "passage_id", "text", 16))
    monkeypatch.setattr(embedding, "COUNTED_TEXTS", 7)
    assert rows(embedding.hashed_vectors(frame, "passage_id", "text", 16)) == whole


def test_dense_and_bm25_lists_read_the_words_of_a_passage_once(spark, monkeypatch):
    """Both lists come from one stored table of words; texts are split when it is written."""
    stored = []
    monkeypatch.setattr(registry, "passages", lambda *a: spark.createDataFrame(
        [(i, "T", f"w{i} common x{i % 3}") for i in range(60)], "passage_id long, title string, text string"))
    monkeypatch.setattr(registry, "benchmark_questions", lambda *a: spark.createDataFrame(
        [(1, "w7 common"), (2, "x1")], "question_id long, text string"))
    written = registry.written_once
    monkeypatch.setattr(registry, "written_once", lambda rows: stored.append(written(rows)) or stored[-1])
    dense, ranked = registry._both_lists(spark, "")
    assert [t.columns for t in stored] == [["passage_id", "title", "words"]]
    assert dense.where("question_id = 1 and rank = 1").first()["passage_id"] == 7
    assert ranked.where("question_id = 1 and rank = 1").first()["passage_id"] == 7


def test_stored_words_give_the_lists_of_the_texts(spark, rows):
    """Titles and texts missing, empty, and ending where the title's tag begins; repeated and absent words."""
    texts = [("A b", "Ab, c  ab."), (None, "ab c"), ("", ""), ("ab", None), ("ΑΣ", "Σ ab\u0301 É 12"), ("x.", "...")] * 40
    passages = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "passage_id long, title string, text string")
    asked = spark.createDataFrame([(1, "ab c"), (2, "É ας σ"), (3, None), (4, "absent"), (5, "c c x")],
                                  "question_id long, text string")
    listed = corpus.passage_words(passages)
    assert rows(retrieve.dense_retrieval(asked, listed, 200, 16)) == rows(retrieve.dense_retrieval(asked, passages, 200, 16))
    for limit in (100, 2):
        assert rows(sparse.bm25_top(asked, listed, 200, broadcast_terms=limit)) == rows(
            sparse.bm25_top(asked, passages, 200, broadcast_terms=limit))


def test_equal_words_are_hashed_once(monkeypatch):
    calls, md5 = [], hashlib.md5
    monkeypatch.setattr(embedding.hashlib, "md5", lambda w, **k: calls.append(w) or md5(w, **k))
    slots = embedding.word_slots(pa.array(["b", "a", "b", "글"] * 5), 100)
    assert sorted(calls) == sorted(w.encode() for w in ("a", "b", "글"))
    assert slots.tolist() == [int(md5(w.encode()).hexdigest()[:8], 16) % 100 for w in ["b", "a", "b", "글"] * 5]
    assert embedding.word_slots(pa.array([], pa.string()), 100).tolist() == []


@pytest.mark.parametrize("columns", [3, 100_000])
def test_sums_of_pairs(columns):
    """A well filled table and one that would not fit give the sums of the pairs that occur, zeros included."""
    row, column = np.array([5, 5, 9, 9, 9, 5]), np.array([2, 0, 1, 1, 2, 2])
    got = sparse._pair_sums(row, column, columns, np.array([1.0, 0.0, 2.0, 4.0, 8.0, 16.0]))
    assert list(zip(*(x.tolist() for x in got))) == [(5, 0, 0.0), (5, 2, 17.0), (9, 1, 6.0), (9, 2, 8.0)]
