"""Both sides of every size switch give the same rows and the same columns."""

import re
import types

import numpy as np
import pyarrow as pa
import pytest

from answerloom.operators import ann, contrastive, dedup, retrieval, scoring, skew, sparse, stored, tokens


def shown(frame):
    return frame.columns, sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def articles(spark):
    rows = [(7, "t", "x"), (8, "t", "x"), (None, "t", "x"), (1, "t", "y"), (1, "t", "y"), (None, "t", "z"),
            (None, None, None), (3, None, None), (None, "u", "alone"), (None, "u", "alone"), (9, "t", None)]
    return spark.createDataFrame(rows, "article_id bigint, title string, text string")


def test_drop_copies(articles):
    want = [(1, "t", "y"), (1, "t", "y"), (3, None, None), (7, "t", "x"), (9, "t", None), (None, "t", "z"),
            (None, "u", "alone"), (None, "u", "alone")]
    for limit in (100, 0):
        columns, rows = shown(dedup.dedup_articles(articles, limit))
        assert columns == articles.columns and rows == sorted(want, key=repr)


def test_duplicate_groups(spark):
    frame = spark.createDataFrame([(4, "a", "b"), (2, "a", "b"), (2, "a", "b"), (5, "a", "c"), (5, "a", "c")],
                                  "id bigint, title string, text string")
    assert shown(dedup.duplicate_groups(frame, ["title", "text"], "id")) == (
        ["title", "text", "first_id", "last_id", "n_rows"], [("a", "b", 2, 4, 3)])


def test_remapped_ids(spark, articles):
    mapping = spark.createDataFrame([(8, 7), (1, 0)], "old_id bigint, new_id bigint")
    found = [shown(dedup.remap_ids(articles, mapping, "article_id", "text", limit)) for limit in (100, 0)]
    assert found[0] == found[1] and found[0][0] == articles.columns and len(found[0][1]) == 11


def test_encode(spark):
    vocab = spark.createDataFrame([("a", 8), ("b", 9)], "token string, token_id int")
    rows = spark.createDataFrame([(1, "k", "a b"), (1, "l", "b q a"), (None, "m", "a"), (2, "n", None), (3, "o", "")],
                                 "id bigint, kept string, text string")
    want = [(1, "k", [8, 9]), (1, "l", [9, 1, 8]), (2, "n", []), (3, "o", []), (None, "m", [8])]
    for limit in (100, 0):
        columns, got = shown(tokens.encode(rows, "id", {"ids": ("text", 5)}, vocab, limit, keep=("kept",)))
        assert columns == ["id", "kept", "ids"] and got == sorted(want, key=repr)


def test_decode(spark):
    vocab = spark.createDataFrame([("</s>", 7), ("a", 8), ("b", 9)], "token string, token_id int")
    rows = spark.createDataFrame([(1, [2, 9, 8, 8, 3, 0]), (1, [7, 1]), (None, [8]), (2, None), (3, [])],
                                 "id bigint, ids array<int>")
    for limit in (100, 0):
        columns, got = shown(tokens.decode(rows, "id", "ids", vocab, broadcast_rows=limit))
        assert columns == ["id", "text"]
        assert got == sorted([(1, "b a a"), (1, ""), (None, "a"), (2, None), (3, "")], key=repr)


def test_vocabulary_has_every_token(spark):
    texts = spark.createDataFrame([(" ".join(f"w{i}" for i in range(j)),) for j in range(1, 60)], "text string")
    rows = tokens.vocabulary(texts.repartition(5), "text").collect()
    assert {r.token: r.token_id for r in rows if r.token_id >= tokens.FIRST_WORD} == {
        f"w{i}": tokens.FIRST_WORD + i for i in range(59)}
    assert len(tokens.vocabulary(texts, "text", 3).collect()) == 3 + len(tokens.TAGS)


def test_attached_passages(spark):
    ranked = spark.createDataFrame([(1, 1, 5, 0.5), (2, 1, 5, 0.4), (2, 2, 6, 0.1), (3, 1, None, 0.0)],
                                   "question_id bigint, rank int, passage_id bigint, score double")
    texts = spark.createDataFrame([(5, "t", "x"), (6, None, None), (None, "n", "n")],
                                  "passage_id bigint, title string, text string")
    found = [shown(retrieval.attach_passages(ranked, texts, limit)) for limit in (100, 0)]
    assert found[0] == found[1]
    assert found[0][0] == ["passage_id", "title", "text", "question_id", "rank", "score"] and len(found[0][1]) == 3


def test_bm25_keeps_scores_that_round_to_nothing(spark, monkeypatch):
    # Every passage has the word, so its weight is tiny; repeated ids and empty texts take part.
    passages = spark.createDataFrame([(i, "common") for i in range(300)] + [(500, ""), (501, None), (502, "rare common")],
                                     "passage_id bigint, text string")
    questions = spark.createDataFrame([(1, "common"), (2, "rare rare"), (3, "absent"), (4, "common rare"), (5, None)],
                                      "question_id bigint, text string")
    found = [shown(sparse.bm25_top(questions, passages, 4, broadcast_terms=limit)) for limit in (100, 2)]
    assert found[0] == found[1]
    assert {r[0] for r in found[0][1]} == {1, 2, 4} and sum(r[0] == 1 for r in found[0][1]) == 4


def test_bm25_with_very_many_questions(spark):
    passages = spark.createDataFrame([(i, f"p{i % 50} q{i % 7}") for i in range(400)], "passage_id bigint, text string")
    questions = spark.range(20_000).selectExpr("id as question_id", "concat('p', id % 50, ' q', id % 7) as text")
    got = sparse.bm25_top(questions, passages, 1)
    assert got.count() == 20_000 and got.where("score <= 0").count() == 0


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup(spark, how):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, "d")], "k bigint, x string")
    right = spark.createDataFrame([(1, "one"), (3, "three"), (None, "none")], "k bigint, y string")
    found = [shown(skew.lookup(left, right, ["k"], how, left["x"], limit, 1)) for limit in (100, 0)]
    assert found[0] == found[1]


def test_stored_tables_need_a_shared_folder(spark):
    conf = types.SimpleNamespace(get=lambda key, default: None)
    for master in ("yarn", "k8s://x", "local-cluster[2,1,1024]", "spark://host:7077"):
        context = types.SimpleNamespace(master=master, applicationId="x")
        with pytest.raises(ValueError):
            stored.shared_folder(types.SimpleNamespace(conf=conf, sparkContext=context))
    before = spark.sparkContext.getCheckpointDir()
    assert stored.written_once(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir() == before
    assert stored.drop_stored(spark) >= 1 and stored.drop_stored(spark) == 0


def test_a_probe_reads_its_cell_only(spark, tmp_path, capsys):
    vectors = spark.createDataFrame([(i, [float(i % 8), float(i % 3)]) for i in range(200)],
                                    "passage_id bigint, vector array<double>")
    centres = np.array([[float(i), 1.0] for i in range(8)])
    ann.write_index(ann.build_index(vectors, centres), str(tmp_path / "index"))
    index = ann.read_index(spark, str(tmp_path / "index"))
    probes = ann.nearest_cells(spark.createDataFrame([(1, [3.0, 1.0])], "question_id bigint, vector array<double>"),
                               "question_id", centres, 1)
    part = ann.probed(index, probes)
    capsys.readouterr()
    part.explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert len(filters) == 1 and re.search(r"cell#\d+ = 3\)|cell#\d+ IN \(3\)", filters[0])
    assert {r["cell"] for r in part.collect()} == {3} and index.count() > part.count() > 0


def test_vectors_that_are_missing_or_uneven_are_refused():
    for column in ([[1.0, 2.0], None], [[1.0], [1.0, 2.0]], [[1.0, None], [1.0, 2.0]], [[1.0] * 4, [1.0] * 2, None]):
        with pytest.raises(ValueError):
            scoring._matrix(pa.array(column, pa.list_(pa.float64())))


def test_empty_corpus_loses_no_question(spark):
    pairs = spark.createDataFrame([(1, [1.0], [2.0]), (2, [1.0], [3.0])],
                                  "pair_id bigint, question_vector array<double>, passage_vector array<double>")
    nothing = spark.createDataFrame([], "passage_id bigint, vector array<double>")
    assert {tuple(r) for r in contrastive.gold_ranks(pairs, nothing).collect()} == {(1, 2.0, 1), (2, 3.0, 1)}
    assert {tuple(r) for r in contrastive.corpus_loss(pairs, nothing).collect()} == {(1, 0.0, 0, 1), (2, 0.0, 0, 1)}


def test_queue_blocks_give_the_same_losses(spark):
    draw = np.random.Generator(np.random.PCG64(9))
    rows = [(i, [float(x) for x in draw.normal(size=3)], [float(x) for x in draw.normal(size=3)]) for i in range(41)]
    pairs = spark.createDataFrame(rows, "seq bigint, question_vector array<double>, passage_vector array<double>")
    found = []
    for blocks in ({}, {"question_block": 3, "key_block": 5}, {"question_block": 16, "key_block": 2}):
        got = contrastive.queue_loss(pairs, 12, 4, 0.5, **blocks).collect()
        found.append(sorted((r["seq"], round(r["loss"], 9), r["positive_rank"], r["n_negatives"]) for r in got))
    assert found[0] == found[1] == found[2] and len(found[0]) == 41
    assert [r[3] for r in found[0]] == [min(12, i // 4 * 4) for i in range(41)]
