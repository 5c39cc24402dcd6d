import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from answerloom.operators import answers, metrics
from test_text import scanned

PAIR = "id long, prediction string, gold string"


def merged_f1(prediction, gold):
    """Both sorted word lists are walked side by side; equal heads are a match."""
    p, g = (sorted(scanned(text).split(" ")) if scanned(text) else [] for text in (prediction, gold))
    i = j = same = 0
    while i < len(p) and j < len(g):
        if p[i] == g[j]:
            i, j, same = i + 1, j + 1, same + 1
        elif p[i] < g[j]:
            i += 1
        else:
            j += 1
    return 2 * same / (len(p) + len(g)) if same else 0.0


def test_f1_fixtures(spark):
    frame = spark.createDataFrame([(1, "a b b c", "b b d"), (2, "", ""), (3, "x", "y"),
                                   (4, None, "x")], PAIR)
    got = {r.id: r.f1 for r in answers.token_f1(frame, ["id"]).collect()}
    assert got[1] == pytest.approx(2 / 3)
    assert (got[2], got[3], got[4]) == (0.0, 0.0, 0.0)
    matched = {r.id: r.exact_match for r in answers.exact_match(frame).collect()}
    assert (matched[1], matched[2]) == (0, 1)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.text(alphabet="ab t he.,-é\n", max_size=30),
                          st.text(alphabet="ab t he.,-é\n", max_size=30)),
                min_size=10, max_size=30))
def test_f1_matches_the_definition(spark, pairs):
    frame = spark.createDataFrame([(i, p, g) for i, (p, g) in enumerate(pairs)], PAIR)
    for row in answers.token_f1(frame.repartition(3), ["id"]).collect():
        assert row.f1 == pytest.approx(merged_f1(*pairs[row.id]))


def test_corpus_scores(spark):
    frame = spark.createDataFrame([(1, "The cat", "cat"), (2, "x", "y")], PAIR)
    assert tuple(answers.corpus_exact_match(frame).first()) == (2, 0.5)
    assert tuple(answers.corpus_exact_match(frame.where("id < 0")).first()) == (0, 0.0)
    golds = spark.createDataFrame([(1, 0, "cat sat", "dog"), (1, 1, "cat sat", "the cat"),
                                   (2, 0, "x", "X.")],
                                  "id long, gold_no int, prediction string, gold string")
    scores = answers.squad_scores(golds, "id", "gold_no").first()
    assert scores.n_questions == 2 and scores.exact_match == 50.0
    assert scores.f1 == pytest.approx(100 * (2 / 3 + 1) / 2)


def test_marginalize(spark):
    table = [(1, 1, 2.0, "x", -0.5), (1, 1, 2.0, "y", -1.0), (1, 2, 1.0, "y", -0.1),
             (2, 5, -1000.0, "z", -3.0), (2, 6, -1000.0, "w", -3.0)]
    frame = spark.createDataFrame(
        table, "question_id long, passage_id long, doc_score double, answer string, logprob double")
    got = {r.question_id: (r.answer, r.logprob) for r in answers.marginalize_answers(frame).collect()}
    z1, z2 = (math.exp(s) / (math.exp(2) + math.exp(1)) for s in (2, 1))
    x, y = z1 * math.exp(-0.5), z1 * math.exp(-1) + z2 * math.exp(-0.1)
    assert got[1][0] == ("x" if x > y else "y")
    assert got[1][1] == pytest.approx(math.log(max(x, y)), abs=1e-8)
    assert got[2] == ("w", pytest.approx(-3 + math.log(0.5)))


def test_histories(spark, rows):
    frame = spark.createDataFrame(
        [("r", "acc", 0, 0.2), ("r", "acc", 1, 0.5), ("r", "acc", 2, 0.4), ("r", "acc", 3, 0.5)],
        "run string, name string, epoch int, value double")
    assert [r.best for r in metrics.best_so_far(frame).orderBy("epoch").collect()] == [
        0.2, 0.5, 0.5, 0.5]
    assert [r.best for r in metrics.best_so_far(frame, True).orderBy("epoch").collect()] == [0.2] * 4
    assert rows(metrics.best_epoch(frame)) == [("r", "acc", 1, 0.5)]
    assert rows(metrics.best_epoch(frame, True)) == [("r", "acc", 0, 0.2)]


def test_batch_means(spark, rows):
    frame = spark.createDataFrame([(0, "val", "loss", 1.0, 3), (0, "val", "loss", 2.0, 1)],
                                  "epoch int, split string, name string, value double, n_rows int")
    assert rows(metrics.batch_means(frame)) == [(0, "val", "loss", 2, 1.5, 1.25)]


def test_classes(spark, rows):
    frame = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "target int, pred int")
    assert rows(metrics.confusion_matrix(frame)) == [(0, 0, 1), (0, 1, 1), (1, 1, 2), (2, 0, 1)]
    got = {r["class"]: r for r in metrics.class_scores(frame).collect()}
    assert got[1].precision == pytest.approx(2 / 3) and got[1].recall == 1.0
    assert (got[2].precision, got[2].recall, got[2].f1, got[2].support) == (0.0, 0.0, 0.0, 1)


def test_argmax_accuracy(spark):
    frame = spark.createDataFrame([(1, 0, 0, 0.5), (1, 0, 1, 0.5), (2, 1, 0, 0.1), (2, 1, 1, 0.3)],
                                  "row_id long, target int, class int, score double")
    assert tuple(metrics.argmax_accuracy(frame).first()) == (2, 1.0)
