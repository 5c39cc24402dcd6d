import pytest
from pyspark.sql import functions as F

from answerloom.operators import tokens

CORPUS = ["b a a c", "a b, B! 질문: x"]


@pytest.fixture
def vocab(spark):
    frame = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    return tokens.vocabulary(frame, "text", 4)


def test_vocabulary(vocab, rows):
    got = dict(rows(vocab))
    assert {t: got[t] for t in ("제목:", "글:", "질문:", "</s>")} == tokens.TAGS
    assert (got["a"], got["b"], got["!"], got[","]) == (8, 9, 10, 11)
    assert len(got) == 8


def ids(frame, key, column):
    return {r[key]: list(r[column]) for r in frame.collect()}


@pytest.mark.parametrize("partitions", [1, 6])
def test_encode(spark, vocab, partitions):
    frame = spark.createDataFrame(
        [(1, "a b zzz a 질문: </s>"), (2, ""), (3, None)], "id long, x string").repartition(partitions)
    for limit in (100, 3):
        encoded = tokens.encode(frame, "id", {"ids": ("x", 5), "two": ("x", 2)}, vocab, limit)
        assert ids(encoded, "id", "ids") == {1: [8, 9, 1, 8, 6], 2: [], 3: []}
        assert ids(encoded, "id", "two") == {1: [8, 9], 2: [], 3: []}
    got = tokens.encode_questions(frame, "id", "x", vocab, 6)
    assert ids(got, "id", "input_ids") == {1: [2, 8, 9, 1, 8, 3], 2: [2, 3, 0, 0, 0, 0],
                                           3: [2, 3, 0, 0, 0, 0]}
    assert ids(got, "id", "attention_mask")[2] == [1, 1, 0, 0, 0, 0]


@pytest.mark.parametrize("a,b,length,want", [
    (2, 3, 10, (2, 3)), (2, 50, 12, (2, 7)), (50, 2, 12, (7, 2)), (50, 50, 12, (5, 4)),
    (50, 50, 13, (5, 5)), (5, 4, 12, (5, 4)), (6, 4, 12, (5, 4)), (0, 0, 5, (0, 0))])
def test_longest_part_is_cut_first(spark, vocab, a, b, length, want):
    frame = spark.createDataFrame([(1, " ".join("a" * a), " ".join("b" * b))],
                                  "id long, t string, x string")
    row = tokens.encode_pairs(frame, "id", "t", "x", vocab, length).first()
    body = [2] + [8] * want[0] + [3] + [9] * want[1] + [3]
    assert row.input_ids == body + [0] * (length - len(body))
    assert sum(row.attention_mask) == len(body)
    assert sum(row.token_type_ids) == want[1] + 1
    assert len(row.input_ids) == len(row.attention_mask) == len(row.token_type_ids) == length


def test_seq2seq_limits(spark, vocab):
    frame = spark.createDataFrame([(1, "a b a b", "b a </s>")], "id long, s string, t string")
    row = tokens.encode_seq2seq(frame, "id", "s", "t", vocab, 3, 2).first()
    assert (row.input_ids, row.attention_mask, row.labels) == ([8, 9, 8], [1, 1, 1], [9, 8])


def test_pad_and_trim(spark):
    frame = spark.createDataFrame([(1, 0, [5, 6, 7]), (2, 0, [5]), (3, 1, [9])],
                                  "id long, batch_id long, ids array<int>")
    assert ids(tokens.pad_batches(frame), "id", "ids") == {1: [5, 6, 7], 2: [5, 0, 0], 3: [9]}
    wide = spark.createDataFrame(
        [(1, 0, [5, 0, 6, 0], [1, 1, 1, 0]), (2, 0, [7, 0, 0, 0], [1, 0, 0, 0]),
         (3, 1, [0, 0, 0, 0], [0, 0, 0, 0])],
        "id long, batch_id long, ids array<int>, mask array<int>")
    got = tokens.trim_batches(wide, ["ids", "mask"])
    assert ids(got, "id", "ids") == {1: [5, 6], 2: [7, 0], 3: []}
    assert ids(got, "id", "mask") == {1: [1, 1], 2: [1, 0], 3: []}


def test_batch_tokens(spark, rows):
    frame = spark.createDataFrame([(0, [5, 0], [7]), (0, [5, 6], [7, 8, 0])],
                                  "batch_id long, s array<int>, t array<int>")
    assert rows(tokens.batch_tokens(frame, "s", "t")) == [(0, 2, 6, 2.0)]


def test_encoding_is_narrow(spark, vocab):
    frame = spark.range(100).select("id", F.lit("a b").alias("x"))
    plan = tokens.encode(frame, "id", {"ids": ("x", 9)}, vocab)._jdf.queryExecution()
    assert "Exchange" not in plan.executedPlan().toString()


@pytest.mark.parametrize("partitions", [1, 5])
def test_training_pairs_stay_aligned(spark, vocab, partitions):
    frame = spark.createDataFrame(
        [(i, "a" if i % 2 else "b", "a", "b b", 10 + i, i % 3) for i in range(20)],
        "id long, question string, title string, text string, article_id long, paragraph_id int")
    got = tokens.encode_training_pairs(frame.repartition(partitions), "id", vocab, 4, 8).collect()
    assert len(got) == 20
    for r in got:
        assert (r.article_id, r.paragraph_id) == (10 + r.id, r.id % 3)
        assert r.question_input_ids == [2, 8 if r.id % 2 else 9, 3, 0]
        assert r.context_input_ids == [2, 8, 3, 9, 9, 3, 0, 0]
        assert r.context_token_type_ids == [0, 0, 0, 1, 1, 1, 0, 0]
        assert (r.question_attention_mask, sum(r.context_attention_mask)) == ([1, 1, 1, 0], 6)


def test_vocabulary_stays_in_arrow(spark):
    """No list of Python strings for every worker: pandas is not needed, unknown tokens keep their id."""
    assert not hasattr(tokens, "pd")
    vocab = spark.createDataFrame([("a", 8), ("b", 9)], "token string, token_id int")
    rows_ = spark.createDataFrame([(1, "b a x"), (2, ""), (3, None)], "id long, text string")
    got = {r["id"]: r["ids"] for r in tokens.encode(rows_, "id", {"ids": ("text", 9)}, vocab).collect()}
    assert got == {1: [9, 8, tokens.UNKNOWN], 2: [], 3: []}


def test_only_rare_tokens_meet_a_join(spark, monkeypatch):
    """A vocabulary over the limit: frequent ids are looked up in place, places of the others alone are unrolled."""
    vocab = spark.createDataFrame([("</s>", 7), *((f"w{i}", 8 + i) for i in range(40))], "token string, token_id int")
    texts = {1: "w0 w1 w35 w0 zz w36", 2: "w2 " * 50, 3: "w39", 4: "", 5: None}
    frame = spark.createDataFrame([(i, t, "w38 w1") for i, t in texts.items()], "id long, x string, y string")
    met, join = [], tokens.skew_join
    monkeypatch.setattr(tokens, "skew_join", lambda left, *a: met.append(left.count()) or join(left, *a))
    small, large = (tokens.encode(frame, "id", {"a": ("x", 60), "b": ("y", 2)}, vocab, limit) for limit in (100, 20))
    for name in ("a", "b"):
        assert ids(large, "id", name) == ids(small, "id", name)
    assert ids(large, "id", "a")[1] == [8, 9, 43, 8, tokens.UNKNOWN, 44]
    assert met == [9]
