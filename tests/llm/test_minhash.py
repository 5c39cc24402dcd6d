"""Near duplicates against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from answerloom.llm import minhash
from answerloom.llm.components import components
from answerloom.llm.minhash import min_max, near_duplicates, one_per_group


def shingles(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).split() if text else []
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else (
        {tuple(words)} if words else set())


def brute(rows, share=85):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= share * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {(i, len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed, originals=12, copies=14):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(originals):
        base = [draw.choice(words) for _ in range(draw.choice([3, 6, 9, 40, 120, 300]))]
        for _ in range(draw.randint(1, copies)):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                text[draw.randrange(len(text))] = draw.choice(words)
            base = text if draw.random() < 0.4 else base
            out.append(" ".join(text).upper() if draw.random() < 0.2 else "  ".join(text))
    draw.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("block", [1000, 3])
def test_all_pairs(spark, block, monkeypatch):
    # Small blocks make the second pass deal every bucket over several of them.
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = [*corpus(block), (900, None), (901, ""), (902, " \n\t"), (903, "one two"), (904, "ONE\ttwo"), (905, "one")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, rep string, bucket int")
    got = {tuple(r) for r in near_duplicates(frame).collect()}
    assert got == brute(rows)


def test_star_that_the_hub_does_not_explain(spark):
    """Links that only other members of a bucket hold are found in the second pass."""
    draw = random.Random(8)
    base = [f"t{i}" for i in range(200)]
    chain, rows = list(base), []
    for i in range(12):
        rows.append((i, " ".join(chain)))
        chain[10 * i + 5] = f"n{draw.random()}"
        chain[10 * i + 9] = f"n{draw.random()}"
    order = list(range(12))
    draw.shuffle(order)
    rows = [(order[i], t) for i, t in rows]
    got = {tuple(r) for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == brute(rows) and {r[2] for r in got} == {0}


def test_doubled_rows_hide_no_bucket(spark, monkeypatch):
    """Two buckets with the same ends and other middles, each with a link of its own, all rows twice."""
    def text(no, changed=None):
        return " ".join("new" if i == changed else f"t{no}x{i}" for i in range(100))

    rows = [(0, text(0)), (1, text(1)), (2, text(1, 50)), (3, text(3)), (4, text(3, 50)), (9, text(9))]
    first, second = 32 * 100, 32 * 200 + 1
    bands = {0: (first, second), 9: (first, second), **{i: (first, 32 * i + 1) for i in (1, 2)},
             **{i: (32 * i, second) for i in (3, 4)}}
    real = minhash.signed
    given = F.create_map(*[x for i, pair in bands.items() for x in (
        F.lit(i).cast("bigint"), F.array(*[F.lit(b).cast("bigint") for b in pair]))])
    monkeypatch.setattr(minhash, "signed", lambda *a: real(*a).withColumn("bands", given[F.col("doc_id")]))
    frame = spark.createDataFrame(rows + rows, "doc_id bigint, text string")
    got = [tuple(r) for r in near_duplicates(frame).collect()]
    assert len(got) == 12 and set(got) == brute(rows)


def test_null_and_repeated_ids(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(4, text), (4, text), (None, text), (None, "lonely words here"), (9, text), (None, None)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in near_duplicates(frame).collect()), key=str)
    assert got == sorted([(4, 26, 4, True), (4, 26, 4, True), (None, 26, 4, False), (None, 1, None, True),
                          (9, 26, 4, False), (None, 0, None, True)], key=str)
    kept = sorted((tuple(r) for r in one_per_group(frame).collect()), key=str)
    assert kept == sorted([(4, text), (None, "lonely words here"), (None, None)], key=str)
    # A text found nowhere else stays, whoever shares its id; copies without id are copies.
    other = " ".join(f"b{i}" for i in range(30))
    rows = [(1, text), (1, other), (2, text), (None, text), (None, "same words"), (None, "same words"), (None, ""), (7, None)]
    kept = one_per_group(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, row int"))
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted(
        [(1, text), (1, other), (None, "same words"), (None, ""), (7, None)], key=str)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_pairs_between_the_two_thresholds(spark):
    """The pipeline's stage joins copies of similarity 0.80 to 0.85, op10 does not."""
    assert minhash.limits(85).rows == 5 and minhash.limits(80).rows == 4
    rows = []
    for no in range(200):
        words = [f"t{no}x{i}" for i in range(99 + no % 20)]
        rows.append((2 * no, " ".join(words)))
        words[20], words[60] = "new", "newer"
        rows.append((2 * no + 1, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(0.8 <= len(a & b) / len(a | b) < 0.85
               for a, b in ((shingles(x), shingles(y)) for (_, x), (_, y) in zip(rows[::2], rows[1::2])))
    assert {tuple(r) for r in near_duplicates(frame, share=80).collect()} == brute(rows, 80)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "")
    assert {r["doc_id"] for r in kept.collect()} == set(range(0, 400, 2))
    with pytest.raises(ValueError):
        minhash.limits(50)


def test_signature_is_unbiased():
    draw = np.random.Generator(np.random.PCG64(1))
    common, a, b = (draw.integers(0, 1 << 63, n, dtype=np.uint64) for n in (600, 200, 200))
    agree = []
    for _ in range(1):
        left, right = np.concatenate([common, a]), np.concatenate([common, b])
        x = min_max(np.concatenate([left, right]), np.array([0, len(left)]))
        agree.append((x[0] == x[1]).mean())
    assert abs(np.mean(agree) - 0.6) < 0.15


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
