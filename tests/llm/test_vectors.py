"""Exact and approximate search against all products."""

import math

import numpy as np
import pytest

from answerloom.llm import curves, kdtree
from answerloom.llm.curves import hilbert_keys, near_top
from answerloom.llm.kdtree import exact_top, search_tree

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute(rows, every, k, value):
    out = []
    for q, x in rows:
        if q % every == 0:
            scored = sorted((-value(x, y), c) for c, y in rows if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored)]
    return out


def integer(x, y):
    return sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(x, y))


def vectors(n, width, seed, repeats=0):
    draw = np.random.Generator(np.random.PCG64(seed))
    x = draw.normal(size=(n, width)).astype(np.float32)
    x[n - repeats:] = x[0]
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


@pytest.mark.parametrize("shard", [64, 8192])
def test_exact_top(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "BLOCK_QUERIES", 16)
    rows = vectors(300, 5, 1, repeats=90)
    got = sorted(tuple(r) for r in exact_top(frame(spark, rows), 7, 6).collect())
    assert got == sorted(brute(rows, 7, 6, integer))


def test_leaves_hold_every_row_once(monkeypatch):
    monkeypatch.setattr(kdtree, "LEAF_ROWS", 8)
    values = np.random.Generator(np.random.PCG64(1)).normal(size=(100, 3))
    values[40:] = 1.5
    parts = kdtree.leaves(values)
    assert sorted(np.concatenate(parts)) == list(range(100)) and max(map(len, parts)) <= 8


@pytest.mark.parametrize("scale", [1.0, 1e9, 1e30])
def test_tree_of_large_numbers(scale):
    draw = np.random.Generator(np.random.PCG64(2))
    rows = np.floor(draw.normal(size=(40, 3)) * 64 * scale)
    ids = np.arange(40)
    number, vec, score = search_tree(ids[:4], rows[:4], np.full(4, -np.inf), ids, rows, np.array([20, 40]), 5)
    for q in range(4):
        exact = {j: max(-(1 << 63), min((1 << 63) - 1, sum(int(a) * int(b) for a, b in zip(rows[q], rows[j]))))
                 for j in range(40) if j != q}
        want = sorted(exact, key=lambda j: (-exact[j], j))[:5]
        assert [int(v) for v in vec[number == q]] == want
        assert [int(s) for s in score[number == q]] == [exact[j] for j in want]


ODD = [(0, [1.0, 0.5]), (7, [1.0, 0.5]), (7, [0.5, 9.0]), (14, None), (21, [float("nan"), 1.0]), (28, [None, 1.0]),
       (None, [5.0, 5.0]), (3, [0.25]), (35, [0.0, 0.0]), (4, [float("inf"), 0.0])]


def test_rows_that_take_no_part(spark):
    found = sorted(tuple(r) for r in exact_top(frame(spark, ODD), 7, 3).collect())
    usable = [(0, [1.0, 0.5]), (7, [0.5, 9.0]), (3, [0.25]), (35, [0.0, 0.0])]
    assert found == sorted(brute(usable, 7, 3, integer))
    near = sorted(tuple(r) for r in near_top(frame(spark, ODD), 7, 3).collect())
    assert near == sorted(brute(usable[:3], 7, 3, lambda x, y: sum(a * b for a, b in zip(x, y))))
    for search in (exact_top, near_top):
        assert search(frame(spark, []), 7, 3).count() == 0
        assert search(frame(spark, [(7, [1.0])]), 7, 3).count() == 0


def test_recall_of_the_curves(spark, monkeypatch):
    monkeypatch.setattr(curves, "LEAST_BLOCK", 64)
    rows = vectors(1500, 16, 5, repeats=60)
    x = np.array([r[1] for r in rows])
    found = near_top(frame(spark, rows), 5, 10).collect()
    by_query = {}
    for r in found:
        assert abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-9
        by_query.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    for q in range(0, 1500, 5):
        product = x @ x[q]
        product[q] = -np.inf
        got = sorted(by_query[q])
        assert [g[0] for g in got] == list(range(1, 11))
        assert got == sorted(got, key=lambda g: (-g[2], g[1]))
        hit += sum(product[g[1]] >= np.sort(product)[-10] - 1e-12 for g in got)
        total += 10
    assert hit / total >= 0.9


@pytest.mark.parametrize("axes,bits", [(1, 6), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_is_a_path(axes, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    keys = hilbert_keys(cells, bits)
    assert sorted(keys) == list(range(len(cells)))
    assert np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1
