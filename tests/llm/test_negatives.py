"""Hard negatives against all scores."""

import math

import numpy as np
import pytest

from answerloom.llm import negatives
from answerloom.llm.negatives import hard_negatives, light_first, spanning_tree

SCHEMA = "vec_id bigint, embedding array<double>, label int, score string"


def brute(rows, every=100):
    """The answer by definition, on rows with distinct ids."""
    kept = {}
    for vec_id, vector, label, _ in rows:
        if None in (vec_id, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[vec_id] = (label, [math.floor(256 * x) for x in vector])
    out = []
    for a, (label, v) in kept.items():
        if a % every:
            continue
        scores = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in kept.items() if i != a}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if kept[i][0] == label][:5]:
            fit = [i for i in order if kept[i][0] != label and 80 * scores[p] <= 100 * scores[i] <= 100 * scores[p]]
            out += [(a, p, r, i, scores[p], scores[i]) for r, i in enumerate(fit[:5], 1)]
    return sorted(out)


def found(spark, rows, **parameters):
    frame = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in hard_negatives(frame, **parameters).collect())


@pytest.fixture(scope="module")
def clustered():
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.1 * draw.normal(size=8)).tolist(), int(draw.integers(3)), "x") for i in range(1500)]
    # A vector that very many rows share, ties among them.
    return rows + [(2000 + i, centres[0].tolist(), i % 3, "x") for i in range(400)]


def test_equals_brute_force(spark, clustered):
    want = brute(clustered, every=20)
    assert len(want) > 1000
    assert found(spark, clustered, every=20) == want
    assert found(spark, clustered, every=20, block_anchors=30, shard_rows=64) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, "x"), (1, [0.9, 0.1], 1, "x"), (2, [0.8, 0.3], 2, "x"), (3, None, 1, "x"),
            (4, [nan, 1.0], 1, "x"), (5, [1.0, None], 2, "x"), (6, [inf, 0.0], 2, "x"), (7, [1.0, 1.0], None, "x"),
            (8, [0.9], 2, "x"), (9, [0.7, 0.7, 5.0], 2, "x"), (100, [-1.0, 0.0], 7, "x"), (None, [1.0, 1.0], 2, "x"),
            (200, [], 1, "x"), (300, [0.0, 0.0], 4, "x"), (301, [0.5, 0.5], 4, "x")]
    # Scores of zero make a window of zero: the empty and the zero vector.
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0], 1, "x")]) == []
    # Of rows that repeat an id the vector that sorts first counts.
    assert found(spark, [*rows, (2, [0.9, 0.3], 2, "x"), (1, [0.9, 0.1], 1, "x")]) == brute(rows)


def test_large_components(spark):
    """Beyond exact doubles nothing is pruned, and products are whole numbers still."""
    rows = [(i, [float(3 + i) * 2e5, 2e5 + i / 256], i % 2, "x") for i in range(0, 40)]
    assert found(spark, rows, every=10) == brute(rows, every=10)


def test_tree_and_walk():
    draw = np.random.default_rng(1)
    values = draw.normal(size=(200, 5))
    parents, edges = spanning_tree(values)
    assert (parents == -1).sum() == 1 and parents[0] == -1
    for i in range(1, 200):
        assert edges[i] == pytest.approx(np.linalg.norm(values[i] - values[parents[i]]))
    # Kruskal's tree has the same length.
    gaps = sorted((np.linalg.norm(values[i] - values[j]), i, j) for i in range(200) for j in range(i))
    group, total = list(range(200)), 0.0

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for gap, i, j in gaps:
        if top(i) != top(j):
            group[top(i)] = top(j)
            total += gap
    assert edges.sum() == pytest.approx(total)
    order, held, most = light_first(parents), set(), 0
    seen = set()
    for node, last in order:
        assert parents[node] == -1 or parents[node] in held
        if last:
            held.discard(parents[node])
        seen.add(node)
        if (parents == node).any():
            held.add(node)
        most = max(most, len(held))
    assert len(seen) == 200 and most <= math.log2(200) + 1


def test_bounds_spare_rows(clustered, monkeypatch):
    """Most candidates of other clusters are never scored again."""
    rows = [r for r in clustered if r[0] < 1500]
    ids, labels = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    values = np.floor(256 * np.array([r[1] for r in rows]))
    asked = ids % 10 == 0
    block = negatives._Block(ids[asked], labels[asked], values[asked], *spanning_tree(values[asked]), None, 5)
    scored = []
    keep = negatives._Block._keep
    monkeypatch.setattr(negatives._Block, "_keep", lambda self, *a: (scored.append(len(a[-1])), keep(self, *a)))
    for part in np.array_split(np.arange(len(ids)), 10):
        block.meet(ids[part], labels[part], values[part])
    assert sum(scored) < 0.5 * asked.sum() * len(ids) / 3
