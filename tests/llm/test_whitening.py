"""Whitening against numpy's own decomposition and exact integers."""

import math

import numpy as np
import pytest

from answerloom.llm import whitening
from answerloom.llm.whitening import leading_components, leading_values, tridiagonal, whitened

SCHEMA = "vec_id bigint, embedding array<double>, n string"


def symmetric(kind, width=40):
    draw = np.random.default_rng(3)
    q = np.linalg.qr(draw.normal(size=(width, width)))[0]
    values = {"spread": draw.uniform(0, 5, width), "equal": np.array([3.0] * 5 + [1.0] * (width - 5)),
              "near": 1 + 1e-9 * np.arange(width), "low": np.array([9.0, 4.0, 4.0] + [0.0] * (width - 3)),
              "diagonal": np.arange(1.0, width + 1)}[kind]
    return np.diag(values) if kind == "diagonal" else (q * values) @ q.T


@pytest.mark.parametrize("kind", ["spread", "equal", "near", "low", "diagonal"])
def test_components_of_matrices(kind):
    a = symmetric(kind)
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)[::-1][:8]
    values, vectors = leading_components(a, 8)
    assert len(values) == (3 if kind == "low" else 8)
    assert np.abs(values - want[:len(values)]).max() < 1e-13 * np.abs(a).sum()
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * np.linalg.norm(a)


def test_tridiagonal_form():
    a = symmetric("spread", 12)
    diagonal, off, reflectors = tridiagonal(a)
    t = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    q = np.eye(12)
    for k in range(10):
        q = q @ (np.eye(12) - 2 * np.outer(reflectors[:, k], reflectors[:, k]))
    assert np.abs(q @ t @ q.T - a).max() < 1e-12
    assert np.abs(leading_values(diagonal, off, 12) - np.linalg.eigvalsh(a)[::-1]).max() < 1e-12
    for width in (1, 2):
        values, vectors = leading_components(np.diag(np.arange(1.0, width + 1)), 8)
        assert values.tolist() == pytest.approx(sorted(np.arange(1.0, width + 1), reverse=True)) and vectors.shape == (width, width)


def check(rows, result, k=8):
    """Every claim of the contract, by whole numbers and numpy."""
    kept = [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max(len(v) for _, v in kept)
    x = [[math.floor(1024 * c) + 100000 for c in v] + [100000] * (width - len(v)) for _, v in kept]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[float(n * c - s) / n for c, s in zip(v, sums)] for v in x])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    want = centred @ vectors / np.sqrt(values)
    deviations = [sum((n * c - s) ** 2 for c, s in zip(v, sums)) for v in x]
    assert len(result) == n * len(values) and {r["n"] for r in result} == {n}
    by_component = {}
    for r in result:
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r
    assert sorted(by_component) == list(range(1, len(values) + 1))
    for c, found in by_component.items():
        got = np.array([found[i]["whitened"] for i, _ in kept])
        sign = np.sign(got @ want[:, c - 1])
        assert np.abs(got * sign - want[:, c - 1]).max() < 1e-7
        assert [found[i]["deviation"] for i, _ in kept] == deviations
        assert all(r["explained"] == pytest.approx(values[c - 1] / np.trace(covariance), rel=1e-9) for r in found.values())
    assert len({r["identity_error"] for r in result}) == 1 and result[0]["identity_error"] < 1e-9


def test_whole_table(spark):
    draw = np.random.default_rng(7)
    rows = [(i, (draw.normal(size=12) * np.arange(1, 13) / 7).tolist(), "x") for i in range(700)]
    rows += [(1000, None, "x"), (1001, [None] * 12, "x"), (1002, [float("nan")] * 12, "x"), (1003, [float("inf")] * 12, "x"),
             (1004, [0.5] * 3, "x"), (1005, [], "x")]
    check(rows, whitened(spark.createDataFrame(rows, SCHEMA).repartition(7)).collect())


def test_query_on_the_given_vectors(spark):
    from answerloom.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]], "")
            for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(rows, QUERIES["op13_whitening"](spark, sf_dir).collect())


def test_few_components(spark):
    flat = [(i, [float(i), 2.0 * i, 1.0], "x") for i in range(50)]
    result = whitened(spark.createDataFrame(flat, SCHEMA)).collect()
    assert {r["component"] for r in result} == {1} and len(result) == 50
    assert all(r["explained"] == pytest.approx(1.0) for r in result)
    for rows in ([], [(1, [1.0, 2.0], "x")], [(i, [1.0, 2.0], "x") for i in range(9)], [(1, [], "x"), (2, None, "x")]):
        empty = whitened(spark.createDataFrame(rows, SCHEMA))
        assert empty.collect() == [] and empty.columns == ["vec_id", "component", "n", "deviation", "whitened",
                                                           "explained", "identity_error"]


def test_repeated_missing_ids_and_huge_entries(spark):
    rows = [(None, [1.0, 0.0], "x"), (None, [0.0, 1.0], "x"), (3, [1.0, 1.0], "x"), (3, [1.0, 1.0], "x")]
    assert len(whitened(spark.createDataFrame(rows, SCHEMA)).collect()) == 8
    huge = [(i, [1e300 if i == 1 else float(i), -1e300 if i == 2 else 0.5 * i * i], "x") for i in range(6)]
    result = whitened(spark.createDataFrame(huge, SCHEMA)).collect()
    assert len(result) == 12 and max(r["deviation"] for r in result) == whitening.LONGEST
    assert result[0]["identity_error"] < 1e-4
    with pytest.raises(ValueError):
        whitened(spark.createDataFrame([(1, [0.0] * 4097, "x")], SCHEMA))
