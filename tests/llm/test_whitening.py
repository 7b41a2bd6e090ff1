"""Whitening against a full eigendecomposition."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>"


def usable(rows):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, tuple(math.floor(256 * c) + 0 for c in np.array(v, np.float32).astype(float).tolist())) for i, v in good]


def check(rows, found, k=4):
    kept = usable(rows)
    x = np.array(sorted({v for _, v in kept}), float)
    n, sums = len(x), [sum(int(c) for c in col) for col in x.T]
    mean = x.sum(0) / n
    values, vectors = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    signs = {}
    want = []
    for i, v in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums, strict=True))
        want += [(i, j + 1, n, deviation, float((np.array(v) - mean) @ vectors[:, j] / math.sqrt(values[j])), values[j] / values.sum()) for j in range(k)]
    assert len(found) == len(want)
    by_row = {}
    for w in want:
        by_row.setdefault(w[:4], []).append(w)
    for r in found:
        w = by_row[(r["vec_id"], r["component"], r["n"], r["deviation"])].pop()
        if abs(w[4]) > 1e-6:
            assert signs.setdefault(r["component"], np.sign(w[4] * r["whitened"])) == np.sign(w[4] * r["whitened"])
        assert abs(abs(w[4]) - abs(r["whitened"])) < 1e-9
        assert abs(w[5] / r["explained"] - 1) < 1e-9
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query(spark, folder):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = wh.op12_whitening(spark, folder)
    kinds = [f.dataType.simpleString() for f in found.schema]
    assert kinds == ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    check(rows, found.collect())


def noise(n, d, seed=1):
    return np.random.default_rng(seed).normal(size=(n, d)) * (1 + np.arange(d)[::-1])


def test_odd_rows(spark):
    rows = [(i, v.tolist()) for i, v in enumerate(noise(40, 6))]
    rows += rows[:5] * 3 + [(100, None), (101, []), (102, [None] * 6), (103, [float("nan")] * 6), (104, [1.0, float("inf"), 0.0, 0.0, 0.0, 0.0])]
    rows += [(105, [1.0, 2.0]), (None, rows[7][1]), (None, [-0.0] * 6)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    good = [(i, v) for i, v in rows if v is None or len(v) != 2]
    check(good, wh.whiten(df).collect())
    clash = df
    for c in ("n", "component", "x", "v", "rows", "width", "whitened", "__v"):
        clash = clash.withColumn(c, F.lit("x"))
    check(good, wh.whiten(clash).collect())


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]):
        out = wh.whiten(spark.createDataFrame(rows, SCHEMA))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_fewer_directions_than_components(spark):
    rows = [(i, [i * 0.5, i * 1.0, 3.0]) for i in range(9)]
    check(rows, wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect())


def test_equal_eigenvalues(spark):
    """Any orthonormal basis of an eigenspace will do; the whitened covariance must be the identity."""
    points = [[s * 2.0 * (j == k) for j in range(5)] for k in range(5) for s in (1, -1)]
    df = spark.createDataFrame(list(enumerate(points)), SCHEMA)
    found = wh.whiten(df, components=5).collect()
    assert {r["component"] for r in found} == {1, 2, 3, 4, 5}
    assert all(abs(r["explained"] - 0.2) < 1e-9 and r["identity_error"] < 1e-9 for r in found)


def test_bidiagonalisation():
    x = noise(50, 12, 3)
    right, matrix = wh.bidiagonalise(lambda v: (float(x @ v @ (x @ v)), x.T @ (x @ v)), 12)
    assert np.abs(right @ right.T - np.eye(12)).max() < 1e-12
    assert np.allclose(np.triu(np.tril(matrix, 1)), matrix)
    assert np.allclose(np.linalg.svd(matrix)[1], np.linalg.svd(x)[1], rtol=1e-12)


def test_large_entries(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])]
    found = wh.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert found and all(r["deviation"] is None for r in found if r["vec_id"] != 3)
    assert wh.whole(np.array([1e30, -1e30, -0.0, 0.1])).tolist() == [2**63 - 1, -(2**63), 0, 25]
