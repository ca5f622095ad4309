"""Whitening against the library's eigenvalues, on hard and empty tables."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.llm import whitening
from civicflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("N", T.StringType())])


def brute(vectors):
    """n, deviation of each vector (whole numbers), eigenvalues and eigenvectors of the covariance."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, sums = len(x), [int(s) for s in x.astype(object).sum(0)]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * int(a) - s, n)) for a, s in zip(row, sums)] for row in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return n, deviation, centred, e[::-1], u[:, ::-1]


def check(found, ids, vectors, components=8, tol=1e-7):
    n, deviation, centred, e, u = brute(vectors)
    k = min(components, int((e > 1e-9 * e.max()).sum()))
    rows = {(r["vec_id"], r["component"]): r for r in found}
    assert len(found) == len(rows) == len(ids) * k
    for c in range(k):
        want = centred @ u[:, c] / np.sqrt(e[c])
        got = np.array([rows[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(got @ want)
        assert np.abs(got - sign * want).max() < tol
        for i, d in zip(ids, deviation):
            r = rows[i, c + 1]
            assert r["n"] == n and r["deviation"] == d
            assert r["explained"] == pytest.approx(e[c] / e.sum(), rel=1e-9)
            assert r["identity_error"] < 1e-9


def test_query(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    found = QUERIES["op13_embedding_whitening"](spark, SMALL)
    assert dict(found.dtypes)["deviation"] == "bigint"
    check(found.collect(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows])


def test_hard_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=5) * [3, 2, 1, 0.5, 0.01]).tolist(), "x") for i in range(60)]
    good += [(None, good[3][1], None)]
    bad = [(100, None, ""), (101, [], ""), (102, [1.0, None, 1.0, 1.0, 1.0], ""), (103, [1.0, float("nan"), 1.0, 1.0, 1.0], ""),
           (104, [1.0, float("inf"), 1.0, 1.0, 1.0], ""), (105, [1.0, 2.0], ""), (106, [1e300] * 5, "")]
    frame = spark.createDataFrame(good + bad + good[:2], VECTORS).repartition(5)
    found = whitening.whiten(frame)
    assert found.columns == ["vec_id", "embedding", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = found.collect()
    assert len(got) == 63 * 5
    once = list({(r["vec_id"], r["component"]): r for r in got}.values())
    vectors = [v for _, v, _ in good + good[:2]]
    n, deviation, _, e, _ = brute(vectors)
    assert {r["n"] for r in got} == {63} and max(r["identity_error"] for r in got) < 1e-9
    assert {r["vec_id"]: r["deviation"] for r in once} == dict(zip([i for i, _, _ in good], deviation))
    assert sorted({round(r["explained"], 12) for r in got}) == sorted(round(x, 12) for x in e / e.sum())


def test_without_spread(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0], "") for i in range(4)], VECTORS)
    assert whitening.whiten(same).collect() == []
    assert whitening.whiten(same.limit(0)).collect() == []
    # one direction only: one component
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0], "") for i in range(9)], VECTORS)
    check(whitening.whiten(line).collect(), range(9), [[float(i), 2.0 * i, 7.0] for i in range(9)])


def test_far_and_large_entries_are_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [[float(a) for a in rng.integers(-2 ** 50, 2 ** 50, 3) / 2 ** 10] for _ in range(40)]
    frame = spark.createDataFrame([(i, v, "") for i, v in enumerate(vectors)], VECTORS).repartition(4)
    got = whitening.whiten(frame).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == dict(enumerate(brute(vectors)[1]))
    check(got, range(40), vectors)


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 4), (33, 33)])
def test_factor_and_rotations(d, rank):
    rng = np.random.default_rng(d)
    a = rng.normal(size=(d, rank)) * 10.0 ** -rng.integers(0, 4, rank)
    a = a @ a.T
    factor = whitening.pivoted_cholesky(a)
    assert factor.shape == (d, rank) and np.abs(factor @ factor.T - a).max() < 1e-12 * np.abs(a).max()
    # triangular in the order of the pivots
    order = [int(np.argmax(np.where(np.abs(factor[:, :k + 1]).sum(1) > 0, factor[:, k], -1))) for k in range(rank)]
    for k, p in enumerate(order):
        assert not factor[order[:k], k].any() and factor[p, k] > 0
    e, u = whitening.jacobi(factor)
    assert np.all(np.diff(e) <= 0) and np.abs(u.T @ u - np.eye(rank)).max() < 1e-12
    assert np.abs(u * e @ u.T - a).max() < 1e-12 * np.abs(a).max()
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-8)


def test_native_filter_only(spark):
    plan = whitening.vectors_of(spark.read.parquet(f"{SMALL}/embeddings.parquet"))[0]._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert spark.range(1).select(whitening.usable(F.lit(None).cast("array<double>"))).first()[0] is False
