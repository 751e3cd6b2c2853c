"""Whitening against exact covariances, an independent eigensolver, and hard cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelane.llm import whitening
from tidelane.llm.queries import op11_whitening


def plain(rows, components=16):
    """{row number: (n, deviation, whitened up to sign, explained)} from all distinct vectors, in exact integers where it matters."""
    x = np.array(rows, object)
    fit = np.array(sorted(set(map(tuple, rows))), object)
    n = len(fit)
    sums = fit.sum(axis=0)
    apart = n * fit - sums
    covariance = np.array((apart.T @ apart).tolist(), float) / n / n / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    own = n * x - sums
    white = (own.astype(float) / n) @ vectors / np.sqrt(values)
    return n, (own**2).sum(axis=1).tolist(), white, values / covariance.trace()


def test_query_against_plain_version(spark, tmp_path):
    rng = np.random.default_rng(2)
    mix = rng.normal(size=(20, 20)) * (0.8 ** np.arange(20))
    values = (rng.normal(size=(400, 20)) @ mix).astype(np.float32)
    data = [(i, v.tolist()) for i, v in enumerate(values)]
    data += [(1000 + i, values[3].tolist()) for i in range(200)]
    data += [(7, None), (8, [math.nan] + [0.0] * 19), (9, [None] + [0.0] * 19), (10, [math.inf] * 20), (None, values[5].tolist())]
    spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("n", F.lit("clash")).write.parquet(str(tmp_path / "embeddings.parquet"))
    rows = op11_whitening(spark, str(tmp_path)).orderBy("vec_id", "component").collect()
    kept = [(i, v) for i, v in data if v and all(x is not None and math.isfinite(x) for x in v)]
    assert len(rows) == 16 * len(kept)
    grid = [[math.floor(64 * x) + 1_000_000 for x in v] for _, v in kept]
    n, deviation, white, share = plain(grid)
    by_id = {i: (d, w) for (i, _), d, w in zip(kept, deviation, white, strict=True)}
    signs = {}
    for r in rows:
        d, w = by_id[r.vec_id]
        assert (r.n, r.deviation) == (n, d) and r.identity_error <= 1e-9
        k = r.component - 1
        assert r.explained == pytest.approx(share[k], rel=1e-9)
        if abs(w[k]) > 0.1:
            signs.setdefault(k, np.sign(w[k] * r.whitened))
        assert r.whitened == pytest.approx(signs.get(k, 1) * w[k], abs=1e-7) or abs(w[k]) <= 0.1


def test_dependent_and_constant_dimensions_give_no_component(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(-50, 50, (60, 3))
    rows = np.column_stack([base, base[:, 0] + 2 * base[:, 1], np.full(60, 9), base[:, 2] * 10**6])
    frame = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, vector array<long>")
    out = whitening.whiten(frame).collect()
    assert {len(r.whitened) for r in out} == {3}
    white = np.array([r.whitened for r in out])
    distinct = np.unique(np.column_stack([rows, white]), axis=0)[:, -3:]
    assert np.allclose(np.cov(distinct.T, bias=True), np.eye(3), atol=1e-6)
    assert sum(out[0].explained) == pytest.approx(1)


def test_odd_tables(spark):
    schema = "vec_id long, vector array<long>, whitened int"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [5, 6], 0), (2, [5, 6], 0), (3, [], 0), (4, None, 0), (5, [1, None], 0)], schema)).collect()
    assert sorted((r.vec_id, r.n, r.deviation, r.whitened) for r in one if r.deviation is not None) == [(1, 1, 0, []), (2, 1, 0, [])]
    assert [(r.vec_id, r.whitened) for r in one if r.deviation is None] == [(3, [])]
    lengths = [(i, [i % 7, i % 5, i % 3][: 2 + i % 2], 0) for i in range(60)]
    out = whitening.whiten(spark.createDataFrame(lengths, schema)).collect()
    assert len(out) == 60 and {len(r.whitened) for r in out} == {2, 3} and all(r.identity_error < 1e-9 for r in out)
    huge = whitening.whiten(spark.createDataFrame([(i, [(1 << 61) * (i - 1), i], 0) for i in range(3)], schema)).collect()
    assert [r.deviation for r in huge if r.vec_id == 1] == [0] and sum(r.deviation is None for r in huge) == 2
    grid = spark.createDataFrame([([1e300, -1e300, 0.5],)], "v array<double>").select(whitening.grid(F.col("v")).alias("x")).first().x
    assert grid == [(1 << 62) + 1_000_000, -(1 << 62) + 1_000_000, 1_000_032]


def test_factor_and_rotations():
    rng = np.random.default_rng(0)
    for d in (1, 2, 3, 8, 33):
        a = rng.normal(size=(d, d)) * np.logspace(0, -5, d)[:, None]
        a = a @ a.T
        t, order = whitening.pivoted_cholesky(a)
        assert np.allclose(np.triu(t, 1), 0) and np.allclose(t @ t.T, a[np.ix_(order, order)], rtol=1e-9)
        values, rows = whitening.principal(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1], rtol=1e-8, atol=1e-13)
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-12)
        assert np.allclose(a @ rows.T, rows.T * values, atol=1e-12)
    # Dimensions of very different scale keep the digits of the small one.
    scale = np.diag([1e8, 1.0, 1e-8])
    a = scale @ np.array([[2, 1, 0.5], [1, 2, 1], [0.5, 1, 2]]) @ scale
    values, _ = whitening.principal(a)
    assert values[2] == pytest.approx(np.linalg.det(a) / values[0] / values[1], rel=1e-9)
