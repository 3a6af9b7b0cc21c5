"""Whitening: the incremental eigendecomposition and the whole operator against numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import whitening
from tagweave.llm.whitening import Spectrum, secular_roots, whitened_components

SF = "/root/testdata/sf0.001"


def samples(kind, n=300):
    rng = np.random.default_rng(3)
    x = np.floor(rng.standard_normal((n, 12)) * np.array([100, 90, 50, 30, 30, 20, 10, 8, 6, 4, 3, 2]))
    if kind == "constant and repeated columns":
        x[:, 3], x[:, 7] = x[:, 2], 5
    if kind == "few":
        x = x[:5]
    if kind == "one direction":
        x = np.outer(np.arange(n), np.arange(1, 13)).astype(float)
    if kind == "equal eigenvalues":
        x = np.vstack([np.eye(12), -np.eye(12)]) * 7
    return x


def scatter(s):
    return (s.vectors * s.values) @ s.vectors.T


@pytest.mark.parametrize("kind", ["plain", "constant and repeated columns", "few", "one direction", "equal eigenvalues"])
def test_updates_and_combination_equal_the_batch_scatter(kind):
    x = samples(kind)
    want = (x - x.mean(0)).T @ (x - x.mean(0))
    one, parts = Spectrum(12), [Spectrum(12) for _ in range(4)]
    for i, row in enumerate(x):
        one.add(row)
        parts[i % 3].add(row)  # the fourth one stays empty
    for p in parts[1:]:
        parts[0].combine(p)
    for s in (one, parts[0]):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(0), atol=1e-11)
        assert np.abs(scatter(s) - want).max() <= 1e-12 * np.abs(want).max()
        assert np.abs(s.vectors.T @ s.vectors - np.eye(12)).max() < 1e-12 and (np.diff(s.values) >= 0).all()


def test_secular_roots_hold_for_close_and_distant_values():
    d = np.array([0.0, 1e-13, 1.0, 1.0 + 1e-9, 5.0, 1e9])
    z2 = np.array([1e-8, 1.0, 1e-18, 2.0, 3.0, 1e-10])
    roots, gap = secular_roots(d, z2, 0.7)
    assert (roots >= d).all() and (roots[:-1] <= d[1:]).all()
    for i in range(len(d)):  # the equation's value in exact arithmetic
        f = 1 + sum(Fraction(0.7) * Fraction(z) / Fraction(g) for z, g in zip(z2, gap[:, i]))
        assert abs(float(f)) <= 1e-12 * (1 + sum(abs(0.7 * z / g) for z, g in zip(z2, gap[:, i])))


def brute(vectors, k=16):
    """Plain numpy and Python integers: (n, deviations, covariance's eigenvalues and vectors, centred rows) of integer vectors."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    centred = lambda rows: np.array([[float(Fraction(a) - Fraction(s, n)) for a, s in zip(v, sums)] for v in rows])
    c = centred(fit)
    values, vecs = np.linalg.eigh(c.T @ c / n)
    return n, deviations, values[::-1][:k], vecs[:, ::-1][:, :k], centred(x), np.trace(c.T @ c / n), c


def check(rows, vectors):
    n, deviations, values, vecs, centred, trace, fit = brute([v for _, v in vectors])
    want = centred @ vecs / np.sqrt(values)
    at = {}
    for r in rows:
        at.setdefault(r.component, []).append(r)
    assert sorted(at) == list(range(1, len(values) + 1))
    by_id = {i: (deviations[k], want[k]) for k, (i, _) in enumerate(vectors)}
    for c, members in at.items():
        assert len(members) == len(vectors)
        ref = max(members, key=lambda r: abs(by_id[r.vec_id][1][c - 1]))
        sign = np.sign(ref.whitened * by_id[ref.vec_id][1][c - 1])
        for r in members:
            assert r.n == n and r.deviation == by_id[r.vec_id][0]
            assert abs(r.whitened * sign - by_id[r.vec_id][1][c - 1]) < 1e-8
            assert abs(r.explained / (values[c - 1] / trace) - 1) < 1e-9
    w = fit @ vecs / np.sqrt(values)
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-10 and np.abs(w.T @ w / n - np.eye(len(values))).max() < 1e-10


def test_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "TASK_VECTORS", 20)  # many spectra, several rounds
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in df.collect()]
    check(whitened_components(df.repartition(3)).collect(), vectors)


SCHEMA = "vec_id long, embedding array<double>"


def test_repeats_ties_and_bad_rows(spark):
    rng = np.random.default_rng(5)
    good = [(i, (rng.standard_normal(6) * [9, 7, 5, 3, 2, 1]).tolist()) for i in range(60)]
    good += [(100 + i, good[i % 3][1]) for i in range(80)]  # copies count once in the fit, and are whitened like the others
    bad = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] * 6), (903, [float("inf")] * 6), (904, []), (905, [1e300] * 6), (906, [1.0, 2.0])]
    df = spark.createDataFrame(good + bad, SCHEMA).select("*", F.lit("x").alias("_x"), F.lit(1).alias("deviation"), F.lit(2).alias("a.b"))
    rows = whitened_components(df).collect()
    check(rows, good)


def test_nothing_to_whiten(spark):
    for data in ([], [(1, None)] * 2, [(1, [1.0, 2.0])] * 5, [(1, [0.5])]):
        assert whitened_components(spark.createDataFrame(data, SCHEMA)).count() == 0


def test_rank_one_data_and_large_entries(spark):
    rows = [(i, [float(i), 2.0 * i, 0.0]) for i in range(10)] + [(None, [1.0, 2.0, 0.0])]
    got = whitened_components(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 11 and {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12
    far = [(i, [1e14 + 3 * i, -1e13 * (i % 5)]) for i in range(30)]  # sums and deviations beyond what doubles hold
    out = whitened_components(spark.createDataFrame(far, SCHEMA)).collect()
    n, deviations, *_ = brute([v for _, v in far])
    assert all(r.deviation == (deviations[r.vec_id] if deviations[r.vec_id] < 1 << 63 else None) for r in out)
