"""Whitening against an eigenvalue decomposition of the covariance, the solver on hard spectra, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm.bidiagonal import qd_values, right_singular
from millrace.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<double>, row string, component string"


def brute(vectors):
    x = np.floor(1024 * np.array(vectors)).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(0)
    deviations = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = (x * n - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return deviations, centred, values[::-1], directions[:, ::-1]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", "mine") for i, v in rows], SCHEMA)


def by_vector(rows):
    found = {}
    for r in rows:
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    return found


def spectra():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.normal(size=(24, 24)))[0]
    wide = np.abs(np.arange(-10, 11.0))
    return {
        "random": rng.normal(size=(24, 24)), "graded": np.diag(np.logspace(0, -12, 24)) @ turn, "equal": turn * 7,
        "few rows": np.vstack([rng.normal(size=(3, 24)), np.zeros((21, 24))]), "zero": np.zeros((5, 5)), "one": np.array([[3.0]]),
        "clusters": np.diag([5.0] * 10 + [1.0] * 14) @ turn, "near": np.diag([5 + 1e-9 * k for k in range(10)] + [1.0] * 14) @ turn,
        "close pairs": np.linalg.cholesky(np.diag(wide + 2) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
    }


@pytest.mark.parametrize("name", list(spectra()))
def test_the_solver(name):
    a = spectra()[name]
    values, vectors = right_singular(np.linalg.qr(a, mode="r"), 12)
    right = np.linalg.svd(a, compute_uv=False) ** 2
    assert np.allclose(values, right, rtol=1e-12, atol=1e-14 * max(right[0], 1e-300))
    assert np.abs(a.T @ (a @ vectors) - vectors * values[: vectors.shape[1]]).max() <= 1e-13 * max(right[0], 1e-300)
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-10


def test_small_values_keep_their_relative_accuracy():
    # The product of all eigenvalues is that of the squared diagonal.
    q, e = [10.0 ** -(3 * k) for k in range(8)], [10.0 ** -(3 * k + 1) for k in range(7)]
    assert np.isclose(np.prod(qd_values(q, e)), np.prod(q), rtol=1e-12)


def test_against_the_covariance(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(300, 12)) * np.linspace(0.05, 0.4, 12)).tolist()
    vectors[50:150] = [vectors[0]] * 100  # a third of the rows are copies
    rows = whiten(frame(spark, enumerate(vectors)).repartition(40)).collect()
    assert len(rows) == 300 * 8 and {r["row"] for r in rows} == {"r"}
    deviations, centred, values, directions = brute(vectors)
    found = by_vector(rows)
    got = np.array([[found[i][k]["whitened"] for k in range(1, 9)] for i in range(300)])
    want = centred @ directions[:, :8] / np.sqrt(values[:8])
    assert np.abs(got * np.sign((got * want).sum(0)) - want).max() < 1e-9
    assert [found[i][1]["deviation"] for i in range(300)] == deviations
    assert np.allclose([found[0][k]["explained"] for k in range(1, 9)], values[:8] / values.sum(), rtol=1e-10)
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-10 and {r["n"] for r in rows} == {300}


def test_odd_rows(spark):
    good = [(1, [0.1, 0.2, 0.3]), (2, [0.4, -0.2, 0.0]), (2, [0.4, -0.2, 0.0]), (None, [0.0, 0.9, 0.5]), (5, [0.3, 0.3, -0.8])]
    odd = [(6, None), (7, []), (8, [None, 0.1, 0.2]), (9, [float("nan"), 0.1, 0.2]), (10, [float("inf"), 0.1, 0.2]), (11, [0.5, 0.5]), (12, [0.5])]
    rows = whiten(frame(spark, good + odd)).collect()
    assert len(rows) == 5 * 3 and {r["vec_id"] for r in rows} == {1, 2, None, 5} and {r["n"] for r in rows} == {5}
    deviations = brute([v for _, v in good])[0]
    assert sorted(r["deviation"] for r in rows if r["component"] == 1) == sorted(deviations)
    empty = whiten(frame(spark, good).limit(0))
    assert empty.collect() == [] and empty.columns == whiten(frame(spark, good)).columns
    assert whiten(frame(spark, odd[:4])).collect() == []


def test_rows_without_variance(spark):
    rows = whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert len(rows) == 4 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in rows)
    line = whiten(frame(spark, [(k, [k / 8, k / 8, 0.0]) for k in range(8)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True), (3, True)}


def test_large_entries_stay_exact(spark):
    vectors = [[3e7, 0.25], [-3e7, 0.5], [1e300, 0.125]]
    rows = whiten(frame(spark, enumerate(vectors))).where("component = 1").collect()
    x = [[min(max(int(np.floor(1024 * c)), -(1 << 45)), 1 << 45) + 100_000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x)]
    want = {i: sum((3 * v - s) ** 2 for v, s in zip(row, sums)) for i, row in enumerate(x)}
    assert {r["vec_id"]: int(r["deviation_digits"]) for r in rows} == want
    assert all(r["deviation"] == (want[r["vec_id"]] if want[r["vec_id"]] < 1 << 63 else None) for r in rows)


def test_a_carried_column_only(spark):
    assert whiten(frame(spark, [(1, [0.5, 0.1]), (2, [0.1, 0.5])]), carry=["vec_id"]).columns[0] == "vec_id"
    renamed = frame(spark, [(1, [0.5, 0.1]), (2, [0.1, 0.5])]).withColumn("v", F.lit(1))
    assert len(whiten(renamed).collect()) == 4
