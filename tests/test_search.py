"""Searches from sufficient statistics against fits on the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import models, search
from tabkit.operators.split import kfold


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (300, 2)) * [3, 40] + [5, -20]
    y = 1 + x[:, 0] ** 2 - 0.1 * x[:, 1] * x[:, 0] + rng.normal(0, 4, 300)
    c = (x[:, 0] * 8 + x[:, 1] + rng.normal(0, 25, 300) > 20).astype(int)
    rows = [(i, float(a), float(b), float(v), int(k)) for i, ((a, b), v, k) in enumerate(zip(x, y, c))]
    return spark.createDataFrame(rows + [(900, None, 1.0, 2.0, 1), (901, 1.0, 1.0, None, None)], "id long, a double, b double, y double, c int").repartition(3)


def plain(table, label, stratify):
    rows = kfold(table.where(f"{label} IS NOT NULL").withColumn("__all", F.lit(0)), ["id"], stratify, 4, 42).where("a IS NOT NULL").toPandas()
    return rows["fold"].to_numpy(), rows[label].to_numpy(float), rows[["a", "b"]].to_numpy(float)


def standardised(x, fit, degree):
    z = np.column_stack([np.prod([x[:, i] for i in t], axis=0) for t in search.monomials(2, degree)])
    return (z - z[fit].mean(0)) / z[fit].std(0)


def test_terms_of_a_degree_are_a_prefix():
    assert search.monomials(2, 2) == [(0,), (1,), (0, 0), (0, 1), (1, 1)]
    assert search.monomials(3, 5)[:len(search.monomials(3, 3))] == search.monomials(3, 3)
    x = np.random.default_rng(0).normal(size=(5, 3))
    assert np.allclose(search.expand(x, search.monomials(3, 4)), np.column_stack([np.prod([x[:, i] for i in t], axis=0) for t in search.monomials(3, 4)]))


def test_ridge_equals_fits_on_the_rows(table):
    got = models.random_search(table, ["a", "b"], "y", ["id"], draws=25, degrees=(2, 6)).collect()
    fold, y, x = plain(table, "y", "__all")
    assert len(got) == 25
    for r in got:
        scores = []
        for f in range(4):
            fit, held = fold != f, fold == f
            z = standardised(x, fit, r["degree"])
            w = np.linalg.solve(z[fit].T @ z[fit] + r["strength"] * np.eye(z.shape[1]), z[fit].T @ (y[fit] - y[fit].mean()))
            gap = y[held] - y[fit].mean() - z[held] @ w
            scores.append(1 - (gap ** 2).sum() / ((y[held] - y[held].mean()) ** 2).sum())
        assert r["mean_score"] == pytest.approx(np.mean(scores), rel=1e-5, abs=1e-5)
    assert [r["mean_score"] for r in got] == sorted((r["mean_score"] for r in got), reverse=True)


def test_lasso_is_optimal(table):
    fold, y, x = plain(table, "y", "__all")
    scale = np.abs(x).max(0)
    z = np.column_stack([np.ones(len(y)), search.expand(x / scale, search.monomials(2, 3)), y])
    s = search.Standard(z.T @ z, 9)
    for alpha, w in zip((0.01, 1.0, 100.0), search.lasso_weights(s, [0.01, 1.0, 100.0])):
        slope = (s.b - s.a @ w) / s.n
        assert np.all(np.abs(slope) <= alpha + 1e-5) and np.allclose(slope[w != 0], alpha * np.sign(w[w != 0]), atol=1e-5)
    got = models.random_search(table, ["a", "b"], "y", ["id"], draws=10, degrees=(2, 4), kind="lasso").collect()
    assert len(got) == 10 and got[0]["mean_score"] > 0.8


def test_logistic_equals_newton_on_the_rows(table):
    got = models.random_search(table, ["a", "b"], "c", ["id"], draws=12, degrees=(2, 3), penalty=(1e-4, 1e3), kind="logistic").collect()
    fold, y, x = plain(table, "c", "c")
    for r in got:
        scores = []
        for f in range(4):
            fit, held = fold != f, fold == f
            z = np.column_stack([np.ones(len(y)), standardised(x, fit, r["degree"])])
            t, ridge = np.zeros(z.shape[1]), np.append(0, np.ones(z.shape[1] - 1)) / r["strength"]
            for _ in range(200):
                p = 1 / (1 + np.exp(-z[fit] @ t))
                gradient = z[fit].T @ (p - y[fit]) + ridge * t
                t = t - 0.5 * np.linalg.solve((z[fit] * (p * (1 - p))[:, None]).T @ z[fit] + np.diag(ridge + 1e-12), gradient)
            scores.append(((z[held] @ t > 0) == y[held]).mean())
        assert r["mean_score"] == pytest.approx(np.mean(scores), abs=1e-9)


def test_constant_columns(spark):
    rows = spark.createDataFrame([(i, 2.0, float(i % 10), float(i % 10) * 3 + 1) for i in range(80)], "id long, a double, b double, y double")
    got = models.random_search(rows, ["a", "b"], "y", ["id"], draws=5, degrees=(1, 2), penalty=(1e-6, 1e-5))
    assert got.first()["mean_score"] > 0.999999


def test_logistic_models_of_the_same_terms_share_a_pass(monkeypatch):
    """Weights are those of a plain Newton fit, and the products of two terms are not made once per model."""
    rng = np.random.default_rng(4)
    x, fold = rng.normal(size=(2_500, 2)), rng.integers(0, 3, 2_500)
    y = (x[:, 0] + rng.normal(size=2_500) > 0).astype(float)
    terms, scale, made = search.monomials(2, 2), np.ones(2), []
    monkeypatch.setattr(search, "_per_partition", lambda rows, fn: dict(fn(iter([(fold, y, x)]))))
    before = search._standardised
    monkeypatch.setattr(search, "_standardised", lambda *a: made.append(1) or before(*a))
    z = np.column_stack([np.ones(len(y)), search.expand(x, terms), y])
    fits = []
    for f in range(3):
        s = search.Standard(z[fold != f].T @ z[fold != f], len(terms))
        fits += [(f, s, c) for c in (0.01, 0.1, 1.0, 10.0, 100.0)]
    theta = search.logistic_weights(None, terms, scale, fits)
    assert len(made) <= 3 * 3 * search.NEWTON_ROUNDS  # folds x pieces of rows x rounds, whatever the number of models
    for (f, s, c), t in zip(fits, theta):
        fit = np.column_stack([np.ones((fold != f).sum()), (search.expand(x[fold != f], terms) - s.mean[:-1]) / s.spread])
        chance = 1 / (1 + np.exp(-fit @ t))
        assert np.abs(c * fit.T @ (chance - y[fold != f]) + np.append(0, t[1:])).max() < 1e-4 * (1 + c)
