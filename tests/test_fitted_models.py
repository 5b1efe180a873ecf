"""Fitted classifiers side by side, and the certificate of a fitted logistic regression."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from riskloom.plans import learning as L, metrics as M
from riskloom.plans.history import TARGET

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(240, 3))
    y = np.clip(np.round(1 + x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.6, size=240)), 0, 2).astype(int)
    return x, y


@pytest.fixture(scope="module")
def train(spark, data):
    rows = [(i, Vectors.dense(*map(float, v)), int(k)) for i, (v, k) in enumerate(zip(*data))]
    return spark.createDataFrame(rows, ["id", "features", TARGET]).withColumn(TARGET, F.col(TARGET).cast("int")).cache()


def plain_gradient(x, y, w, b, c=1.0):
    sizes = np.bincount(y, minlength=3)
    weight = len(y) / (3 * sizes[y])
    m = x @ w.T + b
    p = np.exp(m - m.max(axis=1, keepdims=True))
    r = weight[:, None] * (p / p.sum(axis=1, keepdims=True) - np.eye(3)[y])
    n = weight.sum()
    return np.vstack([r.sum(axis=0) / n, (x.T @ r) / n + w.T / (n * c)])


def test_certificate_equals_plain_gradient(train, data):
    rng = np.random.default_rng(5)
    w, b = rng.normal(size=(3, 3)), rng.normal(size=3)
    got = {r.feature: r for r in L.stationarity(train, w, b, NAMES).collect()}
    for name, want in zip(["(intercept)", *NAMES], plain_gradient(*data, w, b)):
        assert [got[name][f"gradient_class_{k}"] for k in range(3)] == pytest.approx(list(want), abs=1e-12)


def test_certificate_tells_the_fitted_model_from_a_perturbed_one(train):
    model = L.fit_logistic(train, tol=1e-9)
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    assert all(r.stationary and r.residual < 1e-4 for r in L.stationarity(train, w, b, NAMES).collect())
    moved = w.copy()
    moved[2, 1] += 0.05
    assert not all(r.stationary for r in L.stationarity(train, moved, b, NAMES).collect())


def test_models_side_by_side(train, data):
    x, y = data
    models = L.fit_models(train, 3)
    assert list(models) == [L.MAJORITY, L.NAIVE_BAYES, L.LOGISTIC]
    scored = {name: score(train) for name, score in models.items()}
    sizes = np.bincount(y)
    assert {r.predicted_label for r in scored[L.MAJORITY].collect()} == {int(sizes.argmax())}
    logs = np.stack([
        np.log(sizes[k] / len(y)) - 0.5 * (np.log(2 * np.pi * v) + (x - x[y == k].mean(axis=0)) ** 2 / v).sum(axis=1)
        for k in range(3) for v in [x[y == k].var(axis=0) + 1e-4 * x.var(axis=0).max()]
    ], axis=1)
    want = np.exp(logs - logs.max(axis=1, keepdims=True))
    want /= want.sum(axis=1, keepdims=True)
    for r in scored[L.NAIVE_BAYES].collect():
        assert [r.p0, r.p1, r.p2] == pytest.approx(list(want[r.id]), abs=1e-9)
    assert set(train.columns) <= set(scored[L.LOGISTIC].columns)


def test_the_selected_model_is_the_best_by_f2(train):
    models = L.fit_models(train, 3)
    rows = train.withColumn("actual_label", train[TARGET])
    parts = [M.evaluate(score(rows), name, "validation").select("model", "high_risk_f2", "macro_f1", "high_risk_precision") for name, score in models.items()]
    results = parts[0].unionByName(parts[1]).unionByName(parts[2])
    best = max((r for r in results.collect() if r.model != L.MAJORITY), key=lambda r: (r.high_risk_f2, r.macro_f1, r.high_risk_precision))
    assert M.select_model(results).first()["model"] == best.model


def test_a_class_that_never_occurs_has_probability_zero(train):
    two = train.where(f"{TARGET} < 2")
    rows = L.fit_models(two, 3, (L.MAJORITY, L.NAIVE_BAYES))[L.NAIVE_BAYES](train).collect()
    assert {r.p2 for r in rows} == {0.0} and all(abs(r.p0 + r.p1 - 1) < 1e-9 for r in rows)
