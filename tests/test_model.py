import numpy as np
import pytest

from aerofeat.operators import model, training
from aerofeat.sources.events_flights import raw_flights
from conftest import SF01


def newton_logreg(X, y, C=1.0, iters=50):
    """L2 logistic regression (penalty 0.5·||w||², intercept free) by Newton."""
    n, d = X.shape
    A = np.c_[X, np.ones(n)]
    w = np.zeros(d + 1)
    reg = np.r_[np.ones(d) / C, 0.0]
    for _ in range(iters):
        p = 1 / (1 + np.exp(-A @ w))
        g = A.T @ (p - y) + reg * w
        H = A.T @ (A * (p * (1 - p))[:, None]) + np.diag(reg)
        w -= np.linalg.solve(H, g)
    return w


def test_model_matches_newton_solve(spark):
    sp = training.split_by_date(raw_flights(spark, SF01), "2024-01-20")
    pdf = sp.train.toPandas()
    X = pdf[["DepDelay", "TaxiOut", "Distance"]].to_numpy(dtype=float)
    X = np.where(np.isnan(X), np.nanmean(X, axis=0), X)
    X = (X - X.mean(axis=0)) / X.std(axis=0)       # population std
    y = pdf["target"].to_numpy(dtype=float)
    w = newton_logreg(X, y)
    m = model.fit_model(sp.train)
    c = model.coefficients(m)
    assert c["coefficients"] == pytest.approx(w[:3].tolist(), rel=2e-3, abs=2e-3)
    assert c["intercept"] == pytest.approx(w[3], rel=2e-3, abs=2e-3)


def test_score_save_load(spark, tmpdir_path):
    sp = training.split_by_date(raw_flights(spark, SF01), "2024-01-20")
    m = model.fit_model(sp.train)
    path = tmpdir_path + "/model"
    model.save_model(m, path)
    m2 = model.load_model(path)
    inst = spark.createDataFrame([(-4.0, 16.0, 153.0)], "DepDelay double, TaxiOut double, Distance double")
    a = model.score(m, inst).first()
    b = model.score(m2, inst).first()
    assert a["probability"] == pytest.approx(b["probability"])
    assert a["prediction"] == (a["probability"] > 0.5)
    s = model.score(m, sp.test, keep=("target",))
    assert s.count() == sp.test.count()
