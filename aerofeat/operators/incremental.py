"""A model that is kept up month by month: moments that merge, and a fit that
starts from the last coefficients.

The imputation means and population deviations of the training rows follow from (rows,
present values, mean, sum of squared deviations) per month and feature; these
merge exactly, so a refresh reads the new months alone for them. The logistic
regression is Newton's method: one distributed aggregate a step gives loss, gradient and
Hessian (one row reaches the driver), and a start near the optimum saves most of the steps.
Its optimum is that of ``operators.model``: L2 with ``1 / C`` on the weights, none on
the constant.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TRAIN_FEATURES
from .model import INVERSE_REGULARISATION

# --- fixed values -----------------------------------------------------------
TOLERANCE = 1e-9       # largest scaled gradient at the optimum, relative to the rows
MOST_STEPS = 100
# ---------------------------------------------------------------------------


class LinearModel(NamedTuple):
    """Weights on the raw features: a missing value takes the feature's mean."""
    features: list[str]
    means: list[float]
    deviations: list[float]
    constant: float
    weights: list[float]
    steps: int = 0


def _value(c: str):
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def moments(rows: DataFrame, by: list[str], features=TRAIN_FEATURES) -> DataFrame:
    """(by..., ``feature``, ``n_rows``, ``n``, ``mean``, ``m2``) of each part of
    the training rows: present values, their mean and summed squared deviations."""
    sums = [x for i, c in enumerate(features) for x in (
        F.count(_value(c)).alias(f"n{i}"), F.avg(_value(c)).alias(f"a{i}"), F.var_pop(_value(c)).alias(f"v{i}"))]
    one = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    parts = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("mean"),
                               (F.col(f"v{i}") * F.col(f"n{i}")).alias("m2")) for i, c in enumerate(features)])
    return one.select(*by, "n_rows", F.explode(parts).alias("p")).select(*by, "p.feature", "n_rows", "p.n", "p.mean", "p.m2")


def merged(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The moments of all ``parts`` together, or for each value of ``by``; any
    grouping of the parts gives the same. Parts without values do not count."""
    by = [*(by or []), "feature"]
    whole = parts.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n"),
        F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2"))).alias("p"))     # one entry for each part
    mean = F.aggregate("p", F.lit(0.0), lambda s, x: s + x["n"] * x["mean"]) / F.col("n")
    with_mean = whole.withColumn("mean", F.when(F.col("n") > 0, mean))
    m2 = F.aggregate("p", F.lit(0.0), lambda s, x: s + x["m2"] + x["n"] * (x["mean"] - F.col("mean")) * (x["mean"] - F.col("mean")))
    return with_mean.select(*by, "n_rows", "n", "mean", F.when(F.col("n") > 0, m2).alias("m2"))


def scales(parts: DataFrame, features=TRAIN_FEATURES) -> tuple[list[float], list[float], int]:
    """Means, population deviations of the imputed columns (1 where there is
    none), and the number of rows. A feature without any value raises."""
    found = {r["feature"]: r for r in merged(parts).collect()}      # one row for each feature
    missing = [c for c in features if c not in found or found[c]["mean"] is None]
    if missing:
        raise ValueError(f"no values of {missing} in the training rows")
    rows = found[features[0]]["n_rows"]
    spread = [math.sqrt(found[c]["m2"] / rows) for c in features]   # imputed values add no deviation
    return [found[c]["mean"] for c in features], [s if s > 0 else 1.0 for s in spread], rows


def fit_newton(rows: DataFrame, means: list[float], deviations: list[float], label: str = "target",
               features=TRAIN_FEATURES, C: float = INVERSE_REGULARISATION, start: LinearModel | None = None,
               tol: float = TOLERANCE) -> LinearModel:
    """Fit on all ``rows`` with the given scaling, from ``start`` or from zero. A
    step that does not lower the loss is halved; no optimum within
    ``MOST_STEPS`` passes raises."""
    k = len(features) + 1
    x = [F.lit(1.0)] + [F.col(f"x{i}") for i in range(1, k)]
    data = rows.select(F.col(label).cast("double").alias("y"), *[
        ((F.coalesce(_value(c), F.lit(m)) - m) / s).alias(f"x{i}")
        for i, (c, m, s) in enumerate(zip(features, means, deviations), 1)]).persist(StorageLevel.MEMORY_AND_DISK)
    ridge = np.array([0.0] + [1 / C] * (k - 1))

    def at(b: np.ndarray):
        z = sum((F.lit(float(b[i])) * x[i] for i in range(1, k)), F.lit(float(b[0])))
        p = 1 / (1 + F.exp(-F.col("z")))
        # log(1 + exp(z)) without overflow
        loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("y") * F.col("z")
        got = data.withColumn("z", z).withColumn("p", p).agg(
            F.count("y").alias("n"), F.sum(loss).alias("loss"),
            *[F.sum((F.col("p") - F.col("y")) * x[i]).alias(f"g{i}") for i in range(k)],
            *[F.sum(F.col("p") * (1 - F.col("p")) * x[i] * x[j]).alias(f"h{i}{j}") for i in range(k) for j in range(i + 1)]).first()
        if not got["n"]:
            raise ValueError("empty training set")
        g = np.array([got[f"g{i}"] for i in range(k)]) + ridge * b
        h = np.array([[got[f"h{max(i, j)}{min(i, j)}"] for j in range(k)] for i in range(k)]) + np.diag(ridge)
        return got["loss"] + 0.5 * float(ridge @ (b * b)), g, h, got["n"]

    b = np.zeros(k)
    if start is not None:       # the same function of the raw features, in the new scaling
        old = dict(zip(start.features, zip(start.weights, start.means)))
        raw = [old[c][0] for c in features]
        b[1:] = [w * s for w, s in zip(raw, deviations)]
        b[0] = start.constant + sum(w * (m - old[c][1]) for c, w, m in zip(features, raw, means))
    try:
        loss, g, h, n = at(b)
        passes, scale = 1, 1.0
        while np.abs(g).max() > tol * n:
            if passes >= MOST_STEPS:
                raise RuntimeError(f"no optimum within {MOST_STEPS} passes")
            trial = b - scale * np.linalg.solve(h, g)
            got = at(trial)
            passes += 1
            if got[0] <= loss + 1e-12 * abs(loss):
                b, scale, (loss, g, h, n) = trial, 1.0, got
            else:
                scale /= 2
    finally:
        data.unpersist()
    return LinearModel(list(features), means, deviations, float(b[0]), [float(w / s) for w, s in zip(b[1:], deviations)], passes)


def score_linear(model: LinearModel, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` with ``probability`` and ``prediction``: column expressions."""
    z = F.lit(model.constant)
    for c, w, m in zip(model.features, model.weights, model.means):
        z = z + F.lit(w) * (F.coalesce(_value(c), F.lit(m)) - F.lit(m))
    p = 1 / (1 + F.exp(-z))
    return df.select(*keep, p.alias("probability"), (p > 0.5).alias("prediction"))
