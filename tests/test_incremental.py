import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerofeat.operators import incremental, model
from aerofeat.plans.jobs import refresh_model
from aerofeat.sinks.writers import write_monthly

COLUMNS = ["Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay", "FlightDate"]


def raw_rows(months, n=120, seed=3):
    rnd = random.Random(seed)
    rows = []
    for m in months:
        for i in range(n):
            dep = rnd.gauss(5 * m, 20)
            rows.append(("0.00", "0.00", rnd.choice(["", "nan"]) if i % 17 == 0 else f"{dep:.1f}", str(rnd.randrange(5, 40)), str(rnd.randrange(100, 2000)),
                         f"{dep + rnd.gauss(8, 12):.1f}", f"2020-{m:02d}-{1 + i % 28:02d}", 2020, m))
    return rows


def table(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in COLUMNS) + ", file_year int, file_month int")


def test_merged_moments_equal_those_of_all_rows(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abc"), rnd.choice([None, float("nan"), rnd.gauss(1e6, 1.0)]), float(i)) for i in range(300)] + [("d", None, 1.0)]
    df = spark.createDataFrame(rows, "part string, x double, y double").repartition(4)
    parts = incremental.moments(df, ["part"], ["x", "y"])
    got = {r.feature: r for r in incremental.merged(parts).collect()}
    for j, c in ((1, "x"), (2, "y")):
        v = np.array([r[j] for r in rows if r[j] is not None and not np.isnan(r[j])])
        assert got[c].n_rows == len(rows) and got[c].n == len(v)
        assert np.allclose([got[c]["mean"], got[c].m2], [v.mean(), ((v - v.mean()) ** 2).sum()], rtol=1e-9)
    # merged in two steps: the same
    twice = incremental.merged(incremental.merged(parts.withColumn("g", F.col("part") < "c"), ["g"]))
    for r in twice.collect():
        assert np.allclose(r[1:], got[r.feature][1:], rtol=1e-9)


def test_refresh_equals_the_full_fit_and_reads_new_months_only(spark, tmpdir_path):
    raw, state = tmpdir_path + "/raw", tmpdir_path + "/state"
    steps = []
    for months in ((1, 2, 3), (4,), (5,)):
        write_monthly(table(spark, raw_rows(months, seed=months[0])), raw, "file_year", "file_month")
        stored = spark.read.parquet(raw)
        fitted = refresh_model(spark, stored, state, "2020-12-01", [(2020, m) for m in months])
        steps.append(fitted.steps)
    from aerofeat.operators import training
    train = training.split_by_date(stored, "2020-12-01").train
    full = model.coefficients(model.fit_model(train, max_iter=500, tol=1e-13))
    scaled = [w * s for w, s in zip(fitted.weights, fitted.deviations)]
    assert np.allclose(scaled, full["coefficients"], atol=1e-6) and np.isclose(fitted.constant, full["intercept"], atol=1e-6)
    assert steps[2] < steps[0]                      # a start near the optimum
    # the moments of earlier months were not computed again
    spark.read.parquet(state + "/moments").filter("file_month = 5").withColumn("mean", F.lit(0.0)).write.parquet(tmpdir_path + "/other")
    write_monthly(spark.read.parquet(tmpdir_path + "/other"), state + "/moments", "file_year", "file_month")
    refresh_model(spark, stored, state, "2020-12-01", [(2020, 4)])
    assert {r["mean"] for r in spark.read.parquet(state + "/moments").filter("file_month = 5").collect()} == {0.0}
    assert spark.read.parquet(state + "/coefficients").count() == 4


def test_scores_equal_the_pipeline_models(spark):
    from aerofeat.operators import training
    train = training.split_by_date(table(spark, raw_rows((1, 2))), "2020-12-01").train
    means, deviations, n = incremental.scales(incremental.moments(train, []))
    mine = incremental.fit_newton(train, means, deviations)
    other = model.fit_model(train, max_iter=500, tol=1e-13)
    got = sorted(r.probability for r in incremental.score_linear(mine, train, []).collect())
    want = sorted(r.probability for r in model.score(other, train, keep=()).collect())
    assert n == 240 and np.allclose(got, want, atol=1e-6)


def test_no_rows_and_no_values_raise(spark):
    from aerofeat.operators import training
    train = training.split_by_date(table(spark, raw_rows((1,), n=4)), "2020-12-01").train
    with pytest.raises(ValueError):
        incremental.scales(incremental.moments(train.withColumn("TaxiOut", F.lit(None).cast("double")), []))
    with pytest.raises(ValueError):
        incremental.fit_newton(train.limit(0), [0.0] * 3, [1.0] * 3)
