import datetime as dt
import random

import pytest

from aerofeat.operators.pit import asof_join, latest_values, upsert

T0 = dt.datetime(2024, 1, 1)


def _brute(left, right):
    out = []
    for k, t, lid in left:
        if t is None:
            out.append((lid, None, None))
            continue
        cands = [(rt, v) for rk, rt, v in right if rk == k and k is not None and rt <= t]
        if cands:
            rt = max(c[0] for c in cands)
            v = max((c[1] is not None, c[1]) for c in cands if c[0] == rt)[1]
            out.append((lid, rt, v))
        else:
            out.append((lid, None, None))
    return sorted(out, key=lambda x: x[0])


@pytest.mark.parametrize("n_ranges", [1, 3, 16, 64])
def test_asof_matches_brute_force(spark, n_ranges):
    rnd = random.Random(n_ranges)
    keys = ["hot"] * 6 + ["a", "b", "c", None]
    right = [(rnd.choice(keys), T0 + dt.timedelta(minutes=rnd.randrange(0, 3000)),
              rnd.choice([None, 1.0, 2.0, 3.5])) for _ in range(300)]
    left = [(rnd.choice(keys + ["none"]), T0 + dt.timedelta(minutes=rnd.randrange(-100, 3200)), i)
            for i in range(500)]
    left += [(left[0][0], left[0][1], 10_000 + i) for i in range(50)]   # repeated lookup key
    L = spark.createDataFrame(left, "k string, t timestamp_ntz, id long")
    R = spark.createDataFrame(right, "k string, ft timestamp_ntz, v double")
    left += [("a", None, 20_000)]                                       # null lookup time
    L = spark.createDataFrame(left, "k string, t timestamp_ntz, id long")
    got = asof_join(L, R, ["k"], ["k"], "t", "ft", ["v"], out_time="feature_time",
                    n_ranges=n_ranges).collect()
    got = sorted(((r["id"], r["feature_time"], r["v"]) for r in got), key=lambda x: x[0])
    assert got == _brute(left, right)


def test_null_feature_value_is_returned(spark):
    R = spark.createDataFrame([("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=2), None)],
                              "k string, ft timestamp_ntz, v double")
    L = spark.createDataFrame([("a", T0 + dt.timedelta(hours=3))], "k string, t timestamp_ntz")
    r = asof_join(L, R, ["k"], ["k"], "t", "ft", ["v"]).first()
    assert r["v"] is None and r["feature_time"] == T0 + dt.timedelta(hours=2)


def test_upsert_latest_load_wins(spark):
    rows = [("f1", T0, 1.0, 1), ("f1", T0, 5.0, 2), ("f2", T0, 3.0, 1), ("f1", T0, 0.5, 1)]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, v double, load_id int")
    got = {(r["id"], r["t"]): r["v"] for r in upsert(df, "id", "t", ["v"]).collect()}
    assert got == {("f1", T0): 5.0, ("f2", T0): 3.0}


def test_latest_values(spark):
    rows = [("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=1), 2.0), ("b", T0, 3.0)]
    df = spark.createDataFrame(rows, "id string, t timestamp_ntz, v double")
    got = {r["id"]: (r["t"], r["v"]) for r in latest_values(df, "id", "t", ["v"]).collect()}
    assert got == {"a": (T0 + dt.timedelta(hours=1), 2.0), "b": (T0, 3.0)}
