import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from aerofeat.operators import pit
from aerofeat.operators.pit import FeatureView, retrieve
from aerofeat.plans.jobs import training_rows

T0 = dt.datetime(2024, 1, 1)


def minutes(n):
    return T0 + dt.timedelta(minutes=n)


def newest(rows, key, t, age):
    """The row of the largest (time, value) not after t, None beyond the age."""
    got = [(rt, v is not None, v) for k, rt, v in rows if k == key and rt is not None and key is not None and t is not None and rt <= t]
    if not got:
        return None, None
    rt, _, v = max(got)
    return (rt, v) if age is None or rt + dt.timedelta(minutes=age) >= t else (None, None)


@pytest.mark.parametrize("n_ranges", [1, 5, 40])
def test_three_views_of_two_keys_equal_brute_force(spark, n_ranges):
    rnd = random.Random(n_ranges)
    keys = ["hot"] * 6 + ["a", "b", None]

    def table():
        return [(rnd.choice(keys), rnd.choice([None, *[minutes(rnd.randrange(900)) for _ in range(30)]]),
                 rnd.choice([None, 1.0, 2.0])) for _ in range(250)]
    x, y, z = table(), table(), table()
    asked = [(i, rnd.choice(keys + ["none"]), rnd.choice(keys), minutes(rnd.randrange(-50, 1000))) for i in range(400)]
    asked += [(1000 + i, "hot", "hot", minutes(500)) for i in range(100)] + [(2000, "hot", "a", None)] + asked[:20]
    df = spark.createDataFrame(asked, "id long, k string, q string, t timestamp_ntz").repartition(5)
    views = [FeatureView(spark.createDataFrame(rows, "e string, ft timestamp_ntz, v double"), on, ["e"], "ft", {"v": name}, f"{name}_time", age)
             for rows, on, name, age in ((x, ["k"], "x", None), (y, ["q"], "y", "40 minutes"), (z, ["k"], "z", "5 minutes"))]
    got = sorted((tuple(r) for r in retrieve(df, "t", views, n_ranges).select("id", "x_time", "x", "y_time", "y", "z_time", "z").collect()), key=str)
    want = sorted(((i, *newest(x, k, t, None), *newest(y, q, t, 40), *newest(z, k, t, 5)) for i, k, q, t in asked), key=str)
    assert got == want


def test_each_table_is_scanned_once_and_wide_rows_are_not_sorted(spark, tmpdir_path, monkeypatch):
    """The plans that are written and the last one: each feature table stands
    in one scan, and the deal carries no column of the instances but the key and time."""
    for name in ("flights", "airports"):
        spark.range(50).select(F.col("id").cast("string").alias("k"), F.lit(T0).cast("timestamp_ntz").alias("t"),
                               F.col("id").cast("double").alias("v")).write.parquet(f"{tmpdir_path}/{name}")
    asked = spark.range(20).select(F.col("id").cast("string").alias("f"), F.col("id").cast("string").alias("a"),
                                   F.lit(minutes(5)).cast("timestamp_ntz").alias("t"), F.lit("wide").alias("payload"))
    plans, stage = [], pit.stage

    def noted(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(), df.columns))
        return stage(df, name)
    monkeypatch.setattr(pit, "stage", noted)
    tables = {n: spark.read.parquet(f"{tmpdir_path}/{n}").select("k", "t", F.col("v").alias(n)) for n in ("flights", "airports")}
    out = retrieve(asked, "t", [FeatureView(tables[n], [on], ["k"], "t", {n: n}) for n, on in (("flights", "f"), ("airports", "a"))])
    assert out.count() == 20 and out.filter("flights is null").count() == 0
    plans.append(("out", out._jdf.queryExecution().optimizedPlan().toString(), []))
    for n in tables:
        assert sum(p.count(f" AS {n}#") for _, p, _ in plans) == 1
    for name, _, columns in plans:
        assert name != "asof_ranges" or "payload" not in columns


def test_training_rows_of_empty_tables(spark):
    asked = spark.createDataFrame([("AA//1", "10", "2024-01-01T00:00:00Z"), (None, None, None)], "flight string, airport string, timestamp string")
    flights = spark.createDataFrame([], "flight_number string, timestamp timestamp_ntz, origin_airport_id string, is_cancelled boolean, "
                                        "departure_delay_minutes double, arrival_delay_minutes double, taxi_out_minutes double, distance_miles double")
    airports = spark.createDataFrame([("10", minutes(-10), 3.0)], "origin_airport_id string, timestamp timestamp_ntz, average_departure_delay double")
    got = {r.flight: (r.timestamp, r.flight_time, r.average_departure_delay) for r in training_rows(asked, flights, airports).collect()}
    assert got == {"AA//1": (T0, None, 3.0), None: (None, None, None)}
    assert training_rows(asked, flights, airports, None, "5 minutes").filter("average_departure_delay is not null").count() == 0
    assert training_rows(asked.limit(0), flights, airports).count() == 0
