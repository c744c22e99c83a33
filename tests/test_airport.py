import datetime as dt
import math

from pyspark.sql import functions as F

from aerofeat.operators.airport import airport_features, airport_windows, sliding_mean
from aerofeat.operators.parse import parse_flights
from aerofeat.sources.events_flights import raw_flights
from conftest import SF001


def _flights(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, origin_airport_id string, "
                                       "departure_delay_minutes double")


def test_each_flight_in_four_windows(spark):
    df = _flights(spark, [(dt.datetime(2020, 5, 1, 9, 30), "A", 10.0),
                          (dt.datetime(2020, 5, 1, 10, 0), "A", 20.0)])
    for method in ("bucketed", "direct"):
        w = airport_windows(df, method=method).orderBy("window_start").collect()
        starts = {r["window_start"].hour: r["average_departure_delay"] for r in w}
        # 09:30 → 06..09; 10:00 (on the hour) → 07..10
        assert starts == {6: 10.0, 7: 15.0, 8: 15.0, 9: 15.0, 10: 20.0}, method
        assert all(r["window_end"] - r["window_start"] == dt.timedelta(hours=4) for r in w)


def test_nan_delay_gives_nan_mean(spark):
    df = _flights(spark, [(dt.datetime(2020, 5, 1, 9, 30), "A", float("nan")),
                          (dt.datetime(2020, 5, 1, 9, 40), "A", 5.0)])
    for method in ("bucketed", "direct"):
        vals = [r["average_departure_delay"] for r in airport_windows(df, method=method).collect()]
        assert len(vals) == 4 and all(math.isnan(v) for v in vals)


def test_bucketed_equals_direct(spark):
    fl = parse_flights(raw_flights(spark, SF001)).flights
    a = airport_windows(fl, method="bucketed")
    b = airport_windows(fl, method="direct")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_count_invariant(spark):
    fl = parse_flights(raw_flights(spark, SF001)).flights
    w = airport_windows(fl)
    # every flight contributes to exactly 4 windows: sum of counts = 4 × flights
    buckets = sliding_mean(fl.withColumn("one", F.lit(1.0)), "timestamp", ["origin_airport_id"],
                           "one", "m")
    assert buckets.count() == w.count()
    n = fl.count()
    total = fl.groupBy(F.window("timestamp", "4 hours", "1 hour"), "origin_airport_id").count() \
        .agg(F.sum("count")).first()[0]
    assert total == 4 * n


def test_non_divisible_slide_falls_back(spark):
    df = _flights(spark, [(dt.datetime(2020, 5, 1, 9, 30), "A", 10.0)])
    w = sliding_mean(df, "timestamp", ["origin_airport_id"], "departure_delay_minutes", "m",
                     size="90 minutes", slide="1 hour")
    assert w.count() >= 1


def test_airport_features_schema(spark):
    df = _flights(spark, [(dt.datetime(2020, 5, 1, 9, 30), "A", 10.0)])
    out = airport_features(df)
    assert out.columns == ["timestamp", "origin_airport_id", "average_departure_delay"]
    assert {r["timestamp"].hour for r in out.collect()} == {6, 7, 8, 9}
