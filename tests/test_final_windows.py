import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from aerofeat.streaming import final_windows as fw

ROW = "et timestamp, event_id long, origin_airport_id string, departure_delay_minutes double"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def put(spark, path, rows, schema=ROW):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def run(spark, d, checkpoint="/_gate"):
    fw.gate(spark.readStream.schema(ROW).parquet(d + "/in"), "et", d, d + checkpoint)


def means(spark, d):
    fw.final_means(fw.on_time(spark, d, ROW), "et", d + "/means", d + "/_means")
    if not os.path.exists(d + "/means"):
        return {}
    rows = spark.read.parquet(d + "/means").collect()
    got = {(r.origin_airport_id, (r.window_start - T0).total_seconds() / 3600): r.average_departure_delay for r in rows}
    assert len(got) == len(rows)                    # each window once
    return got


def brute(rows, airport, closed):
    out = {}
    for s in range(-4, 60):
        v = [d for t, _, a, d in rows if a == airport and at(s) <= t < at(s + 4)]
        if v and s + 4 <= closed:
            out[airport, float(s)] = sum(v) / len(v)
    return out


def test_windows_close_over_several_runs_and_late_rows_are_kept(spark, tmpdir_path):
    d = tmpdir_path
    first = [(at(h + 0.5), i, "A", float(h)) for i, h in enumerate((0, 1, 2, 9, 20))]
    put(spark, d + "/in", first)
    run(spark, d)
    one = means(spark, d)
    assert one == brute(first, "A", 16.5)           # newest row 20:30 less 4 hours
    # 16:30 is the gate's watermark now: an hour that ended by then is late, the rest is not
    second = [(at(15.2), 10, "A", 100.0), (at(16.1), 11, "A", 50.0), (at(40), 12, "B", 1.0), (None, 13, "A", 1.0)]
    put(spark, d + "/in", second)
    run(spark, d)
    late = spark.read.parquet(d + "/late").collect()
    assert sorted(r.event_id for r in late) == [10, 13]
    kept = first + second[1:3]
    assert means(spark, d) == brute(kept, "A", 36) | brute(kept, "B", 36)
    assert spark.read.parquet(d + "/on_time").count() == len(kept)
    # the last batch of the gate runs again: the same split
    shutil.copytree(d + "/_gate", d + "/_again", ignore=lambda p, names: [n for n in names if p.endswith("commits") and "1" in n])
    run(spark, d, "/_again")
    assert sorted(r.event_id for r in spark.read.parquet(d + "/late").collect()) == [10, 13]
    assert spark.read.parquet(d + "/on_time").count() == len(kept) and means(spark, d) == brute(kept, "A", 36) | brute(kept, "B", 36)


def test_requests_without_a_mean_get_nulls_once_the_watermarks_pass(spark, tmpdir_path):
    d = tmpdir_path
    mean = [(at(h - 4), at(h), "A", float(h)) for h in (4, 5, 6)] + [(at(100), at(104), "", None)]
    put(spark, d + "/means", mean, fw.MEAN_SCHEMA)
    asked = [(1, "A", at(4)), (2, "A", at(5.99)), (3, "A", at(8)), (4, "B", at(5)), (5, None, at(5)), (6, "A", at(103))]
    request = "event_id long, airport string, time timestamp"
    put(spark, d + "/requests", asked, request)

    def run():
        fw.enrich(spark.readStream.schema(request).parquet(d + "/requests"), spark.readStream.schema(fw.MEAN_SCHEMA).parquet(d + "/means"),
                  d + "/out", d + "/_enriched")
        return {r.event_id: (r.feature_time, r.average_departure_delay) for r in spark.read.parquet(d + "/out").collect()}
    settled = {1: (at(4), 4.0), 2: (at(5), 5.0), 3: (None, None), 4: (None, None), 5: (None, None)}
    assert run() == settled                         # the sixth may still get one
    put(spark, d + "/means", [(at(98.5), at(102.5), "A", 7.0)], fw.MEAN_SCHEMA)
    assert run() == settled | {6: (at(102.5), 7.0)}


def test_plan_of_the_windows_has_two_stateful_aggregates(spark, tmpdir_path):
    put(spark, tmpdir_path + "/in", [(T0, 1, "A", 1.0)])
    out = fw.final_windows(spark.readStream.schema(ROW).parquet(tmpdir_path + "/in"), "et")
    assert out.isStreaming and out.columns == [c.split()[0] for c in fw.MEAN_SCHEMA.split(", ")]
    assert fw.final_windows(spark.read.parquet(tmpdir_path + "/in"), "et").filter(F.col("average_departure_delay") == 1.0).count() == 4


def test_requests_meet_only_the_means_of_their_stretch(spark, tmpdir_path):
    d = tmpdir_path
    ends = [0.25 * i + 4 for i in range(0, 60, 5)]          # not on the hour
    mean = [(at(e - 4), at(e), a, e + len(a)) for e in ends for a in ("A", "BB")]
    close = [(at(100), at(104), "", None)]
    asked = [(i, a, at(3 + 0.125 * i)) for i in range(140) for a in ("A", "BB", "C")]
    put(spark, d + "/means", mean + close, fw.MEAN_SCHEMA)
    request = "event_id long, airport string, time timestamp"
    put(spark, d + "/requests", asked + [(-1, "", at(104))], request)
    requests, means = (spark.readStream.schema(x).parquet(d + y) for x, y in ((request, "/requests"), (fw.MEAN_SCHEMA, "/means")))
    fw.enrich(requests, means, d + "/out", d + "/_enriched")
    got = {(r.event_id, r.airport): r.feature_time for r in spark.read.parquet(d + "/out").filter("event_id >= 0").collect()}
    want = {(i, a): next((at(e) for e in ends if a != "C" and at(e) <= t < at(e + 1)), None) for i, a, t in asked}
    assert got == want and len(want) == len(asked)
    # two keys: without the stretch, a request is compared with every mean of its airport
    plan = fw.enriched(spark.read.schema(request).parquet(d + "/requests"), spark.read.schema(fw.MEAN_SCHEMA).parquet(d + "/means"))
    pairs = plan._jdf.queryExecution().executedPlan().toString()
    assert "airport" in pairs and "_stretch" in pairs.split("Join", 1)[1].split("]", 1)[0]
