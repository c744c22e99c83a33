import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from aerofeat.plans.jobs import evaluate_requests, merge_online, read_online
from aerofeat.sources import csv as csvsrc

T0 = dt.datetime(2024, 1, 1)
ROW = "id string, t timestamp_ntz, v double"


def view(spark, path):
    return {r.id: (r.t, r.v) for r in read_online(spark, path, "id", "t", ["v"]).collect()}


def test_loads_in_any_order_and_twice_give_one_view(spark, tmpdir_path):
    rnd = random.Random(1)
    loads = {i: [(rnd.choice([None, *"abcdefghijkl"]), rnd.choice([None, *[T0 + dt.timedelta(hours=h) for h in range(9)]]),
                  rnd.choice([None, 1.0, 2.0, 3.0])) for _ in range(60)] for i in (1, 2, 3)}
    best = {}
    for i, rows in loads.items():
        for k, t, v in rows:
            if k is not None and t is not None:
                best[k] = max(best.get(k, (T0 - dt.timedelta(1),)), (t, i, v is not None, v or 0.0))
    want = {k: (t, v if known else None) for k, (t, _, known, v) in best.items()}
    for order in ((1, 2, 3), (3, 1, 2, 1, 3)):
        path = f"{tmpdir_path}/{len(order)}"
        for i in order:
            merge_online(spark.createDataFrame(loads[i], ROW), path, "id", "t", ["v"], i, buckets=4)
        assert view(spark, path) == want


def test_only_the_touched_buckets_are_written(spark, tmpdir_path):
    path = tmpdir_path + "/view"
    merge_online(spark.createDataFrame([(f"e{i}", T0, 1.0) for i in range(200)], ROW), path, "id", "t", ["v"], 1, buckets=8)

    def files():
        return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    merge_online(spark.createDataFrame([("e7", T0 + dt.timedelta(1), 9.0)], ROW), path, "id", "t", ["v"], 2, buckets=8)
    after = files()
    assert len({f.split("bucket_of_8=")[1][0] for f in before}) == 8
    changed = {f.split("bucket_of_8=")[1][0] for f in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(before[f] == after[f] for f in before.keys() & after.keys())
    got = view(spark, path)
    assert got["e7"] == (T0 + dt.timedelta(1), 9.0) and len(got) == 200 and got["e8"] == (T0, 1.0)
    with pytest.raises(ValueError):
        merge_online(spark.createDataFrame([("x", T0, 1.0)], ROW), path, "id", "t", ["v"], 3, buckets=16)


def test_head_opens_no_file_behind_the_one_that_fills_it():
    sizes = {f"f{i}": n for i, n in enumerate([3, 0, 4, 10, 10, 10, 10, 10, 10])}
    opened = []

    def count(files):
        opened.extend(files)
        return {f: sizes[f] for f in files if sizes[f]}
    files = list(sizes)
    for n, want, most in ((0, 0, 0), (1, 1, 1), (3, 1, 1), (4, 3, 3), (7, 3, 3), (8, 4, 7), (1000, 9, 9)):
        opened.clear()
        assert csvsrc.head_files(files, n, count) == files[:want] and len(opened) <= most
    assert csvsrc.head_files([], 5, count) == []


def test_named_head_reads_only_the_files_that_hold_it(spark, tmpdir_path):
    for i in range(6):
        with open(f"{tmpdir_path}/part-{i}.csv", "w") as f:
            f.write("a,b\n" if i % 2 else "b,a\n")
            f.writelines(f"{i},{r}\n" if i % 2 else f"{r},{i}\n" for r in range(10))
    got = csvsrc.read_named_head(spark, tmpdir_path + "/*.csv", 15, ["a", "b"])
    assert [(r.a, r.b) for r in got.collect()] == [("0", str(r)) for r in range(10)] + [("1", str(r)) for r in range(5)]
    assert sorted(os.path.basename(f) for f in got.inputFiles()) == ["part-0.csv", "part-1.csv"]
    assert csvsrc.read_named_head(spark, tmpdir_path + "/*.csv", 0, ["a", "b"]).count() == 0
    assert csvsrc.read_named_head(spark, tmpdir_path + "/*.csv", 100, ["a", "b"]).count() == 60


def test_stream_evaluation_adds_up_and_a_replay_changes_nothing(spark, tmpdir_path):
    from aerofeat.operators import model
    rnd = random.Random(2)
    rows = [(f"2024-01-0{1 + i % 3}", float(rnd.randrange(-20, 60)), 10.0, 100.0 + i, rnd.random() < 0.4) for i in range(90)]
    schema = "day string, DepDelay double, TaxiOut double, Distance double, target boolean"
    df = spark.createDataFrame(rows, schema)
    fitted = model.fit_model(df)
    for i in range(3):
        df.filter(F.pmod(F.col("Distance").cast("long"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(tmpdir_path + "/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(tmpdir_path + "/in")

    def got():
        return {(str(r.date), r.actual, r.predicted): r.n for r in spark.read.parquet(tmpdir_path + "/out").collect()}
    evaluate_requests(fitted, stream, "day", tmpdir_path + "/out", tmpdir_path + "/_c")
    want = {}
    for r in model.score(fitted, df, keep=("day", "target")).collect():
        want[r.day, r.target, r.prediction] = want.get((r.day, r.target, r.prediction), 0) + 1
    first = got()
    assert len(first) == 12 and {k: n for k, n in first.items() if n} == {(d, a, bool(p)): n for (d, a, p), n in want.items()}
    commits = tmpdir_path + "/_c/commits"
    os.replace(f"{commits}/2", f"{tmpdir_path}/commit-2")       # the last micro-batch runs again
    crc = f"{commits}/.2.crc"
    if os.path.exists(crc):
        os.replace(crc, f"{tmpdir_path}/commit-2.crc")
    evaluate_requests(fitted, stream, "day", tmpdir_path + "/out", tmpdir_path + "/_c")
    assert got() == first
