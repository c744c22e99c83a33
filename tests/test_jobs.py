import os

from pyspark.sql import functions as F

from aerofeat.operators.parse import parse_flights
from aerofeat.plans.jobs import daily_confusion, read_feature_table, ingest_features, run_batch_features, run_training
from aerofeat.sources import csv as csvsrc
from aerofeat.sources.events_flights import raw_flights
from conftest import SF001


def _raw_csv(spark, d):
    lines = csvsrc.encode_lines(raw_flights(spark, SF001))
    path = os.path.join(d, "raw")
    lines.write.mode("overwrite").text(path)
    return path


def test_batch_feature_job(spark, tmpdir_path):
    src = _raw_csv(spark, tmpdir_path)
    out = tmpdir_path
    run_batch_features(spark, src + "/*.txt", out + "/airports", out + "/flights", out + "/inst",
                       output_rejects=out + "/rejects", read_instance_files=1)
    flights = spark.read.parquet(out + "/flights")
    expect = parse_flights(raw_flights(spark, SF001)).flights
    assert flights.count() == expect.count()
    inst = spark.read.option("header", True).csv(out + "/inst")
    assert inst.columns == ["flight", "airport", "timestamp"]
    assert inst.count() == flights.count()
    assert len([f for f in os.listdir(out + "/inst") if f.endswith(".csv")]) == 1
    assert inst.filter(~F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ$")).count() == 0
    air = spark.read.parquet(out + "/airports")
    assert air.columns == ["timestamp", "origin_airport_id", "average_departure_delay"]
    assert spark.read.parquet(out + "/rejects").count() > 0


def test_training_job_from_csv(spark, tmpdir_path):
    raw = raw_flights(spark, SF001).select(
        "Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay", "FlightDate")
    path = tmpdir_path + "/train_src"
    raw.coalesce(1).write.option("header", True).csv(path)
    whole = run_training(spark, path, split_date="2024-01-20")
    assert whole.scored.count() == whole.confusion.agg(F.sum("n")).first()[0] > 100
    res = run_training(spark, path, split_date="2024-01-20", model_path=tmpdir_path + "/m",
                       eval_rows=100, metrics_path=tmpdir_path + "/metrics",
                       datasets_path=tmpdir_path + "/sets")
    tr = spark.read.option("header", True).csv(tmpdir_path + "/sets/train")
    assert tr.columns == ["DepDelay", "TaxiOut", "Distance", "target"]
    assert {r[0] for r in tr.select("target").distinct().collect()} <= {"true", "false"}
    assert res.scored.count() == 100
    cm = res.confusion.collect()
    assert len(cm) == 4 and sum(r["n"] for r in cm) == 100
    assert spark.read.parquet(tmpdir_path + "/metrics/roc").count() == res.roc.count()


def test_feature_table_loads(spark, tmpdir_path):
    fl = parse_flights(raw_flights(spark, SF001)).flights
    t = tmpdir_path + "/ft"
    ingest_features(fl, t, "flight_number", "timestamp", ["departure_delay_minutes"], 1)
    ingest_features(fl.withColumn("departure_delay_minutes", F.lit(-1.0)), t, "flight_number",
                    "timestamp", ["departure_delay_minutes"], 2)
    # re-running load 2 replaces it instead of adding a copy
    ingest_features(fl.withColumn("departure_delay_minutes", F.lit(-1.0)), t, "flight_number",
                    "timestamp", ["departure_delay_minutes"], 2)
    assert spark.read.parquet(t).filter("load_id = 2").count() == fl.count()
    day = read_feature_table(spark, t, "flight_number", "timestamp", ["departure_delay_minutes"], since="2024-01-05",
                             until="2024-01-06")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feature_date" in plan and plan.count("Sort [") <= 2
    assert {r[0] for r in day.select(F.to_date("timestamp").cast("string")).distinct().collect()} == {"2024-01-05", "2024-01-06"}
    cur = read_feature_table(spark, t, "flight_number", "timestamp", ["departure_delay_minutes"])
    assert cur.count() == fl.select("flight_number", "timestamp").distinct().count()
    assert cur.filter(F.col("departure_delay_minutes") != -1.0).count() == 0


def test_daily_confusion(spark):
    df = spark.createDataFrame([("d1", True, True), ("d1", False, True), ("d2", False, False)],
                               "day string, target boolean, prediction boolean")
    got = {(r["date"], r["actual"], r["predicted"]): r["n"] for r in daily_confusion(df, "day").collect()}
    assert len(got) == 8 and got[("d1", True, True)] == 1 and got[("d2", True, True)] == 0


def test_conform_rejects_drift(spark):
    import pytest
    from pyspark.errors import PySparkException
    from aerofeat.schemas import AIRPORT_SCHEMA, conform
    bad = spark.createDataFrame([("x", "A", 1.0)], "timestamp string, origin_airport_id string, "
                                                   "average_departure_delay double")
    with pytest.raises(PySparkException):
        conform(bad, AIRPORT_SCHEMA).collect()


def test_batch_job_strict_mode(spark, tmpdir_path):
    import pytest
    from pyspark.errors import PySparkException
    from helpers import header, line, write_lines
    good = write_lines(tmpdir_path + "/good.csv", [header(), line(), line(Distance="")])
    run_batch_features(spark, good, tmpdir_path + "/a1", tmpdir_path + "/f1", tmpdir_path + "/i1",
                       strict=True, output_rejects=tmpdir_path + "/r1")
    assert spark.read.parquet(tmpdir_path + "/f1").count() == 1
    assert spark.read.parquet(tmpdir_path + "/r1").count() == 1
    bad = write_lines(tmpdir_path + "/bad.csv", [line(), line(Cancelled="x")])
    with pytest.raises(PySparkException):
        run_batch_features(spark, bad, tmpdir_path + "/a2", tmpdir_path + "/f2", tmpdir_path + "/i2",
                           strict=True)


def test_first_n_rows_follow_file_order(spark, tmpdir_path):
    """The first N rows in file order, across several files and across
    the splits of a file read as more than one partition."""
    from aerofeat.sources import csv as csvsrc
    d = tmpdir_path + "/ordered"
    os.makedirs(d)
    expected = []
    for f, n in (("a.csv", 5), ("b.csv", 30000), ("c.csv", 5)):
        lines = ["Cancelled,Diverted,DepDelay,TaxiOut,Distance,ArrDelay,FlightDate"]
        for i in range(n):
            lines.append(f"0.00,0.00,{i},1,100,{f[0]}{i:08d},2020-05-01")
            expected.append(f"{f[0]}{i:08d}")
        with open(os.path.join(d, f), "w") as fh:
            fh.write("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")    # b.csv → several splits
    try:
        src = csvsrc.read_named_csv(spark, d, with_order=True)
        assert src.rdd.getNumPartitions() > 3
        got = csvsrc.first_n(src, 20, order=[F.col(c) for c in csvsrc.ORDER_COLUMNS])
        assert [r["ArrDelay"] for r in got.collect()] == expected[:20]
        tail = csvsrc.first_n(src, 30008, order=[F.col(c) for c in csvsrc.ORDER_COLUMNS])
        assert [r["ArrDelay"] for r in tail.collect()][-3:] == expected[30005:30008]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_latest_feature_values_after_loads(spark, tmpdir_path):
    import datetime as dt
    from aerofeat.plans.jobs import latest_feature_values
    t0 = dt.datetime(2024, 1, 1)
    rows1 = [("A", t0, 1.0), ("A", t0 + dt.timedelta(hours=1), 2.0), ("B", t0, 5.0)]
    rows2 = [("A", t0 + dt.timedelta(hours=1), 3.0)]                 # correction of A's latest
    schema = "origin_airport_id string, timestamp timestamp_ntz, average_departure_delay double"
    t = tmpdir_path + "/airport_table"
    ingest_features(spark.createDataFrame(rows1, schema), t, "origin_airport_id", "timestamp",
                    ["average_departure_delay"], 1)
    ingest_features(spark.createDataFrame(rows2, schema), t, "origin_airport_id", "timestamp",
                    ["average_departure_delay"], 2)
    got = {r["origin_airport_id"]: (r["timestamp"], r["average_departure_delay"])
           for r in latest_feature_values(spark, t, "origin_airport_id", "timestamp",
                                          ["average_departure_delay"]).collect()}
    assert got == {"A": (t0 + dt.timedelta(hours=1), 3.0), "B": (t0, 5.0)}


def test_daily_model_evaluation(spark):
    from aerofeat.operators import model, training
    from aerofeat.plans.jobs import daily_model_evaluation
    lab = training.labelled(raw_flights(spark, SF001))
    sp = training.split_by_date(raw_flights(spark, SF001), "2024-01-20")
    fitted = model.fit_model(sp.train)
    test = lab.filter(F.col("FlightDate") >= "2024-01-20")
    daily = daily_model_evaluation(fitted, test, "FlightDate")
    rows = daily.collect()
    days = {r["date"] for r in rows}
    assert len(rows) == 4 * len(days)
    assert sum(r["n"] for r in rows) == test.count()


def test_command_line(spark, tmpdir_path):
    from aerofeat.__main__ import main
    src = _raw_csv(spark, tmpdir_path)
    out = tmpdir_path + "/cli"
    main(["batch", "--input", src + "/*.txt", "--output-airports", out + "/a",
          "--output-flights", out + "/f", "--output-read-instances", out + "/i"], spark=spark)
    assert spark.read.parquet(out + "/f").count() == parse_flights(raw_flights(spark, SF001)).flights.count()
    assert spark.read.parquet(out + "/a").count() > 0


def test_header_of_a_file_in_many_splits_is_read_by_one_task(spark, tmpdir_path):
    # with a task for each split, the first line to arrive could be of any split
    rows = [f"{i},{i % 7}" for i in range(2000)]
    for name, head in (("a", "x,y"), ("b", "y,x"), ("blank", "\n\ufeffx,y"), ("only", "x,y"), ("none", None)):
        with open(f"{tmpdir_path}/{name}.csv", "w", encoding="utf-8") as f:
            f.write("" if head is None else "\n".join([head] + rows * (name in "ab")) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        groups = csvsrc.header_groups(spark, tmpdir_path + "/*.csv")
        track = spark.sparkContext.statusTracker()
        stages = [track.getStageInfo(s) for j in track.getJobIdsForGroup("headers") for s in track.getJobInfo(j).stageIds]
        got = csvsrc.read_named_csv(spark, [f"{tmpdir_path}/{x}.csv" for x in "ab"], columns=["x", "y"])
        assert got.count() == 2 * len(rows) and got.filter("cast(y as int) > 6").count() == 2000 - 7
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: sorted(f.rsplit("/", 1)[1] for f in v) for k, v in groups.items()} == {
        ("x", "y"): ["a.csv", "blank.csv", "only.csv"], ("y", "x"): ["b.csv"]}
    assert max(s.numTasks for s in stages if s) <= 5     # as many as files


def test_named_csv_of_unlike_headers(spark, tmpdir_path):
    """Column orders that differ, an index column, a quoted header, an
    empty file; a file that lacks a column raises."""
    import pytest
    cols = ["Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay", "FlightDate"]
    files = {"a.csv": [",".join(cols), "0,0,1,2,3,4,2020-05-01"],
             "b.csv": ["," + ",".join(cols[::-1]), '7,"2020-05-02",14,13,12,11,0,0'],
             "c.csv": ['"FlightDate","a ""b"", c",' + ",".join(cols[:-1]), "2020-05-03,x,0,0,21,22,23,24"], "d.csv": []}
    for name, lines in files.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write("".join(x + "\n" for x in lines))
    got = sorted(tuple(r) for r in csvsrc.read_named_csv(spark, tmpdir_path + "/*.csv", columns=cols[2:]).collect())
    assert got == [("1", "2", "3", "4", "2020-05-01"), ("11", "12", "13", "14", "2020-05-02"), ("21", "22", "23", "24", "2020-05-03")]
    with open(os.path.join(tmpdir_path, "e.csv"), "w") as f:
        f.write("FlightDate\n2020-05-01\n")
    with pytest.raises(ValueError):
        csvsrc.read_named_csv(spark, tmpdir_path + "/*.csv", columns=cols)


def test_eval_rows_need_an_order(spark):
    import pytest
    with pytest.raises(ValueError):
        run_training(spark, raw_flights(spark, SF001), split_date="2024-01-20", eval_rows=5)


def test_roc_fails_on_a_missing_score(spark):
    import pytest
    from pyspark.errors import PySparkException
    from aerofeat.operators.evaluation import roc_curve
    for bad in (None, float("nan")):
        df = spark.createDataFrame([(True, 0.5), (False, bad)], "target boolean, score double")
        with pytest.raises(PySparkException):
            roc_curve(df).collect()


def test_compaction_keeps_the_view(spark, tmpdir_path):
    from aerofeat.plans.jobs import compact_feature_table
    fl = parse_flights(raw_flights(spark, SF001)).flights
    t, of = tmpdir_path + "/ft", ("flight_number", "timestamp", ["departure_delay_minutes"])
    for i in (1, 2, 3):
        ingest_features(fl.withColumn("departure_delay_minutes", F.col("departure_delay_minutes") + i), t, *of, i)
    before = sorted(map(str, read_feature_table(spark, t, *of).collect()))
    compact_feature_table(spark, t, *of, "2024-01-05", "2024-01-20")
    loads = spark.read.parquet(t).groupBy("feature_date").agg(F.countDistinct("load_id").alias("n")) \
        .select(F.col("feature_date").cast("string").alias("d"), "n").collect()
    assert {r.n for r in loads if "2024-01-05" <= r.d <= "2024-01-20"} == {1} and {r.n for r in loads if r.d < "2024-01-05"} == {3}
    assert sorted(map(str, read_feature_table(spark, t, *of).collect())) == before
