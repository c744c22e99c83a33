import os
import shutil

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aerofeat.sources.zip_format import FORMAT, MONTH, MonthlyZips, read_archives, write_archives
from aerofeat.sources.zips import read_zip_lines
from aerofeat.streaming.deliveries import refresh_deliveries
from helpers import header, line

LINES = "file_year int, file_month int, n int, value string"


def lines_of(spark, rows):
    return spark.createDataFrame(rows, LINES).repartition(4)


def test_archives_round_trip_in_line_order(spark, tmp_path):
    rows = [(2020 + m % 2, m, i, f"{m},{i},é") for m in range(1, 8) for i in range(50)] + [(2020, 9, 0, None)]
    write_archives(lines_of(spark, rows), str(tmp_path), ["n"])
    assert sorted(os.listdir(tmp_path)) == sorted({f"flights_{y}_{m:02d}.zip" for y, m, _, _ in rows})
    got = read_zip_lines(spark, str(tmp_path / "*.zip"))
    assert got.rdd.getNumPartitions() == 8                     # one for each archive
    assert sorted((r.file_year, r.file_month, r.line_no, r.value) for r in got.collect()) == sorted(
        (y, m, i, v or "") for y, m, i, v in rows)
    # a month that is written again replaces its archive, and that alone
    write_archives(lines_of(spark, [(2020, 2, 0, "new")]), str(tmp_path), ["n"])
    got = read_zip_lines(spark, str(tmp_path / "*.zip")).groupBy("file_month").count().collect()
    assert {r.file_month: r["count"] for r in got} == {**{m: 50 for m in range(1, 8)}, 2: 1, 9: 1}


def test_failed_write_leaves_nothing(spark, tmp_path):
    good = lines_of(spark, [(2020, m, i, "x") for m in range(1, 5) for i in range(2000)])
    bad = good.withColumn("value", F.when((F.col("file_month") == 3) & (F.col("n") == 1500), F.raise_error(F.lit("broken"))).otherwise("x"))
    with pytest.raises(PySparkException):
        write_archives(bad, str(tmp_path), ["n"])
    assert os.listdir(tmp_path) == []
    # a month dealt over two tasks fails at the commit, and leaves nothing either
    spark.dataSource.register(MonthlyZips)
    with pytest.raises(PySparkException):
        good.select(*MONTH, "value").coalesce(2).sortWithinPartitions(*MONTH).write.format(FORMAT).mode("append").save(str(tmp_path))
    with pytest.raises(PySparkException):
        good.select(*MONTH, "value").coalesce(1).write.format(FORMAT).mode("append").save(str(tmp_path))
    assert os.listdir(tmp_path) == []


def test_no_archives_and_no_rows(spark, tmp_path):
    assert read_archives(spark, []).collect() == []
    write_archives(lines_of(spark, []), str(tmp_path), ["n"])
    assert os.listdir(tmp_path) == []


def month(spark, path, m, days, shift=0):
    text = [header()] + [line(FlightDate=f"2020-{m:02d}-{d:02d}", DepDelay=str(d * 3 - 20 + shift), ArrDelay=str(d * 3 - 10 - d % 5),
                              Flight_Number_Reporting_Airline=str(d)) for d in range(1, days)]
    write_archives(lines_of(spark, [(2020, m, i, t) for i, t in enumerate(text)]), path, ["n"])


def counts(spark, path):
    return {r.file_month: r["count"] for r in spark.read.parquet(path).groupBy("file_month").count().collect()}


def content(spark, path):
    return {k: sorted(map(str, spark.read.parquet(f"{path}/{k}").collect())) for k in ("raw", "metrics/roc", "metrics/confusion")}


def test_second_run_opens_new_archives_only(spark, tmp_path):
    zips, root = str(tmp_path / "zips"), str(tmp_path)

    def run():
        refresh_deliveries(spark, zips, root + "/raw", root + "/metrics", "2020-05-20", root + "/_checkpoint")
    month(spark, zips, 5, 29)
    run()
    assert counts(spark, root + "/raw") == {5: 28}
    before = content(spark, root)
    run()                                                       # nothing new
    assert content(spark, root) == before
    # the loaded archive is no archive any more: a run that opened it would fail
    (tmp_path / "zips" / "flights_2020_05.zip").write_bytes(b"gone")
    stat = os.stat(tmp_path / "zips" / "flights_2020_05.zip")
    month(spark, zips, 6, 26)
    month(spark, zips, 7, 11)
    run()
    assert counts(spark, root + "/raw") == {5: 28, 6: 25, 7: 10}
    assert counts(spark, root + "/metrics/confusion") == {5: 4, 6: 4, 7: 4}
    after = content(spark, root)
    assert [r for r in after["raw"] if "file_month=5" in r] == before["raw"] and stat.st_size == 4
    # the last micro-batch runs again, as after a failure before its commit
    commits = tmp_path / "_checkpoint" / "commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    replay = tmp_path / "replayed"
    shutil.copytree(tmp_path / "_checkpoint", replay, ignore=lambda d, names: [n for n in names if d.endswith("commits") and str(last) in n])
    refresh_deliveries(spark, zips, root + "/raw", root + "/metrics", "2020-05-20", str(replay))
    assert content(spark, root) == after


def test_delivery_without_test_rows(spark, tmp_path):
    zips, root = str(tmp_path / "zips"), str(tmp_path)
    month(spark, zips, 5, 25)
    refresh_deliveries(spark, zips, root + "/raw", root + "/metrics", "2021-01-01", root + "/_checkpoint")
    assert counts(spark, root + "/raw") == {5: 24}
    assert not os.path.exists(root + "/metrics/roc/file_year=2020")
