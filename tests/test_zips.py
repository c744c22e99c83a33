import os
import zipfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aerofeat.plans.jobs import ingest_monthly
from aerofeat.sources.zips import list_archives, read_zip_lines
from helpers import header, line


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)
    return path


def _csv(n):
    return "\n".join([header()] + [line(Flight_Number_Reporting_Airline=str(i)) for i in range(n)]) + "\n"


def test_lines_and_name_parts(spark, tmp_path):
    _zip(tmp_path / "On_Time_2020_5.zip", {"a.csv": _csv(3)})
    _zip(tmp_path / "2020_06.zip", {"readme.txt": "x", "b.csv": _csv(2)})
    df = read_zip_lines(spark, str(tmp_path / "*.zip"))
    got = sorted((r["file_year"], r["file_month"], r["line_no"]) for r in df.collect())
    assert got == [(2020, 5, i) for i in range(4)] + [(2020, 6, i) for i in range(3)]


def test_zip_without_or_with_two_csvs_raises(spark, tmp_path):
    _zip(tmp_path / "2020_05.zip", {"a.txt": "x"})
    with pytest.raises(PySparkException):
        read_zip_lines(spark, str(tmp_path / "*.zip")).collect()
    d2 = tmp_path / "two"
    os.makedirs(d2)
    _zip(d2 / "2020_05.zip", {"a.csv": _csv(1), "b.csv": _csv(1)})
    with pytest.raises(PySparkException):
        read_zip_lines(spark, str(d2 / "*.zip")).collect()


def test_duplicate_download_name(spark, tmp_path):
    _zip(tmp_path / "2020_05.zip", {"a.csv": _csv(2)})
    _zip(tmp_path / "2020_05 (1).zip", {"a.csv": _csv(2)})
    arch = {os.path.basename(r["path"]): r["name_ok"] for r in list_archives(spark, str(tmp_path / "*.zip")).collect()}
    assert arch == {"2020_05.zip": True, "2020_05 (1).zip": False}
    with pytest.raises(PySparkException):
        read_zip_lines(spark, str(tmp_path / "*.zip")).collect()
    assert read_zip_lines(spark, str(tmp_path / "*.zip"), strict_names=False).count() == 3


def test_ingest_monthly_layout_and_sample(spark, tmp_path):
    _zip(tmp_path / "2020_05.zip", {"a.csv": _csv(7)})
    out, sample = str(tmp_path / "out"), str(tmp_path / "sample")
    raw = ingest_monthly(spark, str(tmp_path / "*.zip"), out, sample_dir=sample, sample_rows=5)
    assert os.path.isdir(os.path.join(out, "file_year=2020", "file_month=05"))
    assert raw.count() == 7                   # the header line is no row
    assert len([f for f in os.listdir(os.path.join(out, "file_year=2020", "file_month=05")) if f.startswith("part-")]) <= 8
    s = spark.read.parquet(sample)
    assert sorted(r[0] for r in s.select("line_no").collect()) == [1, 2, 3, 4, 5]
    assert s.filter(F.col("Year") == "Year").count() == 0


def test_monthly_refresh(spark, tmp_path):
    from aerofeat.plans.jobs import monthly_refresh
    rows = [line(FlightDate=f"2020-05-{d:02d}", DepDelay=str(d * 3 - 20), ArrDelay=str(d * 3 - 10),
                 Flight_Number_Reporting_Airline=str(d)) for d in range(1, 29)]
    _zip(tmp_path / "2020_05.zip", {"a.csv": "\n".join([header()] + rows) + "\n"})
    res = monthly_refresh(spark, str(tmp_path / "*.zip"), str(tmp_path / "raw"),
                          str(tmp_path / "metrics"), split_date="2020-05-20")
    assert res.scored.count() == 9
    cm = spark.read.parquet(str(tmp_path / "metrics/confusion"))
    assert cm.count() == 4
    assert {(r["file_year"], r["file_month"]) for r in cm.collect()} == {(2020, 5)}
    # a re-run of the same month replaces its metrics
    monthly_refresh(spark, str(tmp_path / "*.zip"), str(tmp_path / "raw"),
                    str(tmp_path / "metrics"), split_date="2020-05-20")
    assert spark.read.parquet(str(tmp_path / "metrics/confusion")).count() == 4


def test_refresh_evaluates_the_loaded_month_only(spark, tmp_path):
    from aerofeat.plans.jobs import monthly_refresh

    def month(m, n):
        rows = [line(FlightDate=f"2020-{m:02d}-{d:02d}", DepDelay=str(d * 3 - 20), ArrDelay=str(d * 3 - 10 - d % 5),
                     Flight_Number_Reporting_Airline=str(d)) for d in range(1, n)]
        d = tmp_path / f"zips{m}"
        os.makedirs(d)
        # a concatenated file: a second header in the middle; and no header at all in June
        text = [header(), *rows[:5], header(), *rows[5:]] if m == 5 else rows
        _zip(d / f"2020_{m:02d}.zip", {"a.csv": "\n".join(text) + "\n"})
        return str(d / "*.zip")

    paths = str(tmp_path / "raw"), str(tmp_path / "metrics")
    monthly_refresh(spark, month(5, 29), *paths, split_date="2020-05-20")
    res = monthly_refresh(spark, month(6, 26), *paths, split_date="2020-05-20")
    raw = spark.read.parquet(paths[0])
    assert raw.filter("Year = 'Year'").count() == 0
    assert {(r.file_month, r["count"]) for r in raw.groupBy("file_month").count().collect()} == {(5, 28), (6, 25)}
    assert res.scored.count() == 25 and {r[0] for r in res.scored.select("file_month").distinct().collect()} == {6}
    cm = spark.read.parquet(paths[1] + "/confusion").groupBy("file_month").agg(F.sum("n").alias("n")).collect()
    assert {(r.file_month, r.n) for r in cm} == {(5, 9), (6, 25)}


def test_sample_is_the_first_data_rows_wherever_headers_stand(spark, tmp_path):
    text = [line(Flight_Number_Reporting_Airline="0"), header(), *[line(Flight_Number_Reporting_Airline=str(i)) for i in range(1, 9)]]
    _zip(tmp_path / "2020_07.zip", {"a.csv": "\n".join(text) + "\n"})
    ingest_monthly(spark, str(tmp_path / "*.zip"), str(tmp_path / "out"), sample_dir=str(tmp_path / "sample"), sample_rows=4)
    got = [r[0] for r in spark.read.parquet(str(tmp_path / "sample")).orderBy("line_no").select("Flight_Number_Reporting_Airline").collect()]
    assert got == ["0", "1", "2", "3"]


def test_bytes_that_are_not_utf8_fail(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "2020_05.zip", "w") as z:
        z.writestr("a.csv", b"Year\n\xff\xfe\n")
    with pytest.raises(PySparkException):
        read_zip_lines(spark, str(tmp_path / "*.zip")).collect()


def test_workers_need_no_package(tmp_path):
    """The task function is pickled by value: a worker in another folder,
    without the package on its path, runs it."""
    import subprocess
    import sys
    from pyspark import cloudpickle
    from aerofeat.sources.zips import _extractor
    p = _zip(tmp_path / "2020_05.zip", {"a.csv": _csv(2)})
    with open(tmp_path / "f.pickle", "wb") as f:
        cloudpickle.dump(_extractor(), f)
    code = ("import pickle, sys, pandas as pd; f = pickle.load(open('f.pickle', 'rb'));"
            f"n = sum(map(len, f([pd.DataFrame({{'path': [{str(p)!r}], 'file_year': [2020], 'file_month': [5]}})])));"
            "assert n == 3 and 'aerofeat' not in sys.modules")
    subprocess.run([sys.executable, "-I", "-c", code], cwd=tmp_path, check=True)
