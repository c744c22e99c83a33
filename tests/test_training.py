from pyspark.sql import functions as F

from aerofeat.operators import training
from aerofeat.sources.events_flights import raw_flights
from conftest import SF001

COLS = "Cancelled string, Diverted string, DepDelay string, TaxiOut string, Distance string, " \
       "ArrDelay string, FlightDate string"


def test_labels_and_completed(spark):
    rows = [
        ("0.00", "0.00", "1", "2", "3", "15", "2020-05-01"),      # not late
        ("0.00", "0.00", "1", "2", "3", "15.1", "2020-05-01"),    # late
        ("0.00", "0.00", "1", "2", "3", "", "2020-05-01"),        # missing → false
        ("0.00", "0.00", "1", "2", "3", "nan", "2020-05-01"),     # NaN → false
        ("", "0.00", "1", "2", "3", "20", "2020-05-01"),          # empty flag → completed
        ("1.00", "0.00", "1", "2", "3", "20", "2020-05-01"),      # cancelled
        ("0.00", "1.00", "1", "2", "3", "20", "2020-05-01"),      # diverted
        ("nan", "0.00", "1", "2", "3", "20", "2020-05-01"),       # NaN flag → completed
    ]
    df = spark.createDataFrame(rows, COLS)
    lab = training.labelled(df).collect()
    assert [r["target"] for r in lab] == [False, True, False, False, True, True]


def test_split_by_date(spark):
    rows = [("0.00", "0.00", "1", "2", "3", "20", d) for d in
            ["2020-05-19", "2020-05-20", "2020-05-21", None, ""]]
    sp = training.split_by_date(spark.createDataFrame(rows, COLS), "2020-05-20")
    assert sp.train.count() == 2          # 05-19 and '' (empty sorts below)
    assert sp.test.count() == 2           # the split date belongs to the test set
    assert sp.train.columns == ["DepDelay", "TaxiOut", "Distance", "target"]


def test_split_partitions_completed_flights(spark):
    raw = raw_flights(spark, SF001)
    sp = training.split_by_date(raw, "2024-01-20", keep=("event_id",))
    done = training.completed_flights(raw, keep=("event_id",))
    tr = {r[0] for r in sp.train.select("event_id").collect()}
    te = {r[0] for r in sp.test.select("event_id").collect()}
    allc = {r[0] for r in done.filter(F.col("FlightDate").isNotNull()).select("event_id").collect()}
    assert not (tr & te)
    assert tr | te == allc


def test_numeric_source_columns(spark):
    rows = [(0.0, 0.0, 1.0, 2.0, 3.0, 20.0, "2020-05-01"), (float("nan"), 0.0, None, 2.0, 3.0, None, "2020-05-02"),
            (1.0, 0.0, 1.0, 2.0, 3.0, 20.0, "2020-05-03")]
    df = spark.createDataFrame(rows, "Cancelled double, Diverted double, DepDelay double, TaxiOut double, "
                                     "Distance double, ArrDelay double, FlightDate string")
    lab = training.labelled(df).collect()
    assert [(r["DepDelay"], r["target"]) for r in lab] == [(1.0, True), (None, False)]
