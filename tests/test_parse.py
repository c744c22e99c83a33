"""Hand-written CSV lines, one per quirk, through the positional reader and
the flight parser (expected outcomes from FIXTURES.md §4)."""

import datetime as dt
import math
import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from aerofeat.operators.parse import parse_flights
from aerofeat.sources import csv as csvsrc
from helpers import header, line, write_lines

CASES = [
    # (case id, csv line, expected: "kept" | reject reason)
    ("plain", line(), "kept"),
    ("quoted_comma_and_quote", line(OriginCityName='a "b" c, d'), "kept"),
    ("trailing_comma", line(trailing_comma=True), "kept"),
    ("wheels_0000", line(WheelsOff="0000"), "kept"),
    ("wheels_2359", line(WheelsOff="2359"), "kept"),
    ("wheels_930", line(WheelsOff="930"), "wheels_off_length"),
    ("wheels_2400", line(WheelsOff="2400"), "bad_timestamp"),
    ("wheels_2360", line(WheelsOff="2360"), "bad_timestamp"),
    ("wheels_letters", line(WheelsOff="ab12"), "bad_timestamp"),
    ("wheels_empty", line(WheelsOff=""), "wheels_off_length"),
    ("date_slash", line(FlightDate="05/01/2020"), "bad_timestamp"),
    ("date_feb30", line(FlightDate="2020-02-30"), "bad_timestamp"),
    ("date_short", line(FlightDate="2020-5-1"), "flight_date_length"),
    ("distance_empty", line(Distance=""), "distance_missing"),
    ("dep_empty", line(DepDelay=""), "bad_departure_delay"),
    ("dep_alpha", line(DepDelay="abc"), "bad_departure_delay"),
    ("arr_empty_diverted", line(ArrDelay="", Diverted="1.00"), "bad_arrival_delay"),
    ("dep_nan", line(DepDelay="nan"), "kept"),
    ("cancelled_empty", line(Cancelled=""), "bad_cancelled_flag"),
    ("cancelled_x", line(Cancelled="x"), "bad_cancelled_flag"),
    ("cancelled_set_diverted_bad", line(Cancelled="1.00", Diverted="x"), "kept"),
    ("diverted_bad", line(Diverted="x"), "bad_diverted_flag"),
    ("late_evening_0010", line(WheelsOff="0010", FlightDate="2020-05-01"), "kept"),
    ("short_line", line(n_fields=30), "wheels_off_length"),
]


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    lines = [header()]
    for _, ln, _ in CASES:
        lines.append(ln)
    lines.insert(5, header())  # a header line in the middle of the file
    lines.append("")           # a blank line
    p = write_lines(os.path.join(d, "cases.csv"), lines)
    raw = csvsrc.read_raw_csv(spark, p).withColumn("_row", F.monotonically_increasing_id())
    return raw, parse_flights(raw, keep=("_row",))


def test_outcomes_per_case(parsed):
    raw, res = parsed
    flights = {r["_row"]: r for r in res.flights.collect()}
    rejects = {r["_row"]: r["reason"] for r in res.rejects.collect()}
    rows = [r["_row"] for r in raw.orderBy("_row").filter(F.col("Year") != "Year").collect()]
    assert len(rows) == len(CASES)
    for row_id, (name, _, expected) in zip(rows, CASES):
        if expected == "kept":
            assert row_id in flights, name
            assert row_id not in rejects, name
        else:
            assert rejects.get(row_id) == expected, (name, rejects.get(row_id))


def test_headers_are_dropped_not_rejected(parsed):
    raw, res = parsed
    n_headers = raw.filter(F.col("Year") == "Year").count()
    assert n_headers == 2
    kept = sum(1 for c in CASES if c[2] == "kept")
    assert res.flights.count() == kept
    assert res.rejects.count() == len(CASES) - kept


def test_values_of_a_kept_row(parsed):
    _, res = parsed
    r = [x for x in res.flights.collect() if x["timestamp"] == dt.datetime(2020, 5, 1, 9, 30)]
    assert r
    r = r[0]
    assert r["flight_number"] == "AA//100"
    assert r["origin_airport_id"] == "10397"
    assert r["is_cancelled"] is False
    assert (r["departure_delay_minutes"], r["arrival_delay_minutes"], r["taxi_out_minutes"],
            r["distance_miles"]) == (-4.0, -10.0, 16.0, 153.0)


def test_nan_delay_and_no_midnight_rollover(parsed):
    _, res = parsed
    rows = res.flights.collect()
    assert any(math.isnan(r["departure_delay_minutes"]) for r in rows)
    assert any(r["timestamp"] == dt.datetime(2020, 5, 1, 0, 10) for r in rows)
    assert any(r["is_cancelled"] for r in rows)  # Cancelled=1.00, Diverted=x


def test_quoted_fields_decode(spark, tmp_path):
    p = write_lines(str(tmp_path / "q.csv"), [line(OriginCityName='a "b" c, d')])
    r = csvsrc.read_raw_csv(spark, p).first()
    assert r["OriginCityName"] == 'a "b" c, d'
    assert r["Diverted"] == "0.00"


def test_decode_lines_matches_file_reader(spark, tmp_path):
    lines = [line(), line(OriginCityName="Atlanta, GA", trailing_comma=True), line(n_fields=40)]
    p = write_lines(str(tmp_path / "l.csv"), lines)
    a = csvsrc.read_raw_csv(spark, p)
    b = csvsrc.decode_lines(spark.read.text(p))
    key = lambda r: tuple("" if v is None else v for v in r)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_strict_mode_raises_on_bad_flag(spark, tmp_path):
    p = write_lines(str(tmp_path / "s.csv"), [line(), line(Cancelled="")])
    with pytest.raises(PySparkException):
        parse_flights(csvsrc.read_raw_csv(spark, p), strict=True).flights.collect()


def test_strict_mode_raises_on_short_line(spark, tmp_path):
    p = write_lines(str(tmp_path / "s2.csv"), [line(), line(n_fields=30)])
    lines = spark.read.text(p)
    dec = csvsrc.decode_lines(lines, with_field_count=True)
    with pytest.raises(PySparkException):
        parse_flights(dec, strict=True, n_fields="_n_fields").flights.collect()


def test_strict_mode_passes_clean_and_header_rows(spark, tmp_path):
    p = write_lines(str(tmp_path / "s3.csv"), [header(), line(), line(Distance="")])
    dec = csvsrc.decode_lines(spark.read.text(p), with_field_count=True)
    res = parse_flights(dec, strict=True, n_fields="_n_fields")
    assert res.flights.count() == 1
    assert [r["reason"] for r in res.rejects.collect()] == ["distance_missing"]


def test_field_count(spark):
    from aerofeat.functions.flight import csv_field_count
    df = spark.createDataFrame([("a,b,c",), (',,',), ('a,"b,c",d',), ('"a ""b"" c",x',)], "v string")
    assert [r[0] for r in df.select(csv_field_count("v")).collect()] == [3, 3, 3, 2]


def test_strict_file_reader_detects_short_line(spark, tmp_path):
    good = write_lines(str(tmp_path / "g.csv"), [header(), line(), line(trailing_comma=True)])
    res = parse_flights(csvsrc.read_raw_lines(spark, good), strict=True)
    assert res.flights.count() == 2
    bad = write_lines(str(tmp_path / "b.csv"), [line(), line(n_fields=50)])
    with pytest.raises(PySparkException):
        parse_flights(csvsrc.read_raw_lines(spark, bad), strict=True).flights.collect()
    # header rows short-circuit, as in the plain parser
    hdr = write_lines(str(tmp_path / "h.csv"), [line(), "Year,Quarter"])
    assert parse_flights(csvsrc.read_raw_lines(spark, hdr), strict=True).flights.count() == 1


def test_flight_timestamp_edges(spark):
    import datetime as dt
    from aerofeat.functions.flight import flight_timestamp
    rows = [("2020-05-01", "0930", dt.datetime(2020, 5, 1, 9, 30)),
            ("2020-02-29", "2359", dt.datetime(2020, 2, 29, 23, 59)),
            ("2019-02-29", "1200", None), ("2020-13-01", "1200", None),
            ("2020-05-00", "1200", None),
            ("2020-05-01", "2400", None), ("2020-05-01", "0960", None),
            ("2020-05-01", " 930", None), ("2020-05-01", "+930", None),
            ("+020-05-01", "1200", None), ("2020-05-1 ", "1200", None),
            (None, "1200", None), ("2020-05-01", None, None)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "FlightDate string, WheelsOff string")
    got = [r[0] for r in df.select(flight_timestamp()).collect()]
    assert got == [c for _, _, c in rows]


def test_valid_flag_equals_no_reason_and_no_header(spark):
    from aerofeat.operators.parse import stage_parse
    from aerofeat.sources.events_flights import raw_flights
    st = stage_parse(raw_flights(spark, "/root/testdata/sf0.01"))
    both = st.select(F.col("_valid"), (F.col("_reason").isNull() & ~F.col("_header")).alias("x"))
    assert both.filter(F.col("_valid") != F.col("x")).count() == 0
    assert both.filter("_valid").count() == 8810


def test_strict_mode_fails_on_a_blank_line(spark, tmpdir_path):
    p = write_lines(tmpdir_path + "/blank.csv", [line(), "", line()])
    assert parse_flights(csvsrc.read_raw_csv(spark, p)).flights.count() == 2
    with pytest.raises(PySparkException):
        parse_flights(csvsrc.read_raw_lines(spark, p), strict=True).flights.collect()


def test_flight_time_does_not_follow_the_session_zone(spark, tmpdir_path):
    p = write_lines(tmpdir_path + "/dst.csv", [line(FlightDate="2020-03-08", WheelsOff="0230"),
                                               line(FlightDate="0000-03-08", WheelsOff="0230")])
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # 02:30 is skipped there that day
    try:
        got = parse_flights(csvsrc.read_raw_csv(spark, p)).flights.select(F.col("timestamp").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r[0] for r in got] == ["2020-03-08 02:30:00"]
