"""Plan properties that the scale design relies on (read from the physical
plan, not from timings)."""

import re

from aerofeat.operators.airport import airport_windows
from aerofeat.operators.evaluation import roc_curve
from aerofeat.operators.parse import parse_flights
from aerofeat.operators.pit import asof_join, upsert
from aerofeat.plans import catalog
from aerofeat.sources import csv as csvsrc
from conftest import SF001
from helpers import line, write_lines


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_scan_reads_only_used_columns(spark, tmp_path):
    p = write_lines(str(tmp_path / "a.csv"), [line(), line()])
    fl = parse_flights(csvsrc.read_raw_csv(spark, p)).flights
    text = plan(fl)
    cols = re.search(r"FileScan csv \[([^\]]*)\]", text).group(1).split(",")
    assert len(cols) == 12, cols          # 12 of the 109 raw columns


def test_parse_is_one_stage(spark):
    text = plan(catalog.q_flight_records(spark, SF001))
    assert "Exchange" not in text


def test_bucketed_window_has_no_row_expansion(spark):
    fl = catalog._flights(spark, SF001)
    bucketed = plan(airport_windows(fl))
    direct = plan(airport_windows(fl, method="direct"))
    assert "Expand" in direct and "Expand" not in bucketed
    # partial aggregation below every exchange
    assert bucketed.count("partial_sum") >= 2


def test_roc_has_no_unpartitioned_window_over_scores(spark):
    tr = catalog._split(spark, SF001).train.filter("DepDelay is not null")
    roc = roc_curve(tr, "target", "DepDelay", n_ranges=4)
    roc.collect()
    text = roc._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in text.splitlines() if "Window [" in ln]
    # score-level windows are partitioned by range id; only the per-range
    # table (n_ranges rows) is ordered without a partition
    assert any("[_r" in ln for ln in windows)
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_asof_windows_are_ranged(spark):
    fl = catalog._flights(spark, SF001)
    feats = airport_windows(fl)
    j = asof_join(fl, feats, ["origin_airport_id"], ["origin_airport_id"], "timestamp",
                  "window_end", ["average_departure_delay"])
    text = plan(j)
    parts = re.findall(r"Window \[.*?\], \[([^\]]*)\]", text)
    assert parts and all("_k0" in p for p in parts)
    # the window over lookups is keyed by (key, range), never by the key alone
    assert any("_range" in p for p in parts)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # the feature rows were computed once, before this plan: it reads written tables only
    assert "window_end" not in "".join(re.findall(r"HashAggregate\(keys=\[[^\]]*", text))


def test_upsert_is_one_shuffle_and_one_key_sort(spark):
    fl = catalog._flights(spark, SF001).selectExpr("*", "1 AS load_id")
    text = plan(upsert(fl, "flight_number", "timestamp", ["departure_delay_minutes"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Aggregate" not in text
    assert "WindowGroupLimit" in text          # a repeated key is thinned before the shuffle


def test_bucketed_table_is_merged_and_served_without_a_shuffle(spark):
    out = catalog.q_bucketed_table_latest(spark, SF001)
    rows = out.collect()
    text = out._jdf.queryExecution().executedPlan().toString()
    assert rows and "Exchange" not in text and "Bucketed: true" in text
