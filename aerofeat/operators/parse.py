"""Raw flight rows → typed flight records, plus the rejected rows with a reason.

A row becomes a flight when, in this order:

1. it is not a header row (``Year`` = ``'Year'``; dropped silently, not a reject),
2. ``WheelsOff`` has 4 characters, ``FlightDate`` 10, and ``Distance`` is present,
3. ``Cancelled`` (and, unless ``Cancelled`` > 0, ``Diverted``) is a number,
4. FlightDate + WheelsOff is a valid wall-clock time, and DepDelay, ArrDelay,
   TaxiOut and Distance are numbers.

The first failing step names the reject reason. In ``strict`` mode a failure of
step 3, or a line too short to hold a field that step 2 reads, fails the job
(as a plain ``float()`` / missing key would); otherwise it is a reject.

All of it is one projection of built-in expressions: the scan, guards and
casts run in one codegen span, with no shuffle.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flight as ff
from ..functions import per_context
from ..schemas import FLIGHT_SCHEMA

# --- fixed values -----------------------------------------------------------
# Reject reasons, in the order the checks are made.
REASONS = [
    "wheels_off_length", "flight_date_length", "distance_missing",
    "bad_cancelled_flag", "bad_diverted_flag",
    "bad_timestamp", "bad_departure_delay", "bad_arrival_delay", "bad_taxi_out",
    "bad_distance",
]
# 0-based positions of WheelsOff and Distance in the raw layout: a line with
# no more fields than these cannot be checked (a missing key).
WHEELS_OFF_POS = 37
DISTANCE_POS = 54
# ---------------------------------------------------------------------------

class ParsedFlights(NamedTuple):
    flights: DataFrame
    rejects: DataFrame


@per_context
def _flag_parts():
    c = ff.to_double("Cancelled")
    d = ff.to_double("Diverted")
    c_pos = ff.positive(c)
    cancelled_ok = c.isNotNull()
    # `c > 0 or d > 0` evaluates Diverted only when Cancelled is not > 0.
    diverted_ok = c_pos | d.isNotNull()
    is_cancelled = c_pos | F.coalesce(ff.positive(d), F.lit(False))
    return cancelled_ok, diverted_ok, is_cancelled


@per_context
def _typed_columns() -> dict[str, Column]:
    _, _, is_cancelled = _flag_parts()
    return {
        "timestamp": ff.flight_timestamp(),
        "flight_number": ff.flight_number(),
        "origin_airport_id": F.coalesce(F.col("OriginAirportID"), F.lit("")),
        "is_cancelled": is_cancelled,
        "departure_delay_minutes": ff.to_double("DepDelay"),
        "arrival_delay_minutes": ff.to_double("ArrDelay"),
        "taxi_out_minutes": ff.to_double("TaxiOut"),
        "distance_miles": ff.to_double("Distance"),
    }


@per_context
def reject_reason() -> Column:
    """Reason string of the first failing check, null for a good row
    (header rows included: they are not rejects)."""
    t = _typed_columns()
    cancelled_ok, diverted_ok, _ = _flag_parts()
    checks = [
        (~ff.wheels_off_ok(), "wheels_off_length"),
        (~ff.flight_date_ok(), "flight_date_length"),
        (~ff.distance_present(), "distance_missing"),
        (~cancelled_ok, "bad_cancelled_flag"),
        (~diverted_ok, "bad_diverted_flag"),
        (t["timestamp"].isNull(), "bad_timestamp"),
        (t["departure_delay_minutes"].isNull(), "bad_departure_delay"),
        (t["arrival_delay_minutes"].isNull(), "bad_arrival_delay"),
        (t["taxi_out_minutes"].isNull(), "bad_taxi_out"),
        (t["distance_miles"].isNull(), "bad_distance"),
    ]
    assert [name for _, name in checks] == REASONS
    expr = F.when(ff.is_header(), F.lit(None).cast("string"))
    for cond, name in checks:
        expr = expr.when(cond, F.lit(name))
    return expr


@per_context
def is_valid_flight() -> Column:
    """True exactly for the rows that become flights (not a header and no
    reject reason), as a plain conjunction of the checks: the flight
    output filters on this instead of testing the reason string, which keeps
    the generated code of the fused scan-parse stage small."""
    t = _typed_columns()
    cancelled_ok, diverted_ok, _ = _flag_parts()
    cond = ~ff.is_header() & ff.wheels_off_ok() & ff.flight_date_ok() & ff.distance_present()
    cond = cond & cancelled_ok & diverted_ok
    for name in ("timestamp", "departure_delay_minutes", "arrival_delay_minutes",
                 "taxi_out_minutes", "distance_miles"):
        cond = cond & t[name].isNotNull()
    return cond


def _strict_guard(reason: Column, n_fields: Column | None) -> Column:
    """Expression that raises for the rows a plain parser would fail on."""
    bad_flag = reason.isin("bad_cancelled_flag", "bad_diverted_flag")
    cond = bad_flag
    if n_fields is not None:
        # A header row short-circuits before any other field is read.
        short = (~ff.is_header()) & (
            (n_fields <= F.lit(WHEELS_OFF_POS))
            | (ff.wheels_off_ok() & ff.flight_date_ok() & (n_fields <= F.lit(DISTANCE_POS))))
        cond = cond | F.coalesce(short, F.lit(False))
    return F.when(cond, F.raise_error(F.concat(
        F.lit("unparseable flight row: "), F.coalesce(reason, F.lit("short line")))))


def stage_parse(raw: DataFrame, strict: bool = False, keep: tuple = (),
                n_fields: str | None = None) -> DataFrame:
    """Every raw row typed, with ``_reason`` (null = good), ``_header`` and
    ``_valid`` (a flight): the one projection both outputs of
    :func:`split_parsed` come from (only the used columns are computed)."""
    typed = _typed_columns()
    reason, valid = reject_reason(), is_valid_flight()
    if strict:
        nf = F.col(n_fields) if n_fields else (
            F.col("_n_fields") if "_n_fields" in raw.columns else None)
        guard = _strict_guard(reason, nf)
        # the guard comes first inside each output's own expression, so
        # every row is checked whichever filter the optimizer runs first
        reason = F.coalesce(guard.cast("string"), reason)
        valid = F.coalesce(guard.cast("boolean"), valid)
    cols = [F.col(k) for k in keep] + [v.alias(k) for k, v in typed.items()]
    cols += [reason.alias("_reason"), ff.is_header().alias("_header"), valid.alias("_valid")]
    return raw.select(*cols)


def split_parsed(staged: DataFrame, keep: tuple = ()) -> ParsedFlights:
    flights = staged.filter(F.col("_valid")).select(*keep, *FLIGHT_SCHEMA.names)
    rejects = staged.filter(F.col("_reason").isNotNull()) \
        .select(*keep, F.col("_reason").alias("reason"))
    return ParsedFlights(flights, rejects)


def parse_flights(raw: DataFrame, strict: bool = False, keep: tuple = (),
                  n_fields: str | None = None) -> ParsedFlights:
    """Split raw rows into typed flights and rejects.

    ``keep`` names raw columns to carry along (e.g. a row key). ``n_fields``
    names a column holding each line's field count (default ``_n_fields``
    when present, as ``sources.csv.read_raw_lines`` gives); strict mode uses
    it to detect short lines. The two outputs are two filters of one
    projection; to compute both from one read, persist
    :func:`stage_parse` and call :func:`split_parsed`.
    """
    return split_parsed(stage_parse(raw, strict, keep, n_fields), keep)


def flight_records(raw: DataFrame, strict: bool = False, keep: tuple = ()) -> DataFrame:
    return parse_flights(raw, strict=strict, keep=keep).flights
