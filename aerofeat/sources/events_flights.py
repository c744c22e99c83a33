"""``raw_flights``: the driver's ``events`` table seen as raw flight CSV data.

The driver tables hold no flights, so the flight pipeline runs on an
all-string table computed from ``events`` by plain column expressions (one
narrow projection, no shuffle). It injects every kind of dirty value the
parser must handle (header rows, bad dates and times, non-numbers, empty
fields, commas inside a field) at fixed ``event_id`` residues, so the data
grows with ``events`` and every row is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import per_context

# --- fixed values -----------------------------------------------------------
# (column, residue rule) of the derived table; the DuckDB twin in
# ``plans/oracle.py`` spells the same rules in SQL.
HEADER_EVERY = 97          # Year = 'Year'                 when event_id % 97 = 0
SLASH_DATE = (89, 1)       # FlightDate = MM/dd/yyyy       when event_id % 89 = 1
EMPTY_DATE = (89, 2)       # FlightDate = ''               when event_id % 89 = 2
BAD_WHEELS = (83, 3)       # WheelsOff = '2400'            when event_id % 83 = 3
EMPTY_WHEELS = (83, 4)     # WheelsOff = ''                when event_id % 83 = 4
EMPTY_DEP = (79, 5)        # DepDelay = ''                 when event_id % 79 = 5
ALPHA_DEP = (79, 6)        # DepDelay = 'abc'              when event_id % 79 = 6
EMPTY_ARR = (73, 7)        # ArrDelay = ''                 when event_id % 73 = 7
EMPTY_DIST = (71, 8)       # Distance = ''                 when event_id % 71 = 8
EMPTY_CANCEL = (67, 9)     # Cancelled = ''                when event_id % 67 = 9
DIVERTED = (61, 10)        # Diverted = '1.00'             when event_id % 61 = 10
N_AIRPORTS = 20            # OriginAirportID = 10000 + user_id % 20
# ---------------------------------------------------------------------------

RAW_FLIGHT_COLUMNS = ["event_id", "Year", "FlightDate", "Reporting_Airline",
                      "Flight_Number_Reporting_Airline", "OriginAirportID", "OriginCityName",
                      "WheelsOff", "DepDelay", "ArrDelay", "TaxiOut", "Distance", "Cancelled",
                      "Diverted"]


def _is(rule) -> "F.Column":
    m, r = rule
    return (F.col("event_id") % m) == r


def raw_flights_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return events.select(*_raw_flight_columns(), *keep)


@per_context
def _raw_flight_columns() -> list:
    s = "string"
    ts = F.col("ts")
    whole = F.floor("value").cast("bigint")
    return [
        F.col("event_id"),
        F.when(F.col("event_id") % HEADER_EVERY == 0, F.lit("Year"))
         .otherwise(F.date_format(ts, "yyyy")).alias("Year"),
        F.when(_is(SLASH_DATE), F.date_format(ts, "MM/dd/yyyy"))
         .when(_is(EMPTY_DATE), F.lit(""))
         .otherwise(F.date_format(ts, "yyyy-MM-dd")).alias("FlightDate"),
        F.upper(F.substring("event_type", 1, 2)).alias("Reporting_Airline"),
        F.col("user_id").cast(s).alias("Flight_Number_Reporting_Airline"),
        (F.lit(10000) + F.col("user_id") % N_AIRPORTS).cast(s).alias("OriginAirportID"),
        F.concat(F.lit("City "), (F.col("user_id") % N_AIRPORTS).cast(s), F.lit(", ST"))
         .alias("OriginCityName"),
        F.when(_is(BAD_WHEELS), F.lit("2400")).when(_is(EMPTY_WHEELS), F.lit(""))
         .otherwise(F.date_format(ts, "HHmm")).alias("WheelsOff"),
        F.when(_is(EMPTY_DEP), F.lit("")).when(_is(ALPHA_DEP), F.lit("abc"))
         .otherwise((whole - 20).cast(s)).alias("DepDelay"),
        F.when(_is(EMPTY_ARR), F.lit(""))
         .otherwise((whole - 18 + F.col("event_id") % 7).cast(s)).alias("ArrDelay"),
        (F.lit(5) + F.col("event_id") % 30).cast(s).alias("TaxiOut"),
        F.when(_is(EMPTY_DIST), F.lit(""))
         .otherwise((F.lit(100) + F.col("event_id") % 2000).cast(s)).alias("Distance"),
        F.when(_is(EMPTY_CANCEL), F.lit(""))
         .when((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0), F.lit("1.00"))
         .otherwise(F.lit("0.00")).alias("Cancelled"),
        F.when(_is(DIVERTED), F.lit("1.00")).otherwise(F.lit("0.00")).alias("Diverted"),
    ]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_flights_from_events(read_events(spark, sf_dir))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
