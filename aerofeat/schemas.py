"""Schemas of every table the engine reads or writes.

All schemas are declared once as ``StructType`` so that no reader infers
types (inference costs an extra pass over the data and can flip a column's
type from one monthly file to the next).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# Column names of the monthly on-time-performance CSV, in file order. The raw
# file is read positionally, so this list must match the published layout
# exactly (109 names).
RAW_COLUMNS = [
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate",
    "Reporting_Airline", "DOT_ID_Reporting_Airline", "IATA_CODE_Reporting_Airline",
    "Tail_Number", "Flight_Number_Reporting_Airline", "OriginAirportID",
    "OriginAirportSeqID", "OriginCityMarketID", "Origin", "OriginCityName",
    "OriginState", "OriginStateFips", "OriginStateName", "OriginWac",
    "DestAirportID", "DestAirportSeqID", "DestCityMarketID", "Dest", "DestCityName",
    "DestState", "DestStateFips", "DestStateName", "DestWac", "CRSDepTime",
    "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15", "DepartureDelayGroups",
    "DepTimeBlk", "TaxiOut", "WheelsOff", "WheelsOn", "TaxiIn", "CRSArrTime",
    "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15", "ArrivalDelayGroups",
    "ArrTimeBlk", "Cancelled", "CancellationCode", "Diverted", "CRSElapsedTime",
    "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
    "FirstDepTime", "TotalAddGTime", "LongestAddGTime", "DivAirportLandings",
    "DivReachedDest", "DivActualElapsedTime", "DivArrDelay", "DivDistance",
    "Div1Airport", "Div1AirportID", "Div1AirportSeqID", "Div1WheelsOn",
    "Div1TotalGTime", "Div1LongestGTime", "Div1WheelsOff", "Div1TailNum",
    "Div2Airport", "Div2AirportID", "Div2AirportSeqID", "Div2WheelsOn",
    "Div2TotalGTime", "Div2LongestGTime", "Div2WheelsOff", "Div2TailNum",
    "Div3Airport", "Div3AirportID", "Div3AirportSeqID", "Div3WheelsOn",
    "Div3TotalGTime", "Div3LongestGTime", "Div3WheelsOff", "Div3TailNum",
    "Div4Airport", "Div4AirportID", "Div4AirportSeqID", "Div4WheelsOn",
    "Div4TotalGTime", "Div4LongestGTime", "Div4WheelsOff", "Div4TailNum",
    "Div5Airport", "Div5AirportID", "Div5AirportSeqID", "Div5WheelsOn",
    "Div5TotalGTime", "Div5LongestGTime", "Div5WheelsOff", "Div5TailNum",
]
# Header of the read-instances CSV.
READ_INSTANCE_COLUMNS = ["flight", "airport", "timestamp"]
# Columns the training reader uses, and the feature order of the model.
TRAIN_FEATURES = ["DepDelay", "TaxiOut", "Distance"]
TRAIN_SOURCE_COLUMNS = ["Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance",
                        "ArrDelay", "FlightDate"]
# Delay (minutes) above which an arrival counts as late.
LATE_ARRIVAL_MINUTES = 15.0
# Features ingested for the two entity types.
FLIGHT_ENTITY_FEATURES = ["origin_airport_id", "is_cancelled", "departure_delay_minutes",
                          "arrival_delay_minutes", "taxi_out_minutes", "distance_miles"]
AIRPORT_ENTITY_FEATURES = ["average_departure_delay"]
# ---------------------------------------------------------------------------

assert len(RAW_COLUMNS) == 109 and len(set(RAW_COLUMNS)) == 109

# Positional raw schema: every field a string; PERMISSIVE CSV parsing drops
# surplus trailing fields and fills missing ones with null.
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

# Event times carry no zone in the source (UTC by contract); they are kept
# as ``timestamp_ntz`` so the wall-clock value never shifts with the session.
FLIGHT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("flight_number", T.StringType(), False),
    T.StructField("origin_airport_id", T.StringType(), False),
    T.StructField("is_cancelled", T.BooleanType(), False),
    T.StructField("departure_delay_minutes", T.DoubleType(), False),
    T.StructField("arrival_delay_minutes", T.DoubleType(), False),
    T.StructField("taxi_out_minutes", T.DoubleType(), False),
    T.StructField("distance_miles", T.DoubleType(), False),
])

AIRPORT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampNTZType(), True),
    T.StructField("origin_airport_id", T.StringType(), False),
    T.StructField("average_departure_delay", T.DoubleType(), False),
])

READ_INSTANCE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in READ_INSTANCE_COLUMNS])

TRAIN_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType(), True) for c in TRAIN_FEATURES]
    + [T.StructField("target", T.BooleanType(), False)])


def relaxed(schema: T.StructType) -> T.StructType:
    """Same fields, all nullable (Spark derives nullability from the plan;
    a filtered-out null still leaves the column typed nullable)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def conform(df, schema: T.StructType):
    """Schema contract (the record-type → schema mapping of the reference):
    project ``df`` to ``schema``'s columns by name and type. ``DataFrame.to``
    raises on a missing column or a type that cannot be cast safely, so a
    drifting upstream fails loudly instead of writing a malformed feature
    file. Non-null fields are checked by the parser, not by the plan."""
    return df.to(relaxed(schema))
