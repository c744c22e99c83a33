"""Read instances: the (flight, airport, time) keys used to look features up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.flight import iso_z
from ..schemas import READ_INSTANCE_COLUMNS


def read_instances(flights: DataFrame) -> DataFrame:
    """One row per flight (not de-duplicated): flight number, origin airport
    and the flight time as ``yyyy-MM-ddTHH:mm:ssZ``. A narrow projection."""
    return flights.select(F.col("flight_number").alias("flight"),
                          F.col("origin_airport_id").alias("airport"),
                          iso_z("timestamp").alias("timestamp")).select(*READ_INSTANCE_COLUMNS)
