"""Column expressions for the flight record: guards, conversions, flags.

Everything here is a built-in Catalyst expression, so a whole parse stays in
one whole-stage-codegen span; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import LATE_ARRIVAL_MINUTES

# --- fixed values -----------------------------------------------------------
# Wall-clock layout the flight timestamp is built in: FlightDate (ISO date),
# then the wheels-off hour and minute, seconds always zero.
FLIGHT_TS_RE = r"^(?!0000)\d{4}-\d\d-\d\dT\d\d:\d\d:00$"
# Text form of an instant in the read-instances file (ISO 8601 with a Z).
ISO_Z_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Separator between airline code and flight number.
FLIGHT_NUMBER_SEPARATOR = "//"
# Marker of a header row in the Year column.
HEADER_MARKER = "Year"
# ---------------------------------------------------------------------------

# A quoted CSV field (RFC 4180: a quote inside is doubled).
CSV_QUOTED_RE = r'"(?:[^"]|"")*"'


def _s(c) -> Column:
    """String column with null read as the empty string (an empty CSV field
    is null in Spark but an empty string to a plain CSV tokenizer)."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def is_header(year="Year") -> Column:
    return _s(year) == F.lit(HEADER_MARKER)


def wheels_off_ok(wheels_off="WheelsOff") -> Column:
    return F.length(_s(wheels_off)) == 4


def flight_date_ok(flight_date="FlightDate") -> Column:
    return F.length(_s(flight_date)) == 10


def distance_present(distance="Distance") -> Column:
    return _s(distance) != F.lit("")


def to_double(c) -> Column:
    """Lenient string → double: null when the text is not a number."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def positive(x: Column) -> Column:
    """``x > 0`` with NaN false (Spark orders NaN above every number)."""
    return (x > 0) & ~F.isnan(x)


def flight_timestamp(flight_date="FlightDate", wheels_off="WheelsOff") -> Column:
    """FlightDate + wheels-off HHMM → ``timestamp_ntz``; null when the text is
    no valid wall-clock time (``2400``, ``2360``, letters, 30 February, year
    0000, …). No midnight roll-over: the date is always FlightDate.

    One pattern and one cast of the text: a value built from integer parts
    grows the generated code of the fused scan-parse-aggregate stage past the
    JIT's method-size limit, and that stage then ran 2.5-4x slower."""
    d, w = _s(flight_date), _s(wheels_off)
    text = F.concat(d, F.lit("T"), F.substring(w, 1, 2), F.lit(":"), F.substring(w, 3, 2),
                    F.lit(":00"))
    # straight to a zone-free value: a zoned one shifts where the session's zone skips an hour
    return F.when(text.rlike(FLIGHT_TS_RE), text.try_cast("timestamp_ntz"))


def flight_number(airline="Reporting_Airline",
                  number="Flight_Number_Reporting_Airline") -> Column:
    return F.concat(_s(airline), F.lit(FLIGHT_NUMBER_SEPARATOR), _s(number))


def iso_z(ts) -> Column:
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(col, ISO_Z_PATTERN)


def csv_field_count(line) -> Column:
    """Number of fields of a CSV line: separators outside quoted fields + 1."""
    col = F.col(line) if isinstance(line, str) else line
    return F.size(F.split(F.regexp_replace(col, CSV_QUOTED_RE, ""), ",", -1))


# Training-side predicates (by-name reader, numeric columns).

def completed(cancelled: Column, diverted: Column) -> Column:
    """Neither cancelled nor diverted. A missing or NaN flag compares false,
    so such a flight counts as completed."""
    return ~(F.coalesce(positive(cancelled), F.lit(False))
             | F.coalesce(positive(diverted), F.lit(False)))


def late_arrival(arr_delay: Column, minutes: float = LATE_ARRIVAL_MINUTES) -> Column:
    """Arrives more than ``minutes`` late; missing or NaN delay → false."""
    return F.coalesce(F.nanvl(arr_delay, F.lit(None).cast("double")) > F.lit(minutes),
                      F.lit(False))
