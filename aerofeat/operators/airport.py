"""Sliding event-time mean of departure delay per airport.

Window semantics: windows are ``[start, start + size)``, start aligned to
multiples of ``slide`` from the epoch, so each flight falls into
``size / slide`` windows (4 for 4 h every 1 h). The feature row is stamped
with the window start; ``window_end`` is kept for point-in-time lookups.

Two equivalent plans:

* ``direct`` — ``groupBy(window(ts, size, slide), airport).avg``: Spark
  expands every row into ``size/slide`` copies (``Expand``), aggregates
  partially per task, shuffles on (window, airport), then finalises.
* ``bucketed`` (default) — aggregate ``sum``/``count`` per (airport, slide
  bucket) first, then fan each bucket out to the ``size/slide`` windows
  that contain it and add up. Rows are touched once instead of
  ``size/slide`` times; the fan-out runs on the (tiny) bucket table. The
  mean is ``sum / count`` both ways: equal to the direct plan whenever the
  sums are exact (delays are whole minutes), and within rounding otherwise.

Skew: both plans combine map-side before the shuffle, so a hot airport
contributes at most one partial row per (task, bucket) to the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import AIRPORT_SCHEMA

# --- fixed values -----------------------------------------------------------
WINDOW_SIZE = "4 hours"
WINDOW_SLIDE = "1 hour"
# ---------------------------------------------------------------------------


def _seconds(spec: str) -> int:
    """Seconds of a duration such as ``'4 hours'`` (Spark interval syntax)."""
    n, unit = spec.strip().split(None, 1)
    unit = unit.lower().rstrip("s")
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}[unit]
    return int(float(n) * mult)


def sliding_mean(df: DataFrame, ts: str, keys: list[str], value: str, out: str,
                 size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                 method: str = "bucketed") -> DataFrame:
    """Generic sliding-window mean: one row per (window, keys) with at least
    one row, columns ``window_start, window_end, *keys, out``."""
    size_s, slide_s = _seconds(size), _seconds(slide)
    if method == "direct" or size_s % slide_s != 0:
        g = df.groupBy(F.window(ts, size, slide).alias("w"), *keys) \
            .agg(F.avg(value).alias(out))
        return g.select(F.col("w.start").alias("window_start"),
                        F.col("w.end").alias("window_end"), *keys, out)
    return window_means(slide_sums(df, ts, keys, value, slide), keys, out, size, slide)


def slide_sums(df: DataFrame, ts: str, keys: list[str], value: str, slide: str = WINDOW_SLIDE) -> DataFrame:
    """One pass over the rows: sum and count per (keys, slide bucket), as
    ``keys, _b, _sum, _n``. Also the stream's aggregate."""
    v = F.col(value).cast("double")
    return (df.groupBy(*keys, F.window(ts, slide).alias("_w"))
              .agg(F.sum(v).alias("_sum"), F.count(v).alias("_n"))
              .select(*keys, F.col("_w.start").alias("_b"), "_sum", "_n"))


def window_means(buckets: DataFrame, keys: list[str], out: str, size: str = WINDOW_SIZE,
                 slide: str = WINDOW_SLIDE) -> DataFrame:
    """Each bucket belongs to the ``size / slide`` windows starting at b,
    b - slide, …: fan the buckets out, add up and divide."""
    size_s, slide_s = _seconds(size), _seconds(slide)
    k = F.explode(F.sequence(F.lit(0), F.lit(size_s // slide_s - 1))).alias("_k")
    fanned = buckets.select(*keys, "_b", "_sum", "_n", k)
    start = F.col("_b") - F.make_dt_interval(secs=F.col("_k") * F.lit(slide_s))
    g = (fanned.groupBy(*keys, start.alias("window_start"))
               .agg(F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n")))
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(size_s))
    mean = F.when(F.col("_n") > 0, F.col("_sum") / F.col("_n"))
    return g.select("window_start", end.alias("window_end"), *keys, mean.alias(out))


def airport_windows(flights: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                    method: str = "bucketed") -> DataFrame:
    """(window_start, window_end, origin_airport_id, average_departure_delay)."""
    return sliding_mean(flights, "timestamp", ["origin_airport_id"],
                        "departure_delay_minutes", "average_departure_delay",
                        size=size, slide=slide, method=method)


def airport_features(flights: DataFrame, size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE,
                     method: str = "bucketed") -> DataFrame:
    """Airport feature rows in AIRPORT_SCHEMA: the window start is the
    feature time (the summary covers ``[timestamp, timestamp + size)``)."""
    w = airport_windows(flights, size, slide, method)
    return w.select(F.col("window_start").alias("timestamp"), "origin_airport_id",
                    "average_departure_delay").select(*AIRPORT_SCHEMA.names)
