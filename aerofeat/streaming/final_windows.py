"""Final airport windows of a stream, the rows that came too late for them, and
requests enriched with the newest final mean.

``gate`` splits a stream at a watermark of its own: a row whose hour had ended before
the newest event time of the earlier micro-batches less the delay is late. Late
rows go to a side table, the others to a table that ``final_means`` streams on. Its
two chained aggregates (an hour's sums, then the windows that hold the hour)
emit each window once, when the watermark has passed its end; since the gate waits
no longer than the aggregates do, they drop nothing that it let through.

``enriched`` joins requests with those means, stream with stream: a request gets the
mean of the window that ended within the hour before it, and nulls once the
watermarks show that there is none. Both sides' state holds about an hour plus
the delays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.airport import WINDOW_SIZE, WINDOW_SLIDE, _seconds
from ..session import exists
from .airport_stream import BATCH, batch_sink

DELAY = "4 hours"
MEAN_SCHEMA = "window_start timestamp, window_end timestamp, origin_airport_id string, average_departure_delay double"


def _finish(stream: DataFrame, sink, checkpoint: str) -> None:
    query: StreamingQuery = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    query.awaitTermination()


def gate(rows: DataFrame, event_time: str, path: str, checkpoint: str, delay: str = DELAY,
         slide: str = WINDOW_SLIDE) -> None:
    """Split the available input of a stream into ``path/on_time`` and
    ``path/late``. Micro-batch N is judged by the newest event time of the batches
    before it, kept in ``path/newest``; a batch that is run again replaces its own
    partitions, so the split does not change. A row without a time is late."""
    spark = rows.sparkSession
    sinks = {name: batch_sink(f"{path}/{name}") for name in ("on_time", "late", "newest")}

    def split(batch: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id and exists(spark, f"{path}/newest"):
            # one row for each earlier micro-batch
            newest = batch.sparkSession.read.parquet(f"{path}/newest").filter(F.col(BATCH) < batch_id).agg(F.max("newest")).first()[0]
        seconds = _seconds(slide)
        end = F.timestamp_seconds((F.floor(F.unix_seconds(event_time) / seconds) + 1) * seconds)
        late = F.col(event_time).isNull()
        if newest is not None:
            late = late | (end <= F.lit(newest) - F.expr(f"INTERVAL {delay}"))
        batch = batch.withColumn("_late", F.coalesce(late, F.lit(True))).persist()
        try:
            sinks["on_time"](batch.filter("not _late").drop("_late"), batch_id)
            sinks["late"](batch.filter("_late").drop("_late"), batch_id)
            sinks["newest"](batch.agg(F.max(event_time).alias("newest")), batch_id)
        finally:
            batch.unpersist()

    _finish(rows, split, checkpoint)


def on_time(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows that ``gate`` let through, as a stream."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{path}/on_time")


def final_means(rows: DataFrame, event_time: str, path: str, checkpoint: str, delay: str = DELAY,
                size: str = WINDOW_SIZE, slide: str = WINDOW_SLIDE) -> None:
    """Append the windows that the available input closes to ``path``
    (``MEAN_SCHEMA``). A window that is open stays in the state for the next run."""
    _finish(final_windows(rows, event_time, delay, size, slide), batch_sink(path), checkpoint)


def final_windows(rows: DataFrame, event_time: str, delay: str = DELAY, size: str = WINDOW_SIZE,
                  slide: str = WINDOW_SLIDE) -> DataFrame:
    """The chained aggregates: a row touches one state entry, an hour the few
    windows that hold it."""
    delayed = F.col("departure_delay_minutes").cast("double")
    hours = rows.withWatermark(event_time, delay) \
        .groupBy(F.window(event_time, slide).alias("hour"), "origin_airport_id") \
        .agg(F.sum(delayed).alias("sum"), F.count(delayed).alias("n"))
    windows = hours.groupBy(F.window(F.window_time("hour"), size, slide).alias("w"), "origin_airport_id") \
        .agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    return windows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "origin_airport_id",
                          F.when(F.col("n") > 0, F.col("sum") / F.col("n")).alias("average_departure_delay"))


def enriched(requests: DataFrame, means: DataFrame, delay: str = DELAY, slide: str = WINDOW_SLIDE) -> DataFrame:
    """Requests (``airport``, ``time``, ...) with ``feature_time`` and
    ``average_departure_delay`` of the airport's window that ended at or before the
    request, less than ``slide`` before it: an outer interval join of two streams.
    A mean without an airport joins nothing and does not advance the watermark.

    The stretch of length ``slide`` is a join key beside the airport: a request is in one, and a
    mean stands in the two that its requests can be in. A row then meets the few rows of its
    stretch, not all of its airport, and one airport's rows are dealt over many tasks."""
    seconds = _seconds(slide)
    stretch = lambda c: F.floor(F.unix_seconds(c) / seconds)
    asked = requests.withWatermark("time", delay).withColumn("_stretch", stretch("time")).alias("r")
    known = means.select(F.col("origin_airport_id"), F.col("window_end").alias("feature_time"), "average_departure_delay") \
        .withWatermark("feature_time", delay) \
        .withColumn("_stretch", F.explode(F.array(stretch("feature_time"), stretch("feature_time") + 1))).alias("m")
    near = (F.col("r.airport") == F.col("m.origin_airport_id")) & (F.col("r._stretch") == F.col("m._stretch")) \
        & (F.col("m.feature_time") <= F.col("r.time")) & (F.col("m.feature_time") > F.col("r.time") - F.expr(f"INTERVAL {slide}"))
    return asked.join(known, near, "left_outer") \
        .select("r.*", "m.feature_time", "m.average_departure_delay").drop("_stretch")


def enrich(requests: DataFrame, means: DataFrame, path: str, checkpoint: str, delay: str = DELAY,
           slide: str = WINDOW_SLIDE) -> None:
    """Append the requests whose answer the available input settles to ``path``."""
    _finish(enriched(requests, means, delay, slide), batch_sink(path), checkpoint)
