"""Streaming form of the airport feature job (Structured Streaming).

``readStream`` of raw rows → the same parse expressions as the batch job →
event-time watermark → sum and count per (hour, airport). A row touches one
state entry; the four windows an hour belongs to are added up when the table
is read (``airport_means``), as the batch plan does. The watermark bounds the
state.

Output modes of the table:

* ``append`` with a watermark: each hour is emitted once, when the watermark
  passes its end; a later row of it is dropped. ``airport_means(final=True)``
  gives the windows whose hours are all closed. A bounded input leaves the
  last hours open, so append mode alone is not equal to the batch job on a
  finite file set.
* ``complete``: the full result every trigger; equal to the batch job once
  the input is consumed (used by the test and the registered query).

Micro-batch N is written as partition ``_batch=N``, replaced as a whole if the
batch is replayed after a failure, so no row is written twice. In complete mode
the table is its newest batch; older ones are dropped after the newer is
there.

The number of state-store partitions is ``spark.sql.shuffle.partitions`` at
the stream's first start and is kept in its checkpoint; size it for the
number of live (hour, airport) keys, not for the batch jobs (200 state
partitions for a few thousand keys costs ~4x the time of 8 here).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.airport import WINDOW_SIZE, WINDOW_SLIDE, slide_sums, window_means
from ..operators.parse import parse_flights
from ..session import configure, drop_paths, exists, is_file, scratch_path
from ..sources.events_flights import raw_flights_from_events

BATCH = "_part_of_batch"
KEYS = ["origin_airport_id"]


def airport_stream(flights: DataFrame, slide: str = WINDOW_SLIDE,
                   watermark: str | None = "4 hours") -> DataFrame:
    """Streaming sums per airport and hour; ``timestamp`` is cast to a zoned
    timestamp (watermarks need one; the session zone is UTC, so values are
    unchanged)."""
    s = flights.withColumn("_et", F.col("timestamp").cast("timestamp"))
    if watermark:
        s = s.withWatermark("_et", watermark)
    return slide_sums(s, "_et", KEYS, "departure_delay_minutes", slide)


def batch_sink(path: str, output_mode: str = "append", fmt: str = "parquet"):
    """The ``foreachBatch`` function that writes a micro-batch to ``path``."""
    def sink(batch: DataFrame, batch_id: int):
        (batch.withColumn(BATCH, F.lit(int(batch_id))).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).format(fmt).save(path))
        if output_mode == "complete":
            drop_paths(batch.sparkSession, [f"{path}/{BATCH}={batch_id - 1}"])
    return sink


def run_to_table(stream: DataFrame, path: str, checkpoint: str, output_mode: str = "complete",
                 fmt: str = "parquet") -> None:
    """Run a stream over all available input (``availableNow``) into a table
    at ``path``. Restarts resume from ``checkpoint``."""
    q = (stream.writeStream.outputMode(output_mode).foreachBatch(batch_sink(path, output_mode, fmt))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def read_stream_table(spark: SparkSession, path: str, schema, output_mode: str = "complete",
                      fmt: str = "parquet") -> DataFrame:
    """The table a stream of ``schema`` wrote; empty where no batch ran yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    t = spark.read.format(fmt).load(path)
    if output_mode == "complete":
        newest = t.agg(F.max(BATCH)).first()[0]
        t = t.filter(F.col(BATCH) == F.lit(newest))
    return t.select(*[f.name for f in schema.fields])


def airport_means(hours: DataFrame, final: bool = False, size: str = WINDOW_SIZE,
                  slide: str = WINDOW_SLIDE) -> DataFrame:
    """Window means from a table of hourly sums; ``final`` keeps the windows
    that end by the end of the newest closed hour."""
    out = window_means(hours, KEYS, "average_departure_delay", size, slide)
    if final:
        newest = hours.agg(F.max("_b")).first()[0]
        out = out.filter(F.col("window_end") <= F.lit(newest).cast("timestamp") + F.expr(f"INTERVAL {slide}"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      *KEYS, "average_departure_delay")


def events_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """File stream over ``events.parquet``: a folder of part files, or one
    file (then the folder is watched with a name filter)."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if is_file(spark, path):
        return r.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return r.parquet(path)


# Streaming airport means in complete mode, read back as a table
def q_stream_airport_mean(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    flights = parse_flights(raw_flights_from_events(events_stream(spark, sf))).flights
    out = scratch_path(spark, "stream_airport_mean")
    stream = airport_stream(flights)
    run_to_table(stream, out + "/table", out + "/_checkpoint", output_mode="complete")
    return airport_means(read_stream_table(spark, out + "/table", stream.schema))
