"""Sinks: feature files, the single read-instances CSV, train/test CSV,
monthly layout, and append-only feature-table loads.

Every writer is a plain ``DataFrameWriter`` call; the format is a parameter
(Parquet by default; Avro needs the external ``spark-avro`` package, which
is not on this class path).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import AIRPORT_SCHEMA, FLIGHT_SCHEMA, READ_INSTANCE_COLUMNS, conform

# --- fixed values -----------------------------------------------------------
AVRO_NAMESPACE = "flight_delay_prediction"
FLIGHT_RECORD_NAME = "Flight"
AIRPORT_RECORD_NAME = "Airport"
# ---------------------------------------------------------------------------


def write_features(df: DataFrame, path: str, schema: T.StructType, record_name: str,
                   fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write feature rows with a fixed schema (``df.to`` fails on drift)."""
    out = conform(df, schema)
    if fmt == "avro":       # the writer derives the record schema from the columns
        out = out.select(*[F.col(f.name).cast("timestamp") if isinstance(f.dataType, T.TimestampNTZType)
                           else F.col(f.name) for f in schema.fields])
    w = out.write.mode(mode).format(fmt)
    if fmt == "avro":
        w = w.option("recordName", record_name).option("recordNamespace", AVRO_NAMESPACE)
    w.save(path)


def write_flight_features(flights: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_features(flights.select(*FLIGHT_SCHEMA.names), path, FLIGHT_SCHEMA, FLIGHT_RECORD_NAME, fmt)


def write_airport_features(airports: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_features(airports.select(*AIRPORT_SCHEMA.names), path, AIRPORT_SCHEMA, AIRPORT_RECORD_NAME, fmt)


def write_csv_files(df: DataFrame, path: str, num_files: int | None = None, header: bool = True,
                    mode: str = "overwrite") -> None:
    """CSV with a header in every part file.

    ``num_files=None`` writes in parallel, one file per partition (readers
    take the folder). ``num_files=1`` gives the single file of the original
    layout: ``repartition(1)`` (not ``coalesce``) keeps everything upstream
    parallel, but the write itself is then one task, so keep it for outputs
    that fit one task."""
    out = df if num_files is None else df.repartition(int(num_files))
    out.write.mode(mode).option("header", header).option("escape", '"').csv(path)


def write_read_instances(instances: DataFrame, path: str, num_files: int | None = None) -> None:
    write_csv_files(instances.select(*READ_INSTANCE_COLUMNS), path, num_files)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header, no index column, parallel part files."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_partitions(df: DataFrame, path: str, by: list[str], fmt: str = "parquet",
                     mode: str = "overwrite") -> None:
    """Write a partitioned table; with dynamic partition overwrite only the
    partitions present in ``df`` are replaced. Rows are dealt by partition, and
    the adaptive planner splits a large one and joins small ones by their measured
    size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): files and tasks follow the data."""
    (df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).format(fmt).save(path))


def write_monthly(df: DataFrame, path: str, year: str = "year", month: str = "month",
                  fmt: str = "parquet", mode: str = "overwrite") -> None:
    """``{path}/year=YYYY/month=MM`` layout (the month with two digits; it
    reads back as a number). Only the months present in ``df`` are replaced."""
    write_partitions(df.withColumn(month, F.format_string("%02d", F.col(month).cast("int"))), path,
                     [year, month], fmt, mode)


FEATURE_DATE = "feature_date"


def append_load(df: DataFrame, table_path: str, load_id: int, fmt: str = "parquet",
                feature_time: str = "timestamp") -> None:
    """Add one load of feature rows to a feature table as its ``load_id``,
    partitioned by feature date and load. Only this load's partitions of the
    dates it holds are replaced, so re-running a load after a failure does not
    duplicate it. The latest-load-wins view is the upsert
    (``operators.pit.upsert``) over all loads, applied on read; a date range
    prunes it."""
    rows = df.withColumn(FEATURE_DATE, F.to_date(feature_time)).withColumn("load_id", F.lit(int(load_id)))
    write_partitions(rows, table_path,
                     [FEATURE_DATE, "load_id"], fmt)


def write_entity_table(df: DataFrame, name: str, path: str, entity_id: str, feature_time: str, buckets: int,
                       fmt: str = "parquet") -> DataFrame:
    """Feature rows as a catalogue table bucketed by entity and sorted by time:
    the merge of its loads and the latest values then need no shuffle of the
    table. ``buckets`` is part of the layout; size it for the table's bytes over
    the bytes a task should read. All rows of an entity are one bucket, so a table
    whose entities are few and very large keeps the layout of ``append_load``."""
    (df.repartition(buckets, entity_id).write.mode("overwrite").format(fmt).option("path", path)
       .bucketBy(buckets, entity_id).sortBy(entity_id, feature_time).saveAsTable(name))
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)
