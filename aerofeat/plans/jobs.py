"""Entry points: the batch feature job, the training job, the monthly
ingest, feature-table loads, the monthly refresh and the daily evaluation.

Each is one Python function over a SparkSession; the work is DataFrame
plans run by Spark. Nothing here iterates over data on the driver.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import flight as ff
from ..operators import evaluation, incremental, model, pit, training
from ..operators.airport import airport_features
from ..operators.instances import read_instances
from ..operators.parse import split_parsed, stage_parse
from ..schemas import AIRPORT_ENTITY_FEATURES, FLIGHT_ENTITY_FEATURES, TRAIN_SCHEMA
from ..session import configure, drop_paths, exists, stage
from ..sinks import writers
from ..sources import csv as csvsrc
from ..sources import zips


def _raw(spark: SparkSession, raw, strict: bool = False) -> DataFrame:
    if isinstance(raw, (str, list, tuple)):
        # strict mode needs each line's field count (text scan + decode)
        return csvsrc.read_raw_lines(spark, raw) if strict else csvsrc.read_raw_csv(spark, raw)
    return raw


def run_batch_features(spark: SparkSession, raw, output_airports: str, output_flights: str,
                       output_read_instances: str, fmt: str = "parquet", strict: bool = False,
                       output_rejects: str | None = None,
                       read_instance_files: int | None = None) -> None:
    """Raw CSV (path/glob/list, or a raw DataFrame) → flight features,
    airport sliding means and the read-instances CSV.

    The parsed flights are written once (the flight feature table); the
    airport features and read instances are then computed from that written
    table, so the CSV is parsed once and a lost executor costs a re-read of
    Parquet, not a re-parse. The airport aggregate reads three columns of it.
    The read instances are written in parallel part files unless
    ``read_instance_files`` asks for a fixed number (1 = a single file).
    """
    configure(spark)
    staged = stage_parse(_raw(spark, raw, strict), strict=strict)
    if output_rejects:
        # both outputs from one read of the raw files (K12): the typed rows
        # are kept (memory, spilling to disk) for the second write; a lost
        # block is recomputed from its own input split only
        staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    parsed = split_parsed(staged)
    try:
        writers.write_flight_features(parsed.flights, output_flights, fmt)
        if output_rejects:
            parsed.rejects.write.mode("overwrite").format(fmt).save(output_rejects)
    finally:
        if output_rejects:
            staged.unpersist()
    flights = spark.read.format(fmt).load(output_flights)
    if fmt == "avro":
        flights = flights.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    writers.write_airport_features(airport_features(flights), output_airports, fmt)
    writers.write_read_instances(read_instances(flights), output_read_instances,
                                 read_instance_files)


class TrainingResult(NamedTuple):
    model: PipelineModel
    scored: DataFrame
    roc: DataFrame
    confusion: DataFrame


def run_training(spark: SparkSession, data, split_date: str = training.DEFAULT_SPLIT_DATE,
                 model_path: str | None = None, eval_rows: int | None = None,
                 metrics_path: str | None = None, order: list[str] | None = None,
                 datasets_path: str | None = None, keep: tuple = ()) -> TrainingResult:
    """By-name CSV (or DataFrame) → split by date → fit → evaluate on the
    whole test set → ROC points and confusion matrix.

    ``eval_rows`` asks for the first so many test rows in file order instead;
    for a DataFrame ``order`` must then name the columns that give that order.
    ``keep`` names columns to carry into ``scored``. The scored test set is
    written once to the shared folder; the metrics read it from there.
    ``datasets_path`` also writes the train and test sets as CSV with a header
    (no index column), and ``metrics_path`` the two metrics."""
    configure(spark)
    if isinstance(data, (str, list, tuple)):
        src = csvsrc.read_named_csv(spark, data, with_order=True)
        order = list(csvsrc.ORDER_COLUMNS)
    else:
        src = data
        if eval_rows is not None and not order:
            raise ValueError("eval_rows of a DataFrame needs the order of its rows")
    kept = tuple(dict.fromkeys([*keep, *(order or ())]))
    split = training.split_by_date(src, split_date, keep=kept)
    if datasets_path:
        writers.write_csv(split.train.select(*TRAIN_SCHEMA.names), f"{datasets_path}/train")
        writers.write_csv(split.test.select(*TRAIN_SCHEMA.names), f"{datasets_path}/test")
    fitted = model.fit_model(split.train)
    if model_path:
        model.save_model(fitted, model_path)
    test = split.test
    if eval_rows is not None:
        test = csvsrc.first_n(test, eval_rows, order=[F.col(c) for c in order])
    scored = stage(model.score(fitted, test), "scored")
    roc = evaluation.roc_curve(scored, "target", "probability")
    cm = evaluation.confusion_matrix(scored, "target", "prediction")
    if metrics_path:
        roc.write.mode("overwrite").parquet(f"{metrics_path}/roc")
        cm.write.mode("overwrite").parquet(f"{metrics_path}/confusion")
    return TrainingResult(fitted, scored, roc, cm)


MONTH = ["file_year", "file_month"]


def _months(spark: SparkSession, zip_glob) -> list[tuple[int, int]]:
    """The months of an archive listing (names only)."""
    rows = zips.list_archives(spark, zip_glob).filter("name_ok").select(*MONTH).distinct().orderBy(*MONTH).collect()
    return [tuple(r) for r in rows]


def _of_months(df: DataFrame, months: list[tuple[int, int]]) -> DataFrame:
    """Rows of the given months, as a filter that prunes partitions."""
    match = F.lit(False)
    for y, m in months:
        match = match | ((F.col("file_year") == y) & (F.col("file_month") == m))
    return df.filter(match)


def _first_of_months(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each month in file order: tasks thin a month to
    ``n`` rows each before they are shuffled (Spark's group limit)."""
    place = F.row_number().over(Window.partitionBy(*MONTH).orderBy("line_no"))
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def ingest_monthly(spark: SparkSession, zip_glob, out_dir: str, sample_dir: str | None = None,
                   sample_rows: int | None = 5000, fmt: str = "parquet", strict_names: bool = True) -> DataFrame:
    """Monthly zip archives → raw rows partitioned by ``file_year`` /
    ``file_month``, plus the first ``sample_rows`` data rows of each (file
    order). Only the months of this load are replaced, read and sampled.
    Header lines are known by their value, wherever they stand, and are not
    stored."""
    configure(spark)
    lines = zips.read_zip_lines(spark, zip_glob, strict_names=strict_names)
    # the lines are balanced by size before they are decoded: an archive is one task, a month many
    rows = csvsrc.decode_lines(lines.hint("rebalance"), keep=(*MONTH, "line_no")).filter(~ff.is_header())
    writers.write_monthly(rows, out_dir, *MONTH, fmt=fmt)
    table = spark.read.format(fmt).load(out_dir)
    if sample_dir and sample_rows:
        firsts = _first_of_months(_of_months(table, _months(spark, zip_glob)), sample_rows)
        writers.write_monthly(firsts, sample_dir, *MONTH, fmt=fmt)
    return table


def ingest_features(df: DataFrame, table_path: str, entity_id: str, feature_time: str,
                    features: list[str], load_id: int, fmt: str = "parquet") -> None:
    """Append one load (id, time, features) to a feature table, partitioned
    by feature date and load."""
    writers.append_load(df.select(entity_id, feature_time, *features), table_path, load_id, fmt, feature_time)


def read_feature_table(spark: SparkSession, table_path: str, entity_id: str, feature_time: str,
                       features: list[str], fmt: str = "parquet", since=None, until=None) -> DataFrame:
    """Current view of a feature table: one row per (id, time), latest load
    wins. ``since`` and ``until`` (dates, inclusive) prune the partitions that
    are read."""
    rows = spark.read.format(fmt).load(table_path)
    if since is not None:
        rows = rows.filter(F.col(writers.FEATURE_DATE) >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.filter(F.col(writers.FEATURE_DATE) <= F.lit(until).cast("date"))
    return pit.upsert(rows, entity_id, feature_time, features)


def compact_feature_table(spark: SparkSession, table_path: str, entity_id: str, feature_time: str,
                          features: list[str], since, until, fmt: str = "parquet") -> None:
    """Replace the loads of the days ``since``..``until`` by one: the rows
    that win, under the highest load id of each day. The compacted days are
    staged first; then they are written, and only afterwards are the folders of
    their older loads deleted."""
    rows = spark.read.format(fmt).load(table_path).filter(
        F.col(writers.FEATURE_DATE).between(F.lit(since).cast("date"), F.lit(until).cast("date")))
    last = rows.groupBy(writers.FEATURE_DATE).agg(F.max(pit.LOAD_ID).alias(pit.LOAD_ID))
    won = pit.upsert(rows, entity_id, feature_time, features) \
        .withColumn(writers.FEATURE_DATE, F.to_date(feature_time)).join(last, writers.FEATURE_DATE)
    won = stage(won, "compacted")
    old = [tuple(r) for r in rows.select(writers.FEATURE_DATE, pit.LOAD_ID).distinct()
           .join(last.withColumnRenamed(pit.LOAD_ID, "_last"), writers.FEATURE_DATE)
           .filter(F.col(pit.LOAD_ID) < F.col("_last")).select(writers.FEATURE_DATE, pit.LOAD_ID).collect()]
    writers.write_partitions(won, table_path, [writers.FEATURE_DATE, pit.LOAD_ID], fmt)
    drop_paths(spark, [f"{table_path}/{writers.FEATURE_DATE}={d}/{pit.LOAD_ID}={i}" for d, i in old])


def latest_feature_values(spark: SparkSession, table_path: str, entity_id: str,
                          feature_time: str, features: list[str], fmt: str = "parquet",
                          since=None, until=None) -> DataFrame:
    """Online view of a feature table: per entity the values at its latest
    feature time, after latest-load-wins."""
    current = read_feature_table(spark, table_path, entity_id, feature_time, features, fmt, since, until)
    return pit.latest_values(current, entity_id, feature_time, features)


ONLINE_BUCKETS = 64     # hash buckets of a new online view


def merge_online(load: DataFrame, view_path: str, entity_id: str, feature_time: str, features: list[str],
                 load_id: int, buckets: int = ONLINE_BUCKETS) -> None:
    """Keep the online view (latest values per entity) up with one load: the
    load's newest row per entity is merged into the hash buckets of its entities,
    and only their files are read and replaced. Of two rows the later feature time
    wins, at equal times the higher load, then the values: a maximum, so loads may
    come late, in any order, or twice. A null id or time is no entity's value.

    Buckets are partitions ``bucket_of_{n}``: the number is part of the
    table, and a view of another number is refused."""
    spark, bucket = load.sparkSession, f"bucket_of_{buckets}"
    row = F.max(F.struct(F.col(feature_time).alias("_t"), F.col(pit.LOAD_ID).alias("_l"), *features)).alias("_best")
    new = load.select(entity_id, feature_time, F.lit(int(load_id)).alias(pit.LOAD_ID), *features) \
        .filter(F.col(entity_id).isNotNull() & F.col(feature_time).isNotNull()) \
        .groupBy(entity_id).agg(row).select(entity_id, F.col("_best._t").alias(feature_time), F.col("_best._l").alias(pit.LOAD_ID),
                                            *[F.col(f"_best.{c}").alias(c) for c in features])
    new = stage(new.withColumn(bucket, F.pmod(F.xxhash64(entity_id), F.lit(buckets)).cast("int")), "online_load")
    both = new
    if exists(spark, view_path):
        old = spark.read.parquet(view_path)
        if bucket not in old.columns:
            raise ValueError(f"{view_path} has another number of buckets than {buckets}")
        touched = [r[0] for r in new.select(bucket).distinct().collect()]      # ``buckets`` numbers at most
        both = old.filter(F.col(bucket).isin(touched)).select(*new.columns).unionByName(new)
    merged = both.groupBy(bucket, entity_id).agg(row).select(
        entity_id, F.col("_best._t").alias(feature_time), F.col("_best._l").alias(pit.LOAD_ID),
        *[F.col(f"_best.{c}").alias(c) for c in features], bucket)
    # staged first: the files that are read are those that are replaced
    writers.write_partitions(stage(merged, "online"), view_path, [bucket])


def read_online(spark: SparkSession, view_path: str, entity_id: str, feature_time: str, features: list[str]) -> DataFrame:
    """The online view: per entity its latest feature time and values."""
    return spark.read.parquet(view_path).select(entity_id, feature_time, *features)


def ingest_flight_features(flights: DataFrame, table_path: str, load_id: int) -> None:
    ingest_features(flights, table_path, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES, load_id)


def ingest_airport_features(airports: DataFrame, table_path: str, load_id: int) -> None:
    ingest_features(airports, table_path, "origin_airport_id", "timestamp",
                    AIRPORT_ENTITY_FEATURES, load_id)


def training_rows(instances: DataFrame, flight_features: DataFrame, airport_features: DataFrame,
                  flight_age: str | None = None, airport_age: str | None = None) -> DataFrame:
    """Read instances (``flight``, ``airport``, ``timestamp`` as ISO text) →
    one training row for each, with the flight's features and the airport's mean
    as they were known at that time. Both tables are keyed by their entity id and
    ``timestamp``, the time from which a value is known. A value older than its
    age limit is null."""
    at = F.to_timestamp_ntz(F.rtrim("timestamp", F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    keys = instances.select("flight", "airport", at.alias("timestamp"))
    # the airport of a flight's features is not the instance's own column
    flight = {c: c for c in FLIGHT_ENTITY_FEATURES}
    return pit.retrieve(keys, "timestamp", [
        pit.FeatureView(flight_features, ["flight"], ["flight_number"], "timestamp", flight, "flight_time", flight_age),
        pit.FeatureView(airport_features, ["airport"], ["origin_airport_id"], "timestamp",
                        {c: c for c in AIRPORT_ENTITY_FEATURES}, "airport_time", airport_age)])


def monthly_refresh(spark: SparkSession, zip_glob, raw_dir: str, metrics_dir: str,
                    split_date: str, model_path: str | None = None,
                    eval_rows: int | None = None, threshold_digits: int | None = None,
                    fit: dict | None = None) -> TrainingResult:
    """Load this delivery's archives (replacing only their months), retrain on
    the whole table, and store the evaluation of each loaded month, on all of
    that month's test rows, in the metrics history (a re-run replaces it).
    ``eval_rows`` asks for the first so many test rows of each month instead.
    A month without test rows gets no metrics. ``threshold_digits`` rounds the
    scores of the ROC points, which bounds their number; ``fit`` has further
    arguments of ``fit_model``. ``zip_glob`` may be a list of archives."""
    raw = ingest_monthly(spark, zip_glob, raw_dir)
    split = training.split_by_date(raw, split_date, keep=(*MONTH, "line_no"))
    fitted = model.fit_model(split.train, **(fit or {}))
    if model_path:
        model.save_model(fitted, model_path)
    test = _of_months(split.test, _months(spark, zip_glob))
    if eval_rows is not None:
        test = _first_of_months(test, eval_rows)
    scored = stage(model.score(fitted, test), "scored")
    confusion = evaluation.confusion_matrix(scored, "target", "prediction", by=MONTH)
    score = F.col("probability") if threshold_digits is None else F.round("probability", threshold_digits) + F.lit(0.0)
    roc = evaluation.roc_curve(scored.withColumn("probability", score), "target", "probability", by=MONTH)
    writers.write_monthly(confusion, f"{metrics_dir}/confusion", *MONTH)
    writers.write_monthly(roc, f"{metrics_dir}/roc", *MONTH)
    return TrainingResult(fitted, scored, roc, confusion)


def refresh_model(spark: SparkSession, raw: DataFrame, state_dir: str, split_date: str, months: list[tuple[int, int]],
                  C: float = model.INVERSE_REGULARISATION) -> incremental.LinearModel:
    """Keep the model up with the loaded ``months`` of a monthly table: only
    their rows are read for the moments, which replace those of the same months
    in ``state_dir/moments``; the fit on all training rows starts from the last
    coefficients (``state_dir/coefficients``, one row for each refresh)."""
    configure(spark)
    train = training.split_by_date(raw, split_date, keep=tuple(MONTH)).train
    writers.write_monthly(incremental.moments(_of_months(train, months), MONTH), f"{state_dir}/moments", *MONTH)
    means, deviations, _ = incremental.scales(spark.read.parquet(f"{state_dir}/moments"))
    path, last = f"{state_dir}/coefficients", None
    if exists(spark, path):
        last = incremental.LinearModel(**spark.read.parquet(path).orderBy(F.desc("refresh")).drop("refresh").first().asDict())
    fitted = incremental.fit_newton(train, means, deviations, start=last, C=C)
    done = spark.read.parquet(path).agg(F.max("refresh")).first()[0] if last else 0
    row = spark.createDataFrame([(done + 1, *fitted)], "refresh long, features array<string>, means array<double>, "
                                "deviations array<double>, constant double, weights array<double>, steps int")
    row.write.mode("append").parquet(path)
    return fitted


def daily_confusion(scored: DataFrame, date_col: str, actual: str = "target",
                    predicted: str = "prediction") -> DataFrame:
    """Confusion matrix per day of replayed requests: four rows per day
    ``(date, actual, predicted, n)``."""
    return evaluation.confusion_matrix(scored.withColumn("date", F.col(date_col)), actual, predicted, by=["date"])


def daily_model_evaluation(fitted: PipelineModel, requests: DataFrame, date_col: str,
                           actual: str = "target") -> DataFrame:
    """Replayed requests scored by the model, then the confusion matrix per
    day (four rows per day). Works on a batch or a streaming DataFrame of
    requests (streaming needs an output mode that allows aggregation)."""
    scored = model.score(fitted, requests, keep=(date_col, actual))
    return daily_confusion(scored, date_col, actual, "prediction")


def evaluate_requests(fitted: PipelineModel, requests: DataFrame, date_col: str, path: str, checkpoint: str,
                      actual: str = "target") -> None:
    """``daily_model_evaluation`` of a stream of requests: four counters a day
    are the state, and each micro-batch hands on the days it changed (update mode).
    The sink replaces those days' partitions of ``path`` by the new totals, so a
    micro-batch that runs again changes nothing."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        writers.write_partitions(batch, path, ["date"])

    daily_model_evaluation(fitted, requests, date_col, actual).writeStream.outputMode("update").foreachBatch(merge) \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
