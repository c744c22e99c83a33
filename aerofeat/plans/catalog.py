"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed from the driver's tables (``raw_flights`` is derived from
``events``), over the whole tables.

Floating results that are sums in an engine-dependent order are rounded to
``ROUND_DIGITS`` here and in the SQL twins (``plans/oracle.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation, model, pit, training
from ..operators.airport import airport_windows, sliding_mean
from ..operators.instances import read_instances
from ..operators.parse import parse_flights
from ..functions import flight as ff
from ..schemas import FLIGHT_ENTITY_FEATURES, READ_INSTANCE_SCHEMA, TRAIN_FEATURES, TRAIN_SCHEMA
from ..session import configure, scratch_path, stage
from ..sources import csv as csvsrc
from ..sources.events_flights import RAW_FLIGHT_COLUMNS, raw_flights, raw_flights_from_events, read_events

# --- fixed values -----------------------------------------------------------
SPLIT_DATE = "2024-01-20"          # train < split <= test (the events span January 2024)
FIRST_N = 5000                     # rows of the subsample file
ROUND_DIGITS = 6
LOAD1_BEFORE = "2024-01-20"        # first feature load: flights before this day
LOAD2_FROM = "2024-01-15"          # second (correcting) load: flights from this day
DELIVERY2_FROM = "2024-01-25"      # rows of the second delivery
PROBABILITY_DIGITS = 4
CLOSING = ("2024-03-01", "2024-04-01")   # times of the rows that close all windows of a finished input
LATE_BEFORE = "2024-01-08"         # every 50th flight before this day reaches the stream too late
TABLE_BUCKETS = 8                  # buckets of the bucketed feature table
HEAD_ROWS = 400                    # rows read from the start of a set of files
SAMPLE_ROWS = 100                  # rows of each archive in the monthly sample
DELIVERIES = [(1, 3), (4, 5)]      # first and last archive of the two deliveries
FLIGHT_AGE, AIRPORT_AGE = "2 hours", "30 minutes"   # older feature values are stale
# ---------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return raw_flights(spark, sf)


def _flights(spark, sf) -> DataFrame:
    return parse_flights(_raw(spark, sf), keep=("event_id",)).flights


def _split(spark, sf):
    return training.split_by_date(_raw(spark, sf), SPLIT_DATE, keep=("event_id",))


def _r(c: str, name: str | None = None):
    """Rounded, with -0.0 folded into 0.0 (``+ 0.0``) so both engines agree
    on the sign of a rounded tiny value."""
    return (F.round(F.col(c), ROUND_DIGITS) + F.lit(0.0)).alias(name or c)


# Lines → positional CSV decode
def q_csv_decode(spark, sf):
    lines = csvsrc.encode_lines(_raw(spark, sf), keep=("event_id",))
    dec = csvsrc.decode_lines(lines, keep=("event_id",))
    return dec.select(*RAW_FLIGHT_COLUMNS)


# guards
def q_flight_guard(spark, sf):
    raw = _raw(spark, sf)
    ok = (~ff.is_header()) & ff.wheels_off_ok() & ff.flight_date_ok() & ff.distance_present()
    return raw.filter(ok).select("event_id", "Year", "FlightDate", "WheelsOff", "Distance")


# Typed flight records
def q_flight_records(spark, sf):
    return _flights(spark, sf)


# Q1: rejects by reason
def q_flight_rejects(spark, sf):
    rej = parse_flights(_raw(spark, sf), keep=("event_id",)).rejects
    return rej.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# Airport sliding mean
def q_airport_sliding_mean(spark, sf):
    return airport_windows(_flights(spark, sf))


# W1 on the events table itself
def q_event_sliding_mean(spark, sf):
    ev = read_events(spark, sf)
    w = sliding_mean(ev, "ts", ["event_type"], "value", "avg_value")
    return w.select("window_start", "window_end", "event_type", _r("avg_value"))


# P17
def q_read_instances(spark, sf):
    return read_instances(_flights(spark, sf))


# P18
def q_completed_flights(spark, sf):
    return training.completed_flights(_raw(spark, sf), keep=("event_id",))


# P19-P22
def q_training_set(spark, sf):
    return _split(spark, sf).train


def q_test_set(spark, sf):
    return _split(spark, sf).test


# First N rows in a defined order (the subsample)
def q_first_n_rows(spark, sf):
    return csvsrc.first_n(_raw(spark, sf), FIRST_N, order=[F.col("event_id")])


# A2: mean imputation (means of the training set)
def q_impute_mean(spark, sf):
    from pyspark.ml.feature import Imputer
    train = _split(spark, sf).train
    imp = Imputer(strategy="mean", inputCols=TRAIN_FEATURES,
                  outputCols=[f"{c}_imputed" for c in TRAIN_FEATURES]).fit(train)
    out = imp.transform(train)
    return out.select("event_id", *[_r(f"{c}_imputed", c) for c in TRAIN_FEATURES], "target")


# A3: standardisation with population std after imputation
def q_standardise(spark, sf):
    train = _split(spark, sf).train
    fitted = model.fit_scaling(train, TRAIN_FEATURES)
    out = model.apply_scaling(train, fitted)
    return out.select("event_id", *[_r(c) for c in TRAIN_FEATURES], "target")


# A4, M6: confusion matrix of the rule "departure delay > 15 min"
def q_confusion_matrix(spark, sf):
    train = _split(spark, sf).train
    pred = train.select("target", F.coalesce(F.col("DepDelay") > 15, F.lit(False)).alias("prediction"))
    return evaluation.confusion_matrix(pred, "target", "prediction")


# ROC points, score = departure delay (of the rows that have one)
def q_roc_curve(spark, sf):
    train = _split(spark, sf).train.filter("DepDelay is not null and not isnan(DepDelay)")
    return evaluation.roc_curve(train, label="target", score="DepDelay")


def _flight_loads(spark, sf) -> DataFrame:
    fl = stage(_flights(spark, sf), "flights")
    day = F.to_date("timestamp")
    load1 = fl.filter(day < F.lit(LOAD1_BEFORE).cast("date")).withColumn("load_id", F.lit(1))
    load2 = fl.filter(day >= F.lit(LOAD2_FROM).cast("date")) \
        .withColumn("departure_delay_minutes", F.col("departure_delay_minutes") + 1) \
        .withColumn("load_id", F.lit(2))
    return load1.unionByName(load2)


# K7: flight entity ingest of two loads (the later load wins)
def q_feature_ingest_flight(spark, sf):
    rows = _flight_loads(spark, sf)
    return pit.upsert(rows, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)


# K8: airport entity ingest of two loads
def q_feature_ingest_airport(spark, sf):
    fl = stage(_flights(spark, sf), "flights")
    day = F.to_date("timestamp")
    a1 = airport_windows(fl.filter(day < F.lit(LOAD1_BEFORE).cast("date"))) \
        .withColumn("load_id", F.lit(1))
    a2 = airport_windows(fl.filter((day >= F.lit(LOAD2_FROM).cast("date")) & ~F.col("is_cancelled"))) \
        .withColumn("load_id", F.lit(2))
    rows = a1.unionByName(a2).withColumnRenamed("window_start", "timestamp")
    up = pit.upsert(rows, "origin_airport_id", "timestamp", ["average_departure_delay"])
    return up.select("origin_airport_id", "timestamp", _r("average_departure_delay"))


# K8 + E2: latest airport feature per airport after two loads (upsert, then
# the latest value per entity)
def q_latest_after_loads(spark, sf):
    fl = stage(_flights(spark, sf), "flights")
    day = F.to_date("timestamp")
    a1 = airport_windows(fl.filter(day < F.lit(LOAD1_BEFORE).cast("date"))) \
        .withColumn("load_id", F.lit(1))
    a2 = airport_windows(fl.filter((day >= F.lit(LOAD2_FROM).cast("date")) & ~F.col("is_cancelled"))) \
        .withColumn("load_id", F.lit(2))
    rows = a1.unionByName(a2).withColumnRenamed("window_start", "timestamp")
    current = pit.upsert(rows, "origin_airport_id", "timestamp", ["average_departure_delay"])
    latest = pit.latest_values(current, "origin_airport_id", "timestamp", ["average_departure_delay"])
    return latest.select("origin_airport_id", "timestamp", _r("average_departure_delay"))


# The online view of the flights kept up by three loads, the second of which comes last
def q_latest_online_view(spark, sf):
    from .jobs import merge_online, read_online
    path = scratch_path(spark, "online")
    loads = _flight_loads(spark, sf)
    third = loads.filter((F.col("load_id") == 2) & (F.to_date("timestamp") >= F.lit(DELIVERY2_FROM).cast("date"))
                         & (F.col("event_id") % 3 == 0)).withColumn("taxi_out_minutes", F.lit(0.0))
    for i, rows in ((1, loads.filter("load_id = 1")), (3, third), (2, loads.filter("load_id = 2"))):
        merge_online(rows, path, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES, i, buckets=16)
    return read_online(spark, path, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)


# Latest airport feature per airport
def q_latest_features(spark, sf):
    feats = airport_windows(_flights(spark, sf))
    return pit.latest_values(feats, "origin_airport_id", "window_start", ["average_departure_delay"])


# Point-in-time airport feature for each flight (window end <= flight time)
def q_asof_features(spark, sf):
    # the flight table is read by both sides (as the batch job does, from
    # its written flight table)
    flights = stage(_flights(spark, sf), "flights")
    fl = flights.select("event_id", "flight_number", "origin_airport_id", "timestamp")
    feats = airport_windows(flights)
    j = pit.asof_join(fl, feats, ["origin_airport_id"], ["origin_airport_id"],
                      "timestamp", "window_end", ["average_departure_delay"], out_time="feature_time")
    return j


# Training rows for the read instances, from both feature tables (two
# loads of the flights); airport means are known from their window's end
def q_training_rows(spark, sf):
    from .jobs import ingest_airport_features, read_feature_table, training_rows
    flights = stage(_flights(spark, sf), "flights")
    path = scratch_path(spark, "airport_table")
    ingest_airport_features(airport_windows(flights).withColumnRenamed("window_end", "timestamp"), path, 1)
    flight_table = read_feature_table(spark, _flight_table(spark, sf), "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)
    airport_table = read_feature_table(spark, path, "origin_airport_id", "timestamp", ["average_departure_delay"])
    # some requests come a while after the flight, when values may be stale
    late = F.make_dt_interval(mins=F.col("event_id") % 5 * 45)
    asked = read_instances(flights.withColumn("timestamp", F.col("timestamp") + late))
    return training_rows(asked, flight_table, airport_table, FLIGHT_AGE, AIRPORT_AGE)


# E1 on skewed keys: a third of the flights share one airport, every 11th
# has none, and so has every 13th feature row
def q_asof_skewed(spark, sf):
    flights = stage(_flights(spark, sf), "flights")
    hot = F.when(F.col("event_id") % 11 == 0, F.lit(None).cast("string")) \
        .when(F.col("event_id") % 3 == 0, F.lit("10000")).otherwise(F.col("origin_airport_id"))
    fl = flights.select("event_id", hot.alias("airport"), "timestamp")
    feats = airport_windows(flights).select(
        F.when(F.hour("window_start") % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("origin_airport_id")).alias("airport"), "window_end", "average_departure_delay")
    return pit.asof_join(fl, feats, ["airport"], ["airport"], "timestamp", "window_end",
                         ["average_departure_delay"], out_time="feature_time")


def _tight_model(train):
    """Fitted to the optimum, so that another solver's probabilities agree to
    ``PROBABILITY_DIGITS``."""
    return model.fit_model(train, max_iter=500, tol=1e-12)


def _probability():
    return (F.round("probability", PROBABILITY_DIGITS) + F.lit(0.0)).alias("probability")


def _model_scored(spark, sf):
    sp = _split(spark, sf)
    return model.score(_tight_model(sp.train), sp.test, keep=("event_id", "target"))


# M1-M4, M7: fit on the training set, score the test set
def q_model_fit_predict(spark, sf):
    return _model_scored(spark, sf).select("event_id", "target", _probability(), "prediction")


# The model kept up by two deliveries, from merged moments
# and the last coefficients; scores of the test set
def q_model_refreshed_scores(spark, sf):
    from ..operators import incremental
    from ..sinks.writers import write_monthly
    from .jobs import refresh_model
    path = scratch_path(spark, "refreshed")
    configure(spark)
    week = F.expr("1 + (day(ts) - 1) div 7").cast("int")
    raw = raw_flights_from_events(read_events(spark, sf), keep=("ts",)).withColumns({"file_year": F.lit(2024), "file_month": week}).drop("ts")
    for first, last in DELIVERIES:
        write_monthly(raw.filter(F.col("file_month").between(first, last)), path + "/raw", "file_year", "file_month")
        stored = spark.read.parquet(path + "/raw")
        fitted = refresh_model(spark, stored, path + "/state", SPLIT_DATE, [(2024, m) for m in range(first, last + 1)])
    test = training.split_by_date(stored, SPLIT_DATE, keep=("event_id",)).test
    return incremental.score_linear(fitted, test, ["event_id", "target"]).select("event_id", "target", _probability(), "prediction")


# The same scores from a model that was saved and loaded
def q_model_saved_scores(spark, sf):
    sp = _split(spark, sf)
    path = scratch_path(spark, "model")
    model.save_model(_tight_model(sp.train), path)
    out = model.score(model.load_model(path), sp.test, keep=("event_id", "target"))
    return out.select("event_id", "target", _probability(), "prediction")


# M5 on the model's probabilities (the reference's evaluation, whole test set)
def q_model_roc(spark, sf):
    return evaluation.roc_curve(_model_scored(spark, sf).select("target", _probability()), "target", "probability")


# M6 on the model's predictions
def q_model_confusion(spark, sf):
    return evaluation.confusion_matrix(_model_scored(spark, sf), "target", "prediction")


# The confusion artefact of the training job, over the whole test set
def q_training_job_confusion(spark, sf):
    from .jobs import run_training
    path = scratch_path(spark, "metrics")
    run_training(spark, _raw(spark, sf), SPLIT_DATE, metrics_path=path)
    return spark.read.parquet(path + "/confusion")


# K9: the ROC artefact, its end points and the area under it
def q_training_job_roc(spark, sf):
    from .jobs import run_training
    path = scratch_path(spark, "metrics")
    run_training(spark, _raw(spark, sf), SPLIT_DATE, metrics_path=path)
    roc = spark.read.parquet(path + "/roc")
    return evaluation.roc_area(roc).select("fpr_end", "tpr_end", F.round("area", 4).alias("area"))


# Train and test sets written as CSV by the training job, read again
def q_train_test_csv(spark, sf):
    from .jobs import run_training
    path = scratch_path(spark, "datasets")
    run_training(spark, _raw(spark, sf), SPLIT_DATE, datasets_path=path)
    parts = [spark.read.option("header", True).schema(TRAIN_SCHEMA).csv(f"{path}/{name}")
             .select(F.lit(name).alias("part"), "*") for name in ("train", "test")]
    return parts[0].unionByName(parts[1])


# Header CSV files in two column orders (one with an index column), read
# by name through a glob, then the training set
def q_named_csv_training(spark, sf):
    path = scratch_path(spark, "named")
    raw = _raw(spark, sf)
    cols = ["FlightDate", "Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay"]
    out = [(raw.filter("event_id % 2 = 0").select("event_id", *cols), "even"),
           (raw.filter("event_id % 2 = 1").select(F.lit(0).alias("index"), *cols[::-1], "OriginCityName", "event_id"), "odd")]
    for df, name in out:
        df.write.option("header", True).option("escape", '"').csv(f"{path}/{name}")
    src = csvsrc.read_named_csv(spark, f"{path}/*/*.csv", columns=["event_id", *cols])
    train = training.split_by_date(src, SPLIT_DATE, keep=("event_id",)).train
    return train.withColumn("event_id", F.col("event_id").cast("long"))


def _batch_job(spark, sf) -> str:
    from .jobs import run_batch_features
    path = scratch_path(spark, "batch")
    run_batch_features(spark, _raw(spark, sf), path + "/airports", path + "/flights", path + "/instances")
    return path


# The batch job's flight features
def q_batch_job_flights(spark, sf):
    return spark.read.parquet(_batch_job(spark, sf) + "/flights")


# Its airport features
def q_batch_job_airports(spark, sf):
    return spark.read.parquet(_batch_job(spark, sf) + "/airports")


# Its read instances
def q_batch_job_instances(spark, sf):
    return spark.read.option("header", True).option("escape", '"').schema(READ_INSTANCE_SCHEMA) \
        .csv(_batch_job(spark, sf) + "/instances")


# Two loads in a bucketed, time-sorted catalogue table; its latest values
def q_bucketed_table_latest(spark, sf):
    from ..sinks.writers import write_entity_table
    path = scratch_path(spark, "bucketed")
    name = "flight_features_" + path.split("/")[-2]
    table = write_entity_table(_flight_loads(spark, sf).drop("event_id"), name, path, "flight_number", "timestamp", TABLE_BUCKETS)
    current = pit.upsert(table, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)
    return pit.latest_values(current, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)


def _flight_table(spark, sf) -> str:
    from .jobs import ingest_flight_features
    path = scratch_path(spark, "flight_table")
    loads = _flight_loads(spark, sf)
    for i in (1, 2):
        ingest_flight_features(loads.filter(F.col("load_id") == i), path, i)
    return path


# Two loads ingested into a feature table, its current view
def q_feature_table_flight(spark, sf):
    from .jobs import read_feature_table
    return read_feature_table(spark, _flight_table(spark, sf), "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)


# The same view after the days of the second load are compacted
def q_feature_table_compacted(spark, sf):
    from .jobs import compact_feature_table, read_feature_table
    path = _flight_table(spark, sf)
    compact_feature_table(spark, path, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES, LOAD2_FROM, "2999-12-31")
    return read_feature_table(spark, path, "flight_number", "timestamp", FLIGHT_ENTITY_FEATURES)


# Two deliveries stored in the monthly layout (here: half months),
# each evaluated on its own test rows
def q_delivery_evaluation(spark, sf):
    from ..sinks.writers import write_monthly
    path = scratch_path(spark, "deliveries")
    raw = _raw(spark, sf).filter(~ff.is_header())
    late = F.coalesce(F.col("FlightDate") >= DELIVERY2_FROM, F.lit(False))
    for first, part in ((1, ~late), (2, late)):
        write_monthly(raw.filter(part).select("*", F.lit(2024).alias("file_year"), F.lit(first).alias("file_month")),
                      path, "file_year", "file_month")
    test = training.split_by_date(spark.read.parquet(path), SPLIT_DATE, keep=("file_year", "file_month")).test
    rule = test.withColumn("prediction", F.coalesce(F.col("DepDelay") > 15, F.lit(False)))
    return evaluation.confusion_matrix(rule, by=["file_year", "file_month"])


def _week_archives(spark, sf, path: str, first: int = 1, last: int = 5) -> str:
    """The raw flights of the weeks ``first``..``last`` of the month as monthly
    zip archives (a week stands for a month)."""
    from ..sources.zip_format import write_archives
    configure(spark)
    week = F.expr("1 + (day(ts) - 1) div 7").cast("int")
    raw = raw_flights_from_events(read_events(spark, sf), keep=("ts",)) \
        .withColumns({"file_year": F.lit(2024), "file_month": week}).filter(F.col("file_month").between(first, last))
    write_archives(csvsrc.encode_lines(raw, keep=("event_id", "file_year", "file_month")), path, ["event_id"])
    return path


# Raw flights written as archives and loaded again
def q_zip_round_trip(spark, sf):
    from .jobs import ingest_monthly
    path = scratch_path(spark, "zips")
    _week_archives(spark, sf, path)
    raw = ingest_monthly(spark, path + "/*.zip", path + "/raw")
    return raw.select("file_year", "file_month", *RAW_FLIGHT_COLUMNS[1:])


# The first data rows of each loaded archive
def q_monthly_sample(spark, sf):
    from .jobs import ingest_monthly
    path = scratch_path(spark, "zips")
    _week_archives(spark, sf, path)
    ingest_monthly(spark, path + "/*.zip", path + "/raw", sample_dir=path + "/sample", sample_rows=SAMPLE_ROWS)
    return spark.read.parquet(path + "/sample").select("file_year", "file_month", *RAW_FLIGHT_COLUMNS[1:])


def _refreshed(spark, sf) -> str:
    """Two deliveries of archives, each taken by a run of the incremental load."""
    from ..streaming.deliveries import refresh_deliveries
    path = scratch_path(spark, "deliveries")
    for first, last in DELIVERIES:
        _week_archives(spark, sf, path + "/zips", first, last)
        refresh_deliveries(spark, path + "/zips", path + "/raw", path + "/metrics", SPLIT_DATE, path + "/_checkpoint",
                           threshold_digits=PROBABILITY_DIGITS, fit={"max_iter": 500, "tol": 1e-12})
    return path + "/metrics"


# The month's evaluation after each delivery, by the model of that time
def q_monthly_confusion(spark, sf):
    return spark.read.parquet(_refreshed(spark, sf) + "/confusion").select("file_year", "file_month", "actual", "predicted", "n")


# Every ROC point of every loaded month
def q_monthly_roc(spark, sf):
    return spark.read.parquet(_refreshed(spark, sf) + "/roc").select("file_year", "file_month", "threshold", "fpr", "tpr")


# E5: confusion matrix per flight day of the test period (rule DepDelay > 15)
def q_daily_confusion(spark, sf):
    from .jobs import daily_confusion
    lab = training.labelled(_raw(spark, sf))
    test = lab.filter(F.col("FlightDate") >= F.lit(SPLIT_DATE)).select(
        "FlightDate", "target", F.coalesce(F.col("DepDelay") > 15, F.lit(False)).alias("prediction"))
    return daily_confusion(test, "FlightDate").withColumnRenamed("date", "flight_date")


def _final_windows(spark, sf, closing: tuple[str, ...] = CLOSING) -> str:
    """The flights as three parts of a stream: by time in two, then every 50th flight of the
    first week, too late; and closing rows, which no airport has."""
    from ..streaming import final_windows as fw
    path = scratch_path(spark, "final_windows")
    late = (F.col("event_id") % 50 == 0) & (F.to_date("et") < F.lit(LATE_BEFORE).cast("date"))
    flights = _flights(spark, sf).select(F.col("timestamp").cast("timestamp").alias("et"), "event_id", "origin_airport_id", "departure_delay_minutes")
    flights = stage(flights.withColumn("file", F.when(late, 2).when(F.to_date("et") < F.lit(SPLIT_DATE).cast("date"), 0).otherwise(1)), "flights")
    ends = spark.createDataFrame([(c,) for c in closing], "c string").select(
        F.col("c").cast("timestamp").alias("et"), F.lit(-1).cast("long").alias("event_id"), F.lit("").alias("origin_airport_id"),
        F.lit(None).cast("double").alias("departure_delay_minutes"))
    schema = ends.schema
    # each part is taken by a run of its own, as it would be when it arrives
    parts = [flights.filter(F.col("file") == i).drop("file") for i in range(3)] + [ends]
    for part in parts:
        part.write.mode("append").parquet(path + "/in")
        fw.gate(spark.readStream.schema(schema).parquet(path + "/in"), "et", path, path + "/_gate")
    fw.final_means(fw.on_time(spark, path, schema), "et", path + "/means", path + "/_means")
    return path


# Windows of a stream that are final, each emitted once
def q_stream_final_windows(spark, sf):
    means = spark.read.parquet(_final_windows(spark, sf) + "/means").filter("origin_airport_id <> ''")
    return means.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                        F.col("window_end").cast("timestamp_ntz").alias("window_end"), "origin_airport_id", _r("average_departure_delay"))


# What came too late for its windows, by airport
def q_stream_late_rows(spark, sf):
    late = spark.read.parquet(_final_windows(spark, sf) + "/late")
    return late.groupBy("origin_airport_id").agg(F.count("*").alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event"))


# Requests of a stream with the newest final mean of their airport
def q_stream_enriched_requests(spark, sf):
    from ..streaming import final_windows as fw
    path = _final_windows(spark, sf)
    flights = _flights(spark, sf).select("event_id", F.col("origin_airport_id").alias("airport"), F.col("timestamp").cast("timestamp").alias("time"))
    end = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("").alias("airport"),
                                F.lit(CLOSING[0]).cast("timestamp").alias("time"))
    for part in (flights, end):
        part.write.mode("append").parquet(path + "/requests")
    fw.enrich(spark.readStream.schema(flights.schema).parquet(path + "/requests"),
              spark.readStream.schema(fw.MEAN_SCHEMA).option("recursiveFileLookup", True).parquet(path + "/means"),
              path + "/enriched", path + "/_enriched")
    return spark.read.parquet(path + "/enriched").filter("event_id >= 0").select(
        "event_id", "airport", F.col("time").cast("timestamp_ntz").alias("time"),
        F.col("feature_time").cast("timestamp_ntz").alias("feature_time"), _r("average_departure_delay"))


# E5, M7: the model's confusion matrix per day of a replayed stream of requests
def q_daily_model_confusion(spark, sf):
    from .jobs import evaluate_requests
    path = scratch_path(spark, "requests")
    fitted = _tight_model(_split(spark, sf).train)
    rows = training.labelled(_raw(spark, sf)).filter(F.col("FlightDate") >= F.lit(SPLIT_DATE))
    # three files, taken as three micro-batches
    for i in range(3):
        rows.filter(F.pmod(F.hash(*rows.columns), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(path + "/in")
    stream = spark.readStream.schema(spark.read.parquet(path + "/in").schema).option("maxFilesPerTrigger", 1).parquet(path + "/in")
    evaluate_requests(fitted, stream, "FlightDate", path + "/days", path + "/_checkpoint")
    return spark.read.parquet(path + "/days").select(F.col("date").cast("string").alias("flight_date"), "actual", "predicted", "n")


# The first rows of header CSV files in file order, from the files that hold them
def q_named_csv_head(spark, sf):
    path = scratch_path(spark, "head")
    cols = ["FlightDate", "Cancelled", "Diverted", "DepDelay", "TaxiOut", "Distance", "ArrDelay"]
    raw = _raw(spark, sf).select("event_id", *cols)
    raw.repartitionByRange(8, "event_id").sortWithinPartitions("event_id").write.option("header", True).option("escape", '"').csv(path)
    return csvsrc.read_named_head(spark, path + "/*.csv", HEAD_ROWS, ["event_id", *cols]) \
        .withColumn("event_id", F.col("event_id").cast("long"))


# S1-S3 on files: raw rows rendered as CSV text files, read back by the
# positional CSV reader (pruned CSV scan)
def q_csv_file_decode(spark, sf):
    path = scratch_path(spark, "raw_csv")
    csvsrc.encode_lines(_raw(spark, sf), keep=()).write.text(path)
    # no row key in the text: compared as a multiset of rows
    return csvsrc.read_raw_csv(spark, path).select(*RAW_FLIGHT_COLUMNS[1:])


# K3: read instances written as CSV with a header and read back
def q_read_instances_csv(spark, sf):
    from ..sinks.writers import write_read_instances
    path = scratch_path(spark, "read_instances")
    write_read_instances(read_instances(_flights(spark, sf)), path)
    return spark.read.option("header", True).option("escape", '"') \
        .schema(READ_INSTANCE_SCHEMA).csv(path)


def queries() -> dict[str, Query]:
    from ..streaming.airport_stream import q_stream_airport_mean
    names = {k[2:]: f for k, f in globals().items() if k.startswith("q_")}
    return names | {"stream_airport_mean": q_stream_airport_mean}
