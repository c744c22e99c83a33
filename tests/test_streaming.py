from aerofeat.plans import catalog
from aerofeat.streaming.airport_stream import q_stream_airport_mean
from conftest import SF001


def test_stream_complete_mode_equals_batch(spark):
    s = q_stream_airport_mean(spark, SF001)
    b = catalog.q_airport_sliding_mean(spark, SF001)
    assert s.count() == b.count() > 0
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_stream_append_mode_emits_closed_windows_only(spark, tmpdir_path):
    from aerofeat.operators.parse import parse_flights
    from aerofeat.sources.events_flights import raw_flights_from_events
    from aerofeat.streaming.airport_stream import airport_means, airport_stream, events_stream, read_stream_table, run_to_table
    fl = parse_flights(raw_flights_from_events(events_stream(spark, SF001))).flights
    out = tmpdir_path + "/append"
    stream = airport_stream(fl, watermark="0 seconds")
    run_to_table(stream, out + "/t", out + "/c", output_mode="append")
    got = airport_means(read_stream_table(spark, out + "/t", stream.schema, "append"), final=True)
    batch = catalog.q_airport_sliding_mean(spark, SF001)
    # every emitted window is final and equal to the batch value; the windows
    # the watermark never passed (the end of a bounded input) are missing
    assert 0 < got.count() < batch.count()
    assert got.exceptAll(batch).count() == 0


def test_score_a_stream(spark, tmpdir_path):
    from aerofeat.operators import model, training
    from aerofeat.sources.events_flights import raw_flights, raw_flights_from_events
    from aerofeat.streaming.airport_stream import events_stream, run_to_table
    sp = training.split_by_date(raw_flights(spark, SF001), "2024-01-20")
    m = model.fit_model(sp.train)
    stream = training.labelled(raw_flights_from_events(events_stream(spark, SF001)))
    scored = model.score(m, stream.select("DepDelay", "TaxiOut", "Distance", "target"))
    out = tmpdir_path + "/scored"
    run_to_table(scored, out + "/t", out + "/c", output_mode="append")
    n = spark.read.parquet(out + "/t").count()
    assert n == training.labelled(raw_flights(spark, SF001)).count()


def test_replayed_batch_and_late_rows(spark, tmpdir_path):
    import datetime as dt
    from aerofeat.streaming.airport_stream import airport_stream, batch_sink, read_stream_table, run_to_table
    t0 = dt.datetime(2024, 1, 1)
    schema = "timestamp timestamp_ntz, origin_airport_id string, departure_delay_minutes double"
    src = tmpdir_path + "/src"

    def deliver(hours):
        spark.createDataFrame([(t0 + dt.timedelta(hours=h), "A", float(h)) for h in hours], schema).coalesce(1) \
            .write.mode("append").parquet(src)

    deliver([0, 1, 2])
    stream = airport_stream(spark.readStream.schema(schema).parquet(src), watermark="1 hour")
    table, check = tmpdir_path + "/t", tmpdir_path + "/c"
    assert read_stream_table(spark, table, stream.schema, "append").count() == 0     # no batch yet
    for hours in ([], [10], [0.5, 9.5, 30], [40]):      # 0.5 comes after its hour was closed: dropped
        if hours:
            deliver(hours)
        run_to_table(stream, table, check, output_mode="append")
    got = {r._b.hour + 24 * (r._b.day - 1): (r._sum, r._n) for r in read_stream_table(spark, table, stream.schema, "append").collect()}
    assert got == {0: (0.0, 1), 1: (1.0, 1), 2: (2.0, 1), 9: (9.5, 1), 10: (10.0, 1), 30: (30.0, 1)}
    # a micro-batch replayed after a failure replaces what it wrote
    rows, sink = spark.createDataFrame([("A", t0, 1.0, 1)], stream.schema), batch_sink(tmpdir_path + "/again")
    for _ in range(2):
        sink(rows, 7)
    sink(rows, 8)
    assert read_stream_table(spark, tmpdir_path + "/again", stream.schema, "append").count() == 2
