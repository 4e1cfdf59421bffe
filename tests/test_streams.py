import random

import pytest
from pyspark.sql import functions as F

from fleetstream.operators import windows
from fleetstream.plans import views
from fleetstream.streaming import delivery, metrics, persist, windows as stream_windows

SCHEMA = "seq bigint, arrival_ms bigint, t_emit bigint, engineTemperature float, tyresSurfaceTemperature float"


def arrivals(spark, seed, n=240):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        t = max(0, i * 900 - rng.randrange(18_000))
        rows.append((i, 500_000 + i * 900, t, float(rng.randrange(20, 90)), float(rng.randrange(50, 99))))
    return spark.createDataFrame(rows, SCHEMA)


def land(df, path, low, high):
    df.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(path)


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def as_set(df):
    names = ["window_start", "count", "max_engine_temp", "earliest_t_emit", "latest_t_emit"]
    return {(*(r[n] for n in names), round(r.mean_engine_temp, 6)) for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_stream_equals_batch_over_restarts(spark, tmp_path, seed):
    df = arrivals(spark, seed)
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    cuts = [0, 7, 8, 90, 200, 240]
    write = stream_windows.exact_window_writer(root)
    for low, high in zip(cuts, cuts[1:]):
        land(df, path, low, high)
        drain(stream_windows.window_stream(spark.readStream.schema(SCHEMA).parquet(path), str(tmp_path / "cp"), write))
    closed = stream_windows.closed_windows(spark, root)
    expected = windows.exact_windows(df)
    assert as_set(closed) == as_set(expected)
    assert {(r.window_start, r.closed_at_ms, r.e2e_latency_ms) for r in closed.collect()} == {
        (r.window_start, r.closed_at_ms, r.e2e_latency_ms) for r in expected.collect()
    }
    totals = stream_windows.window_counts(spark, root).agg(F.sum("accepted"), F.sum("late")).first()
    assert tuple(totals) == tuple(windows.late_counts(df).first())
    last = stream_windows.open_window(spark, root, len(cuts) - 2, 999_999).first()
    flushed = windows.exact_windows(df, flush_at_ms=999_999).orderBy(F.desc("window_start")).first()
    assert (last.window_start, last["count"], last.e2e_latency_ms) == (flushed.window_start, flushed["count"], flushed.e2e_latency_ms)


def test_exact_stream_replays_a_failed_batch(spark, tmp_path):
    df = arrivals(spark, 5)
    path, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    good = stream_windows.exact_window_writer(root)
    state = {"fail": True}

    def failing(batch, batch_id):
        good(batch, batch_id)
        if batch_id == 1 and state.pop("fail", False):
            raise RuntimeError("lost after writing")

    source = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    land(df, path, 0, 100)
    drain(stream_windows.window_stream(source(), checkpoint, failing))
    land(df, path, 100, 240)
    with pytest.raises(Exception, match="lost after writing"):
        drain(stream_windows.window_stream(source(), checkpoint, failing))
    drain(stream_windows.window_stream(source(), checkpoint, failing))
    assert as_set(stream_windows.closed_windows(spark, root)) == as_set(windows.exact_windows(df))


def test_native_stream_equals_batch_in_order(spark, tmp_path):
    df = arrivals(spark, 3).withColumn("t_emit", F.col("arrival_ms"))
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    for low, high in ((0, 100), (100, 240)):
        land(df, path, low, high)
        closed = stream_windows.native_windows(spark.readStream.schema(SCHEMA).parquet(path))
        with stream_windows.single_operator(spark):
            drain(closed.writeStream.format("parquet").option("path", root).option("checkpointLocation", str(tmp_path / "cp")))
    assert as_set(spark.read.parquet(root)) == as_set(windows.windows(df))


def test_native_stream_drops_late_batches(spark, tmp_path):
    path = str(tmp_path / "in")
    root = str(tmp_path / "out")
    times = [[1000, 12000, 2000], [3000, 13000, 25000], [14000, 41000]]
    for part in times:
        rows = [(0, 0, t, 60.0, 60.0) for t in part]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        closed = stream_windows.native_windows(spark.readStream.schema(SCHEMA).parquet(path))
        with stream_windows.single_operator(spark):
            drain(closed.writeStream.format("parquet").option("path", root).option("checkpointLocation", str(tmp_path / "cp")))
    assert spark.conf.get("spark.sql.streaming.statefulOperator.allowMultiple") == "true"
    found = sorted((r.window_start, r["count"]) for r in spark.read.parquet(root).collect())
    assert found == [(0, 2), (10000, 2), (20000, 1)]


def test_persist_stream_with_two_readers_and_metrics(spark, tmp_path):
    directory = "/root/testdata/sf0.001"
    texts = views.as_messages(views.event_text(spark, directory))
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    with metrics.following(metrics.ProgressTable(spark, str(tmp_path / "progress"))):
        state = {"fail": True}
        good = persist.table_writer(root)

        def flaky(batch, batch_id):
            good(batch, batch_id)
            if state.pop("fail", False):
                raise RuntimeError("lost after writing")

        texts.write.parquet(path)
        source = lambda: spark.readStream.schema(texts.schema).parquet(path)
        with pytest.raises(Exception, match="lost after writing"):
            drain(persist.persist_stream(source(), str(tmp_path / "cp"), flaky))
        drain(persist.persist_stream(source(), str(tmp_path / "cp"), flaky))
        query = drain(persist.persist_stream(source(), str(tmp_path / "cp2"), persist.counting_writer(str(tmp_path / "count"))))
    n = texts.count()
    good_rows = texts.where("seq % 6 < 3").count()
    assert persist.read_table(spark, root, "telemetry").count() == good_rows
    counts = persist.read_table(spark, root, "counts").first()
    assert (counts.received, counts.persisted, counts.rejected) == (n, good_rows, n - good_rows)
    assert persist.read_table(spark, root, "rejects").count() == n - good_rows
    assert persist.read_table(spark, str(tmp_path / "count"), "counts").first().received == n
    told = metrics.read_progress(spark, str(tmp_path / "progress"))
    assert told.where(F.col("query_id") == str(query.id)).agg(F.sum("input_rows")).first()[0] == n
    rows = [metrics.progress_row(p) for p in query.recentProgress]
    progress = spark.createDataFrame(rows, metrics.PROGRESS_SCHEMA)
    assert metrics.batch_durations(progress).first().rows == n


def test_table_without_accepted_rows(spark, tmp_path):
    bad = views.as_messages(views.event_text(spark, "/root/testdata/sf0.001")).where("seq % 6 = 5")
    root = str(tmp_path / "out")
    write = persist.table_writer(root)
    write(bad, 0)
    assert persist.read_table(spark, root, "telemetry").count() == 0
    assert persist.read_table(spark, root, "rejects").count() == bad.count()


def test_table_is_laid_out_by_date(spark, tmp_path):
    rows = views.as_messages(views.event_text(spark, "/root/testdata/sf0.001"))
    root = str(tmp_path / "out")
    write = persist.table_writer(root)
    for batch in (0, 1, 1):
        write(rows.where(F.col("seq") % 2 == batch), batch)
    table = persist.read_table(spark, root, "telemetry")
    assert table.count() == rows.where("seq % 6 < 3").count()
    dates = {p.name for p in (tmp_path / "out" / "telemetry").iterdir() if p.is_dir()}
    assert dates and all(name.startswith("event_date=") for name in dates)
    files = [len(list(p.glob("*.parquet"))) for p in (tmp_path / "out" / "telemetry").glob("*/batch_id=*")]
    assert set(files) == {1}


def test_alerts_of_closed_windows(spark, tmp_path):
    df = arrivals(spark, 1)
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    write = stream_windows.exact_window_writer(root)
    for low, high in ((0, 90), (90, 240)):
        land(df, path, low, high)
        drain(stream_windows.window_stream(spark.readStream.schema(SCHEMA).parquet(path), str(tmp_path / "cp"), write))
    found = {r.line for r in stream_windows.closed_alerts(spark, root).collect()}
    assert found and found == {r.line for r in windows.alert_lines(windows.exact_windows(df)).collect()}


def test_struct_order_equals_integer_order(spark):
    df = arrivals(spark, 4)
    packed = df.withColumn("seq", F.struct(F.col("arrival_ms").alias("at_us"), F.lit(0).alias("partition"), F.col("seq").alias("offset")))
    assert as_set(windows.exact_windows(packed)) == as_set(windows.exact_windows(df))


def test_repeated_deliveries_are_kept_once(spark, tmp_path):
    """A batch that comes again in a later one, and copies inside a batch; state is bounded by the delay."""
    schema = "device_id string, frameIdentifier int, t_emit bigint, arrival timestamp"
    path, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def rows(first, n):
        return spark.range(first, first + n).select(
            F.concat(F.lit("d"), F.col("id").cast("string")).alias("device_id"),
            F.lit(1).alias("frameIdentifier"),
            F.col("id").alias("t_emit"),
            F.timestamp_seconds(F.col("id") + 1_000_000).alias("arrival"),
        )

    with metrics.following(metrics.ProgressTable(spark, str(tmp_path / "progress"))) as listener:
        for part in (rows(0, 50).union(rows(0, 10)), rows(0, 50), rows(1000, 50), rows(1000, 5)):
            part.coalesce(1).write.mode("append").parquet(path)
            source = spark.readStream.schema(schema).parquet(path)
            kept = delivery.distinct_deliveries(source, "100 seconds")
            query = drain(delivery.delivery_stream(kept, root, checkpoint))
    summary = delivery.delivery_summary(spark.read.parquet(root), metrics.read_progress(spark, listener.path))
    assert tuple(summary.first()) == (165, 100, 65)
    # Keys of the first deliveries have left the state.
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 50
