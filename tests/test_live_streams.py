import random

import pytest
from pyspark.sql import functions as F

from fleetstream.operators import latency
from fleetstream.streaming import backlog, metrics, sketches
from fleetstream.streaming import latency as stream_latency

POLLS = "run_id string, tick_s bigint, value bigint, at timestamp"
BASELINES = "run_id string, baseline bigint, at timestamp"
BASE_S = 1_704_153_600


def drain(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def files_of(rows, path, checkpoint):
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def at(seconds):
    return F.timestamp_seconds(F.lit(BASE_S) + seconds)


def test_two_readings_are_enough():
    rng = random.Random(3)
    for _ in range(500):
        readings = [(rng.randrange(1, 9), rng.randrange(4)) for _ in range(rng.randrange(7))]
        value_1, tick_1, value_2, tick_2 = stream_latency.earliest_two(readings)
        for baseline in range(5):
            expected = min((t for t, v in readings if v != baseline), default=None)
            assert (tick_2 if value_1 == baseline else tick_1) == expected


@pytest.mark.parametrize("seed", [1, 2])
def test_recovery_stream_equals_batch_over_restarts(spark, tmp_path, seed):
    rng = random.Random(seed)
    polls, baselines = [], []
    for number in range(12):
        run, start = f"r{number}", number * 30
        baselines.append((run, 5, start))
        recovers = rng.choice([1, 20, 59, 60, 61, 99])
        for tick in range(0, 64, rng.choice([1, 3])):
            value = None if rng.random() < 0.1 else 5 + (tick >= recovers) * rng.randrange(1, 4)
            polls += [(run, tick, value, start + tick)] * rng.choice([1, 1, 2])
    polls.append((None, 3, 9, 40))
    polls.append(("no baseline", 3, 9, 43))
    typed = spark.createDataFrame(polls, "run_id string, tick_s bigint, value bigint, s bigint").withColumn("at", at(F.col("s")))
    known = spark.createDataFrame(baselines, "run_id string, baseline bigint, s bigint").withColumn("at", at(F.col("s")))
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    told = []
    for low, high in [(0, 45), (45, 46), (46, 200), (200, 1000)]:
        part = (F.col("s") >= low) & (F.col("s") < high)
        # Within a part rows arrive in any order.
        typed.where(part).orderBy(F.rand(seed)).drop("s").write.mode("append").parquet(str(tmp_path / "polls"))
        known.where(part).drop("s").write.mode("append").parquet(str(tmp_path / "known"))
        if high == 1000:
            end = spark.createDataFrame([("end", 1, 0)], "run_id string, tick_s bigint, value bigint")
            end.withColumn("at", at(F.lit(5000))).write.mode("append").parquet(str(tmp_path / "polls"))
        found = stream_latency.recovery_stream(
            spark.readStream.schema(POLLS).parquet(str(tmp_path / "polls")),
            spark.readStream.schema(BASELINES).parquet(str(tmp_path / "known")),
        )
        with stream_latency.keyed_state(spark):
            drain(files_of(found, root, checkpoint))
        told.append(spark.read.parquet(root).count())
    assert told == sorted(told) and told[-1] == 12
    rows = lambda df: sorted(tuple(r) for r in df.select("run_id", "baseline", F.coalesce("recovery_s", F.lit(-1)), "recovery_timeout").collect())
    expected = latency.recovery_time(typed.drop("s", "at"), known.drop("s", "at"))
    assert rows(spark.read.parquet(root)) == rows(expected)
    assert {r.recovery_timeout for r in expected.collect()} == {True, False}
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_alert_latency_stream_equals_batch_over_restarts(spark, tmp_path):
    alert = lambda s, top: f"[x WRN] ALERT window_start={(BASE_S + s) * 1000} window_end=1 max_engine_temp={top} y"
    inject = lambda clock: f"[{clock} WRN] INJECT_HIGH_TEMP: emitting"
    lines = [
        ("a", "ingestion.log", 3, inject("00:00:05"), 5), ("a", "ingestion.log", 9, inject("00:00:59"), 59),
        ("a", "analytics.log", 2, alert(10, 1500), 20), ("a", "analytics.log", 1, alert(0, 95), 10), ("a", "analytics.log", 3, alert(20, 1500), 30),
        ("b", "ingestion.log", 1, inject("00:10:00"), 600), ("b", "analytics.log", 5, alert(610, 95), 620), ("b", "analytics.log", 5, alert(610, 95), 620),
        ("c", "analytics.log", 1, "quiet", 1210), ("unknown", "analytics.log", 1, alert(0, 1500), 1215),
        ("e", "ingestion.log", 1, inject("00:30:00"), 1800), ("e", "analytics.log", 1, alert(1790, 1500), 1801),
        (None, "analytics.log", 1, alert(0, 1500), 1802),
    ]
    starts = [("a", 0), ("b", 600), ("c", 1200), ("d", 1205), ("e", 1795)]
    read = spark.createDataFrame(lines, "run_id string, file_name string, line_no bigint, value string, s bigint").withColumn("at", at(F.col("s")))
    begun = spark.createDataFrame(starts, "run_id string, s bigint").select(
        "run_id", F.lit("20240102").alias("run_date"), (F.lit(BASE_S) + F.col("s")).alias("started_s"), at(F.col("s")).alias("started_at"), "s"
    )
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    end_line = spark.createDataFrame([("end", "analytics.log", 1, alert(0, 95))], "run_id string, file_name string, line_no bigint, value string")
    end_start = spark.createDataFrame([("end", "20240102", 0)], "run_id string, run_date string, started_s bigint")
    for low, high in [(0, 15), (15, 700), (700, 5000)]:
        part = (F.col("s") >= low) & (F.col("s") < high)
        read.where(part).drop("s").write.mode("append").parquet(str(tmp_path / "lines"))
        begun.where(part).drop("s").write.mode("append").parquet(str(tmp_path / "starts"))
        if high == 5000:
            end_line.withColumn("at", at(F.lit(9000))).write.mode("append").parquet(str(tmp_path / "lines"))
            end_start.withColumn("started_at", at(F.lit(9000))).write.mode("append").parquet(str(tmp_path / "starts"))
        found = stream_latency.alert_latency_stream(
            spark.readStream.schema(read.drop("s").schema).parquet(str(tmp_path / "lines")),
            spark.readStream.schema(begun.drop("s").schema).parquet(str(tmp_path / "starts")),
        )
        drain(files_of(found, root, checkpoint))
    rows = lambda df: {r.run_id: (r.e2e_latency_s, r.measured) for r in df.collect()}
    expected = rows(latency.alert_latency(read, begun))
    assert rows(spark.read.parquet(root)) == expected
    assert spark.read.parquet(root).count() == len(starts)
    assert {m for _, m in expected.values()} == {"inject", "fallback", "no alert"}


def test_backlog_falls_by_the_admission_limit(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = spark.range(700)
    for _ in range(7):
        rows.coalesce(1).write.mode("append").parquet(path)
    with metrics.following(metrics.ProgressTable(spark, str(tmp_path / "progress"))) as listener:
        source = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 3).parquet(path)
        drain(files_of(backlog.counting_files(source), str(tmp_path / "out"), str(tmp_path / "cp")))
    left = backlog.backlog(metrics.read_progress(spark, listener.path), backlog.landed_files(spark, path))
    told = left.orderBy("batch_id").collect()
    assert [(r.files_read, r.files_left, r.input_rows) for r in told] == [(3, 4, 2100), (3, 1, 2100), (1, 0, 700)]
    assert told[0].bytes_left > told[1].bytes_left > told[2].bytes_left == 0


def test_merged_sketches_stay_within_the_stated_error(spark, tmp_path):
    values = spark.range(60_000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 50 > 0, F.xxhash64("id") % 10_000).alias("v"),
        (F.col("id") / 15_000).cast("int").alias("part"),
    )
    root, group = str(tmp_path / "out"), ["g"]
    write = sketches.sketch_writer(root, "v", group)
    for part in range(4):
        write(values.where(F.col("part") == part), part)
    write(values.where("part = 2"), 2)
    told = sketches.merged_percentile(spark, root, group, name="p95")
    assert {(r.g, r["rows"]) for r in told.collect()} == {(g, n) for g, n in ((None, 19_600), (1, 19_600), (2, 19_600))}
    errors = sketches.rank_error(values, "v", told, "p95", group).collect()
    assert len(errors) == 3 and all(r.rank_error <= sketches.STATED_ERROR for r in errors)
    exact = values.where("v is not null and g = 1").orderBy("v").collect()
    p95 = next(r.p95 for r in told.collect() if r.g == 1)
    assert abs(sum(r.v < p95 for r in exact) / len(exact) - 0.95) <= sketches.STATED_ERROR
