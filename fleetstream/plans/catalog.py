"""The registered queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.functions import loglines
from fleetstream.functions.scalars import mask_password, multi_value_max
from fleetstream.functions.topics import topic_matches
from fleetstream.operators import (
    batches,
    decode,
    latency,
    persist,
    quality,
    ranks,
    replay,
    windows,
)
from fleetstream.operators.scan import row_rank
from fleetstream.plans import run_report, views
from fleetstream.plans.views import HOUR_MS, table, telemetry
from fleetstream.session import fresh_path, materialise
from fleetstream.sources import messages as message_source
from fleetstream.sources import run_files
from fleetstream.sources.bucketed_runs import land_runs
from fleetstream.sources.telemetry_csv import read_telemetry_csv, telemetry_csv_rejects
from fleetstream.streaming import backlog as stream_backlogs
from fleetstream.streaming import committed as stream_commits
from fleetstream.streaming import delivery as stream_delivery
from fleetstream.streaming import latency as stream_latency
from fleetstream.streaming import metrics as stream_metrics
from fleetstream.streaming import persist as stream_persist
from fleetstream.streaming import sketches as stream_sketches
from fleetstream.streaming import windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

T0_MS = 1_704_067_200_000  # 2024-01-01 UTC
TICK_MS = 6 * HOUR_MS
BATCH_ROWS = 20
# Bounds for 1-hour windows: scaled from seconds to minutes.
HOUR_BOUNDS_S = [60 * b for b in (40.0, 45.0, 50.0, 55.0, 60.0, 62.0, 65.0, 70.0, 80.0)]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(name: str, digits: int = 4) -> Column:
    return F.round(F.col(name).cast("double"), digits).alias(name)


def window_columns(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "window_start",
        "window_end",
        "count",
        rounded("mean_engine_temp"),
        rounded("mean_tyre_temp"),
        "max_engine_temp",
        "max_tyre_temp",
        "earliest_t_emit",
        "latest_t_emit",
        *extra,
    )


# Windows


@query
def window_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.windows(telemetry(spark, sf_dir), HOUR_MS)
    return window_columns(windows.alerts(closed))


@query
def window_late_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = windows.mark_late(telemetry(spark, sf_dir), HOUR_MS)
    return marked.groupBy("device_id").agg(
        F.count_if(~F.col("is_late")).alias("accepted"), F.count_if("is_late").alias("late")
    )


@query
def window_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.late_counts(telemetry(spark, sf_dir), HOUR_MS)


@query
def window_exact_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    return window_columns(windows.alerts(closed))


@query
def window_latest_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    return windows.latest_mean(closed).select(rounded("mean_engine_temp"))


@query
def window_flush_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_columns(windows.windows(telemetry(spark, sf_dir), HOUR_MS, flush=True)).orderBy(
        "window_start"
    )


@query
def window_close_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    return closed.select("window_start", "closed_at_ms", "earliest_t_emit", "e2e_latency_ms")


@query
def latency_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    return windows.latency_histogram(closed, HOUR_BOUNDS_S).select(
        "le", "observations", rounded("sum_s", 2), "count"
    )


@query
def alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    return windows.alert_lines(closed).select("window_start", "line")


@query
def alert_line_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    closed = windows.exact_windows(telemetry(spark, sf_dir), HOUR_MS)
    line = F.col("line")
    return windows.alert_lines(closed).select(
        *(
            loglines.alert_field(line, name).try_cast("bigint").alias(name)
            for name in loglines.ALERT_FIELDS
            if not name.startswith("mean")
        )
    )


# Sources, scalars and decoding


@query
def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.telemetry_source(spark, sf_dir)
    wide = source.select(
        F.lit("spare").alias("pitStatus"),
        F.concat(F.lit(" "), F.col("tyresText"), F.lit(" ")).alias("tyresSurfaceTemperature"),
        F.col("engineTemperature"),
        F.col("device_id").alias("driver"),
        "speed",
        "worldPositionZ",
        "worldPositionY",
        "worldPositionX",
        F.lit("").alias("drs"),
        "pilot_index",
        "frameIdentifier",
        "sessionTime",
    )
    path = fresh_path(spark, "wide-csv")
    wide.write.option("header", True).option("ignoreTrailingWhiteSpace", False).option(
        "ignoreLeadingWhiteSpace", False
    ).csv(path)
    return read_telemetry_csv(spark, path).select(
        rounded("sessionTime", 2),
        "frameIdentifier",
        "pilot_index",
        rounded("worldPositionX", 2),
        rounded("worldPositionY", 2),
        rounded("worldPositionZ", 2),
        rounded("speed", 2),
        rounded("engineTemperature", 3),
        rounded("tyresSurfaceTemperature", 2),
    )


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and rejected, by the column at fault; a NaN speed is read."""
    source = views.telemetry_source(spark, sf_dir)
    kind = F.col("seq") % 10
    wide = source.select(
        "sessionTime",
        F.when(kind == 0, F.concat("frameIdentifier", F.lit(".0")))
        .otherwise(F.col("frameIdentifier").cast("string"))
        .alias("frameIdentifier"),
        "pilot_index",
        "worldPositionX",
        "worldPositionY",
        "worldPositionZ",
        F.when(kind == 3, "NaN").otherwise(F.col("speed").cast("string")).alias("speed"),
        "engineTemperature",
        F.when(kind == 7, "cold").otherwise(F.col("tyresText")).alias("tyresSurfaceTemperature"),
    )
    path = fresh_path(spark, "faulty-csv")
    wide.write.option("header", True).csv(path)
    read = read_telemetry_csv(spark, path).select(
        F.when(F.isnan("speed"), "none, NaN speed").otherwise("none").alias("bad_column"), "pilot_index"
    )
    rejects = telemetry_csv_rejects(spark, path).select("bad_column", F.col("pilot_index").cast("int"))
    return read.unionByName(rejects).groupBy("bad_column").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("pilot_index").alias("pilots")
    )


@query
def multi_value_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = views.telemetry_source(spark, sf_dir)
    kind = F.col("seq") % 5
    cell = (
        F.when(kind == 0, F.col("tyresText"))
        .when(kind == 1, F.concat(F.lit(" "), (F.col("seq") % 97).cast("string")))
        .when(kind == 2, F.lit("a/b"))
        .when(kind == 3, F.lit(" "))
        .otherwise(F.concat((F.col("seq") % 89).cast("string"), F.lit("f")))
    )
    return source.select("seq", multi_value_max(cell).cast("double").alias("value"))


@query
def decode_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.event_text(spark, sf_dir))
    return decode.accepted(decode.classified(messages)).select(
        "seq",
        "device_id",
        "pilot_index",
        "replica",
        rounded("engineTemperature", 3),
        rounded("tyresSurfaceTemperature", 3),
        "t_emit",
    )


@query
def decode_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.event_text(spark, sf_dir))
    return decode.rejected(decode.classified(messages)).select(
        "seq", "reject_reason", F.length("excerpt").alias("excerpt_length")
    )


@query
def decode_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.strict_text(spark, sf_dir))
    return decode.decode_strict(messages).select(
        "seq", "t_emit", rounded("engineTemperature", 3), rounded("tyresSurfaceTemperature", 3)
    )


@query
def topic_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = message_source.device_messages(telemetry(spark, sf_dir))
    topics = sent.select("topic").withColumn(
        "topic", F.when(F.col("topic").endswith("0"), F.concat(F.lit("x"), "topic")).otherwise(F.col("topic"))
    )
    return (
        topics.groupBy("topic")
        .agg(F.count(F.lit(1)).alias("messages"))
        .withColumn("all_devices", topic_matches(F.col("topic"), "iot/telemetry/#"))
        .withColumn("one_level", topic_matches(F.col("topic"), "+/telemetry/+"))
        .where("all_devices OR one_level")
    )


@query
def keyed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = message_source.keyed_messages(telemetry(spark, sf_dir))
    value = F.col("value")
    return sent.select(
        "key",
        "topic",
        F.get_json_object(value, "$.device_id").alias("device_id"),
        F.get_json_object(value, "$.t_emit").cast("bigint").alias("t_emit"),
        F.round(F.get_json_object(value, "$.engineTemperature").cast("double"), 3).alias("engine"),
        F.size(F.json_object_keys(value)).alias("fields"),
    )


@query
def mask_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    account = F.concat(
        F.lit("://iot:pw"), F.col("page_id").cast("string"), F.lit("@")
    )
    url = F.replace(F.col("url"), F.lit("://"), account)
    return pages.select("page_id", mask_password(url).alias("url"))


# Persisting, batches and lag


@query
def persist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.event_text(spark, sf_dir))
    events = decode.accepted(decode.classified(messages))
    rows = persist.persisted_rows(events, F.timestamp_millis(F.lit(T0_MS)))
    payload = F.col("payload")
    return rows.select(
        "device_id",
        "pilot_index",
        "replica",
        rounded("sessionTime", 2),
        "frameIdentifier",
        rounded("speed", 2),
        F.unix_millis("t_emit").alias("t_emit_ms"),
        F.unix_millis("t_persist").alias("t_persist_ms"),
        F.get_json_object(payload, "$.device_id").alias("payload_device"),
        F.get_json_object(payload, "$.t_emit").cast("bigint").alias("payload_t_emit"),
    )


def flushed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir).select("seq", "arrival_ms", "t_emit")
    return batches.flush_batches(events, tick_ms=TICK_MS, batch_size=BATCH_ROWS, t0_ms=T0_MS)


@query
def event_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir).select("seq", "arrival_ms", "t_emit")
    assigned = batches.assign_flush_batches(
        events, tick_ms=TICK_MS, batch_size=BATCH_ROWS, t0_ms=T0_MS
    )
    return assigned.select("seq", "tick", "batch_in_tick")


@query
def flush_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flushed(spark, sf_dir)


@query
def flush_batches_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flush batches of raw messages, in the order of their arrival at the broker."""
    messages = views.as_messages(views.event_text(spark, sf_dir)).drop("seq", "arrival_ms")
    events = decode.accepted(decode.classified(message_source.with_arrival(messages)))
    return batches.flush_batches(events, tick_ms=TICK_MS, batch_size=BATCH_ROWS, t0_ms=T0_MS)


@query
def batch_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranks.index_percentile(flushed(spark, sf_dir), "lag_ms", name="p95_lag_ms")


@query
def rolling_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.rolling_percentile(flushed(spark, sf_dir), rows=100, block=256).select(
        "batch_seq", "lag_ms", "p95_lag_ms"
    )


@query
def row_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir)
    rows = events.select(
        # A group may be missing.
        F.when(F.col("seq") % 11 != 0, F.col("pilot_index")).alias("pilot_index"),
        F.timestamp_millis("t_emit").alias("t_emit"),
        F.timestamp_millis(F.col("arrival_ms") + F.col("seq") % 7).alias("t_persist"),
    )
    return persist.row_lag(rows, ["pilot_index"]).select(
        "pilot_index", "rows", rounded("mean_lag_ms"), "max_lag_ms", "p95_lag_ms"
    )


# Replay


@query
def device_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    fleets = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.count(F.lit(1)).alias("fleet"))
    )
    return replay.fan_out(fleets, F.col("fleet")).select(
        "c_nationkey", "device_number", "pilot_index", "replica", "device_id"
    )


def replay_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events numbered densely, with a session clock that also jumps and runs back."""
    events = telemetry(spark, sf_dir)
    clock = F.col("seq") * F.lit(0.25) + (F.col("seq") % 17) * F.lit(0.5)
    return events.select(
        "seq",
        # A session may be missing.
        F.when(F.col("pilot_index") != 3, F.col("device_id")).alias("session"),
        (clock + 1).cast("float").alias("sessionTime"),
        "frameIdentifier",
        "engineTemperature",
        "tyresSurfaceTemperature",
    )


@query
def cyclic_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = replay_rows(spark, sf_dir)
    count = numbered.count()
    rows = row_rank(numbered, "seq", name="row_index")
    # Two and a half passes over the rows at 300 events per second.
    duration_ms = (5 * count * 1000) // (2 * 300)
    expanded = replay.cyclic_expand(
        rows, devices=45, rate=300, duration_ms=duration_ms, t0_ms=T0_MS, count=count
    )
    return expanded.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("emission").alias("emission_sum"),
        F.sum("frameIdentifier").alias("frame_sum"),
        F.min("t_emit").alias("first_t_emit"),
        F.max("t_emit").alias("last_t_emit"),
    )


@query
def replay_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_timeline(
        replay_rows(spark, sf_dir), session=["session"], order="seq", time_scale=100.0
    ).select("seq", "session", "session_ms", "wait_ms", "offset_ms")


@query
def device_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    replayed = replay.device_replay(
        replay_rows(spark, sf_dir),
        devices=25,
        duration_ms=15_000,
        t0_ms=T0_MS,
        session="session",
        order="seq",
        time_scale=100.0,
    )
    return replayed.groupBy("session", "device_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("seq").alias("seq_sum"),
        F.max("elapsed_ms").alias("last_elapsed_ms"),
        F.max("t_emit").alias("last_t_emit"),
    )


@query
def critical_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = telemetry(spark, sf_dir).select(
        "seq",
        "device_id",
        "engineTemperature",
        "tyresSurfaceTemperature",
        "t_emit",
        (F.col("arrival_ms") - T0_MS).alias("elapsed_ms"),
    )
    overlaid = replay.overlay_critical(
        events, inject_at_ms=10 * 24 * HOUR_MS, t0_ms=T0_MS, order="seq"
    )
    return window_columns(windows.windows(overlaid, HOUR_MS))


# Run reports


def runs_and_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    runs = views.run_orders(spark, sf_dir)
    return runs, views.run_lines_of(runs)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, lines = runs_and_lines(spark, sf_dir)
    return run_report.run_facts(lines, views.run_samples_of(runs))


@query
def metric_dump_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    dumps = lines.where(F.col("file_name").endswith("_metrics.txt"))
    return run_report.metric_values(dumps)


@query
def ingest_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    logs = lines.where(F.col("file_name") == "ingestion.log")
    return run_report.log_facts(logs).select("run_id", "emitted", "dropped")


@query
def analytics_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    logs = lines.where(F.col("file_name") == "analytics.log")
    return run_report.log_facts(logs).select("run_id", "alerts", "last_mean")


@query
def timing_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    logs = lines.where(F.col("file_name") == "timing.log")
    return run_report.log_facts(logs).select(
        "run_id", "recovery_s", "recovery_timeout", "e2e_latency_s"
    )


@query
def storage_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    logs = lines.where(F.col("file_name") == "storage.log")
    return run_report.log_facts(logs).select("run_id", "batches", "received", "persisted")


@query
def last_alert_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    return run_report.matching_lines(lines, "analytics.log", loglines.ALERT_MARK, 2).select(
        "run_id", "line_no"
    )


@query
def container_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report.container_usage(views.lineitem_samples(spark, sf_dir))


@query
def peak_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = runs_and_lines(spark, sf_dir)
    return run_report.peak_backlog(lines)


@query
def run_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).drop("_valid", "_invalid_reason", "first_alert_after_reconnect")


@query
def run_directories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of run directories, written to the shared folder and read again."""
    runs, lines = runs_and_lines(spark, sf_dir)
    root = fresh_path(spark, "runs")
    samples = run_files.sample_lines(views.run_samples_of(runs))
    run_files.write_runs(lines.unionByName(samples), root)
    read = run_report.run_facts(run_files.run_lines(spark, root), run_files.container_samples(spark, root))
    return read.drop("_valid", "_invalid_reason", "first_alert_after_reconnect")


@query
def run_facts_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts of runs that were landed in buckets of their ids."""
    runs, lines = runs_and_lines(spark, sf_dir)
    landed = land_runs(lines, views.run_samples_of(runs))
    found = landed.report(spark, run_report.run_facts)
    return found.drop("_valid", "_invalid_reason", "first_alert_after_reconnect")


@query
def run_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir).select("run_id", "_valid", "_invalid_reason")


@query
def run_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = facts(spark, sf_dir)
    with_rate = whole.where("scenario = 'A'").select(
        "run_id", "scenario", "emitted", "loss_pct", "throughput_msg_per_sec"
    )
    without = whole.where("scenario <> 'A'").select("run_id", "scenario", "emitted", "peak_backlog")
    return run_report.union_facts(with_rate, without)


@query
def latest_valid_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = run_report.latest_valid(materialise(facts(spark, sf_dir)))
    return latest.select("scenario", "broker", "run_id", "_valid", "emitted", "persisted")


def compared(spark: SparkSession, sf_dir: str, scenario: str) -> DataFrame:
    of_scenario = facts(spark, sf_dir).where(F.col("scenario") == scenario)
    latest = run_report.latest_valid(materialise(of_scenario))
    return run_report.comparison_tables(latest)[scenario]


@query
def comparison_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "A")


@query
def comparison_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "B")


@query
def comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "C")


@query
def comparison_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared(spark, sf_dir, "D")


@query
def facts_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The facts as written to CSV per scenario and read again by header."""
    path = fresh_path(spark, "facts-csv")
    run_report.write_facts(facts(spark, sf_dir), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(
        "scenario", "run_id", F.col("emitted").cast("bigint"), F.col("_valid").cast("boolean"), F.col("broker")
    )


@query
def normalise_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = views.run_orders(spark, sf_dir).select(
        "k", "broker", F.concat(F.col("level"), F.when(F.col("k") % 10 == 0, "x").otherwise("")).alias("raw")
    )
    # Every third level is asked of the other broker.
    asked = F.when(F.col("k") % 3 == 0, "mqtt").otherwise(F.col("broker"))
    return raw.select(
        "k", loglines.normalise_level(asked, F.upper("raw")).alias("level")
    )


# Quality and latency


def repeated_events(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Events with every seventh delivered twice and every 49th three times."""
    events = telemetry(spark, sf_dir).select("seq", "device_id", "frameIdentifier", "t_emit", *more)
    copies = F.when(F.col("seq") % 49 == 0, 3).when(F.col("seq") % 7 == 0, 2).otherwise(1)
    return events.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))


@query
def duplicate_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_summary(repeated_events(spark, sf_dir))


@query
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(repeated_events(spark, sf_dir))


@query
def first_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_keys(repeated_events(spark, sf_dir), ["t_emit"], n=5)


@query
def distinct_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_keys(repeated_events(spark, sf_dir), ["device_id"])


@query
def key_head_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_head_tail(repeated_events(spark, sf_dir), "t_emit", 10, 5)


@query
def key_arrival_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeated_events(spark, sf_dir).withColumn("arrival", F.col("seq") * 4 + F.col("copy"))
    return quality.key_head_tail(rows, "t_emit", 10, 5, order="arrival")


@query
def delivery_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some devices are delivered again (same keys), some twice over (other keys)."""
    events = telemetry(spark, sf_dir).withColumn("run_id", F.col("device_id"))
    seq = F.col("seq")
    again = events.where(F.col("pilot_index") % 3 == 0)
    other = events.where(F.col("pilot_index") % 5 == 1).withColumn("t_emit", F.col("t_emit") + 1)
    counts = quality.stage_counts(
        {
            "expected": events,
            "emitted": events.where(seq % 50 != 0),
            "dropped": events.where(seq % 50 == 0),
            "received": events.where(seq % 20 != 0),
            "persisted": events.where(seq % 10 != 0),
            "analysed": events.where((seq % 10 != 0) & (F.col("pilot_index") != 5)),
        },
        events.where(F.col("pilot_index") != 7).unionByName(again).unionByName(other),
    )
    return quality.delivery_report(counts)


def polls_and_baselines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Counter readings after a reconnect and the reading before it; a run an hour."""
    events = table(spark, sf_dir, "events")
    user, number = F.col("user_id"), F.col("event_id")
    run_id = F.concat(F.lit("run-"), user.cast("string")).alias("run_id")
    reconnect_ms = T0_MS + user * HOUR_MS
    polls = events.select(
        run_id,
        (number % 70).alias("tick_s"),
        F.when(number % 70 >= user % 80, 1000 + user + number % 9).otherwise(1000 + user).alias("value"),
        F.timestamp_millis(reconnect_ms + number % 70 * 1000).alias("at"),
    )
    baselines = events.groupBy(run_id).agg(
        F.max(1000 + user).alias("baseline"), F.timestamp_millis(F.max(reconnect_ms)).alias("at")
    )
    return polls, baselines


@query
def recovery_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latency.recovery_time(*polls_and_baselines(spark, sf_dir))


def injection_starts(runs: DataFrame, *keep: Column) -> DataFrame:
    return runs.where("scenario = 'D'").select(
        "run_id", F.col("day").alias("run_date"), (F.col("day_s") + 35_990).alias("started_s"), *keep
    )


@query
def alert_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs, lines = runs_and_lines(spark, sf_dir)
    return latency.alert_latency(lines, injection_starts(runs))


# Streams


SLICES = 3
# Starts and lines of one micro-batch; the join keeps its marks until the next, some 350 bytes each.
LATENCY_ROWS = 24_000_000


def in_slices(
    spark: SparkSession,
    df: DataFrame,
    run: Callable[[str], None],
    deliveries: int = 1,
    most: int | None = None,
) -> None:
    """Land a frame with ``seq`` as Parquet in arrival order and run a stream after each part.

    Every run drains what has landed and stops, so each following one resumes from the
    checkpoint.  With several ``deliveries`` every part is landed so many times.  All rows are
    landed in ``SLICES`` parts, or in more of about ``most`` rows.
    """
    path = fresh_path(spark, "landed")
    first, last, rows = df.agg(F.min("seq"), F.max("seq"), F.count(F.lit(1))).first()
    slices = SLICES if most is None else max(SLICES, -(-rows // most))
    width = (last - first) // slices + 1
    for number in range(slices):
        low = first + number * width
        part = df.where((F.col("seq") >= low) & (F.col("seq") < low + width))
        for _ in range(deliveries):
            part.write.mode("append").parquet(path)
            run(path)


def drained(writer) -> None:
    started = writer.trigger(availableNow=True).start()
    started.awaitTermination()


def parquet_writer(rows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    files = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return files.option("checkpointLocation", checkpoint)


@query
def stream_persist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.event_text(spark, sf_dir))
    root, checkpoint = fresh_path(spark, "persisted"), fresh_path(spark, "checkpoint")
    write = stream_persist.table_writer(root)

    def run(path: str) -> None:
        source = spark.readStream.schema(messages.schema).parquet(path)
        drained(stream_persist.persist_stream(source, checkpoint, write))

    in_slices(spark, messages, run)
    return stream_persist.read_table(spark, root, "telemetry").select(
        "device_id",
        "frameIdentifier",
        F.unix_millis("t_emit").alias("t_emit_ms"),
        rounded("engineTemperature", 3),
        F.get_json_object("payload", "$.t_emit").cast("bigint").alias("payload_t_emit"),
    )


@query
def stream_persist_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = views.as_messages(views.event_text(spark, sf_dir))
    root, checkpoint = fresh_path(spark, "persisted"), fresh_path(spark, "checkpoint")
    write = stream_persist.table_writer(root)

    def run(path: str) -> None:
        source = spark.readStream.schema(messages.schema).parquet(path)
        drained(stream_persist.persist_stream(source, checkpoint, write))

    in_slices(spark, messages, run)
    rejects = stream_persist.read_table(spark, root, "rejects")
    by_reason = rejects.groupBy(F.col("reject_reason").alias("stage")).agg(
        F.count(F.lit(1)).alias("messages")
    )
    counts = stream_persist.read_table(spark, root, "counts").agg(
        *(F.sum(name).alias(name) for name in ("received", "persisted", "rejected"))
    )
    return counts.unpivot([], ["received", "persisted", "rejected"], "stage", "messages").unionByName(
        by_reason
    )


@query
def stream_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that readers see while batches are written, lost before their commit and compacted."""
    messages = views.as_messages(views.event_text(spark, sf_dir))
    root, checkpoint = fresh_path(spark, "committed"), fresh_path(spark, "checkpoint")
    seen: list[tuple[str, int]] = []

    def look(stage: str) -> None:
        seen.append((stage, stream_commits.telemetry(spark, root).count()))

    def lost(batch_id: int) -> None:
        if batch_id == 1 and len(seen) == 1:
            look("second batch, written")
            raise RuntimeError("lost before the commit")

    def run(path: str) -> None:
        write = stream_commits.committed_writer(root, lost)
        source = spark.readStream.schema(messages.schema).parquet(path)
        try:
            drained(stream_persist.persist_stream(source, checkpoint, write))
        except StreamingQueryException:
            drained(stream_persist.persist_stream(source, checkpoint, write))
        look(f"batches committed: {len(stream_commits.CommitLog(spark, root).history())}")

    in_slices(spark, messages, run)
    stream_commits.compact(spark, root)
    look("compacted")
    stream_commits.remove_superseded(spark, root)
    look("superseded files removed")
    seen.append(("attempts with files", len(stream_commits.CommitLog(spark, root).attempts())))
    counts = stream_commits.batch_counts(spark, root).agg(
        *(F.sum(name).alias(name) for name in ("received", "persisted", "rejected"))
    )
    observed = counts.unpivot([], ["received", "persisted", "rejected"], "stage", "messages")
    told = spark.createDataFrame(seen, "stage string, messages bigint").unionByName(observed)
    reasons = stream_commits.rejects(spark, root).groupBy(F.col("reject_reason").alias("stage"))
    return told.unionByName(reasons.agg(F.count(F.lit(1)).alias("messages")))


@query
def stream_window_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    # In-order input: emission time is arrival time.
    events = telemetry(spark, sf_dir).withColumn("t_emit", F.col("arrival_ms"))
    root, checkpoint = fresh_path(spark, "windows"), fresh_path(spark, "checkpoint")

    def run(path: str) -> None:
        source = spark.readStream.schema(events.schema).parquet(path)
        closed = stream_windows.native_windows(source, HOUR_MS)
        with stream_windows.single_operator(spark):
            drained(parquet_writer(closed, root, checkpoint))

    in_slices(spark, events, run)
    return window_columns(spark.read.parquet(root))


@query
def stream_window_native_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Native windows of events out of order: late are those of windows closed by earlier slices."""
    events = telemetry(spark, sf_dir)
    root, checkpoint = fresh_path(spark, "windows"), fresh_path(spark, "checkpoint")

    def run(path: str) -> None:
        source = spark.readStream.schema(events.schema).parquet(path)
        closed = stream_windows.native_windows(source, HOUR_MS)
        with stream_windows.single_operator(spark):
            drained(parquet_writer(closed, root, checkpoint))

    in_slices(spark, events, run)
    return window_columns(spark.read.parquet(root))


def exact_stream(spark: SparkSession, sf_dir: str) -> str:
    events = telemetry(spark, sf_dir)
    root, checkpoint = fresh_path(spark, "windows"), fresh_path(spark, "checkpoint")
    write = stream_windows.exact_window_writer(root, HOUR_MS, bounds_s=HOUR_BOUNDS_S)

    def run(path: str) -> None:
        source = spark.readStream.schema(events.schema).parquet(path)
        drained(stream_windows.window_stream(source, checkpoint, write))

    in_slices(spark, events, run)
    return root


@query
def stream_window_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exact_stream(spark, sf_dir)
    closed = stream_windows.closed_windows(spark, root, HOUR_MS)
    return window_columns(closed, "closed_at_ms", "e2e_latency_ms")


@query
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = stream_windows.window_counts(spark, exact_stream(spark, sf_dir))
    return counts.agg(
        *(F.sum(name).alias(name) for name in ("received", "accepted", "late"))
    )


@query
def stream_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters, histogram and last mean of every micro-batch, as observed while it was written."""
    counts = stream_windows.window_counts(spark, exact_stream(spark, sf_dir))
    return stream_windows.observed_metrics(counts, HOUR_BOUNDS_S).select("batch_id", "metric", rounded("value"))


@query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = exact_stream(spark, sf_dir)
    return stream_windows.closed_alerts(spark, root, HOUR_MS).select("window_start", "line")


@query
def stream_flush(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window that the stream leaves open, closed at a given time."""
    root = exact_stream(spark, sf_dir)
    last = spark.read.parquet(f"{root}/{stream_windows.STATE}").agg(F.max("batch_id")).first()[0]
    flushed = stream_windows.open_window(spark, root, last, T0_MS + 10**12, HOUR_MS)
    return window_columns(flushed, "closed_at_ms", "e2e_latency_ms")


@query
def stream_message_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages to exact windows: strict decoding, arrival order, window state."""
    messages = views.as_messages(views.strict_text(spark, sf_dir))
    root, checkpoint = fresh_path(spark, "windows"), fresh_path(spark, "checkpoint")

    def decoded(raw: DataFrame) -> DataFrame:
        return decode.decode_strict(message_source.with_arrival(raw.drop("seq", "arrival_ms")))

    write = stream_windows.exact_window_writer(root, HOUR_MS, decoded)

    def run(path: str) -> None:
        source = spark.readStream.schema(messages.schema).parquet(path)
        drained(stream_windows.window_stream(source, checkpoint, write))

    in_slices(spark, messages, run)
    closed = stream_windows.closed_windows(spark, root, HOUR_MS)
    return window_columns(closed, "closed_at_ms", "e2e_latency_ms")


def landed_messages(spark: SparkSession, sf_dir: str, files: int = 3) -> tuple[str, DataFrame]:
    """Raw messages landed in so many files, without the columns of the test tables."""
    messages = views.as_messages(views.event_text(spark, sf_dir)).drop("seq", "arrival_ms")
    path = fresh_path(spark, "landed")
    messages.repartition(files, "offset").write.parquet(path)
    return path, messages


@query
def stream_readers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readers of one source: one loses a batch after writing it, the other only counts."""
    path, _ = landed_messages(spark, sf_dir)
    root, counted = fresh_path(spark, "persisted"), fresh_path(spark, "counted")
    good = stream_persist.table_writer(root)
    state = {"fail": True}

    def flaky(batch: DataFrame, batch_id: int) -> None:
        good(batch, batch_id)
        if state.pop("fail", False):
            raise RuntimeError("lost after writing")

    checkpoint = fresh_path(spark, "checkpoint")

    def persisting() -> None:
        source = message_source.message_files(spark, path, max_files_per_trigger=1)
        drained(stream_persist.persist_stream(source, checkpoint, flaky))

    try:
        persisting()
    except StreamingQueryException:
        persisting()
    source = message_source.message_files(spark, path)
    counting = stream_persist.counting_writer(counted)
    drained(stream_persist.persist_stream(source, fresh_path(spark, "checkpoint"), counting))
    rows = stream_persist.read_table(spark, root, "telemetry")
    tables = {
        "persisted": rows.agg(F.count(F.lit(1)).alias("messages")),
        "persisted, counted": stream_persist.read_table(spark, root, "counts").agg(F.sum("persisted").alias("messages")),
        "batches": stream_persist.read_table(spark, root, "counts").agg(F.count(F.lit(1)).alias("messages")),
        "received": stream_persist.read_table(spark, counted, "counts").agg(F.sum("received").alias("messages")),
    }
    parts = [table.select(F.lit(name).alias("reader"), "messages") for name, table in tables.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and batches that the progress table tells of a stream of one file per batch."""
    path, _ = landed_messages(spark, sf_dir)
    with stream_metrics.following(stream_metrics.ProgressTable(spark, fresh_path(spark, "progress"))) as listener:
        source = message_source.message_files(spark, path, max_files_per_trigger=1)
        counting = stream_persist.counting_writer(fresh_path(spark, "counted"))
        started = (
            stream_persist.persist_stream(source, fresh_path(spark, "checkpoint"), counting)
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    told = stream_metrics.read_progress(spark, listener.path)
    return stream_metrics.batch_durations(told.where(F.col("query_id") == str(started.id))).select("batches", "rows")


@query
def stream_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with copies, of which every slice is delivered twice, over restarts."""
    events = repeated_events(spark, sf_dir, "arrival_ms").withColumn("arrival", F.timestamp_millis("arrival_ms"))
    root, checkpoint = fresh_path(spark, "distinct"), fresh_path(spark, "checkpoint")

    def run(path: str) -> None:
        # The second delivery of what has landed last is a source file of its own.
        source = spark.readStream.schema(events.schema).parquet(path)
        kept = stream_delivery.distinct_deliveries(source, "60 days")
        drained(stream_delivery.delivery_stream(kept, root, checkpoint))

    with stream_metrics.following(stream_metrics.ProgressTable(spark, fresh_path(spark, "progress"))) as listener:
        in_slices(spark, events, run, deliveries=2)
    return stream_delivery.delivery_summary(spark.read.parquet(root), stream_metrics.read_progress(spark, listener.path))


def at_days_of_id(runs: DataFrame) -> DataFrame:
    """Runs with ``told_s``: the ``day_s`` of every run that has the same id, each once."""
    days = runs.select("run_id", F.col("day_s").alias("told_s"))
    known, told = F.count("told_s"), F.col("told_s")
    differ = (F.min(told) < F.max(told)) | ((known > 0) & (known < F.count(F.lit(1))))
    shared = materialise(days.groupBy("run_id").agg(differ.alias("differ")).where("differ").select("run_id"))
    own = runs.withColumn("told_s", F.col("day_s"))
    if shared.isEmpty():
        return own
    others = materialise(days.join(shared, "run_id").distinct())
    return own.unionByName(runs.join(others, "run_id").where(~told.eqNullSafe(F.col("day_s"))))


@query
def stream_alert_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``alert_latency`` while starts and log lines of the runs stream in."""
    runs = at_days_of_id(views.run_orders(spark, sf_dir))
    line_s = F.col("day_s") + 36_000 + 10 * F.col("line_no")
    begun = injection_starts(runs, F.col("told_s").alias("day_s")).withColumn("at", F.timestamp_seconds("started_s"))
    lines = views.run_lines_of(runs, F.col("told_s").alias("day_s"), files=["ingestion.log", "analytics.log"])
    told = lines.withColumn("at", F.timestamp_seconds(line_s))
    # A run that starts when all others are over moves the watermarks beyond them.
    after = materialise(runs.agg((F.max("day_s") + 172_800).alias("day_s")))
    last = [F.lit("after all").alias("run_id"), "day_s", F.timestamp_seconds("day_s").alias("at")]
    last_start = after.select(*last, F.lit("20990101").alias("run_date"), F.col("day_s").alias("started_s"))
    last_line = after.select(
        *last,
        F.lit("analytics.log").alias("file_name"),
        F.lit(0).cast("bigint").alias("line_no"),
        F.lit(f"{loglines.ALERT_MARK}0").alias("value"),
    )
    rows = begun.unionByName(last_start).unionByName(told.unionByName(last_line), allowMissingColumns=True)
    rows = rows.withColumn("seq", F.col("day_s"))
    root, checkpoint = fresh_path(spark, "latencies"), fresh_path(spark, "checkpoint")

    def run(path: str) -> None:
        source = spark.readStream.schema(rows.schema).parquet(path)
        found = stream_latency.alert_latency_stream(
            source.where("file_name is not null"),
            source.where("file_name is null").withColumnRenamed("at", "started_at"),
        )
        with stream_latency.short_state(spark):
            drained(parquet_writer(found, root, checkpoint))

    in_slices(spark, rows, run, most=LATENCY_ROWS)
    return spark.read.parquet(root)


@query
def stream_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``recovery_time`` while the counter is polled; time-outs by timer alone."""
    polls, baselines = polls_and_baselines(spark, sf_dir)
    rows = baselines.unionByName(polls, allowMissingColumns=True)
    # A run without a baseline when all others are over moves the watermark beyond them.
    after = baselines.agg((F.max("at") + F.expr("INTERVAL 1 HOUR")).alias("at")).select(
        F.lit("after all").alias("run_id"), "at", F.lit(1).cast("bigint").alias("tick_s"), F.lit(0).cast("bigint").alias("value")
    )
    rows = rows.unionByName(after, allowMissingColumns=True).withColumn("seq", F.unix_seconds("at"))
    root, checkpoint = fresh_path(spark, "recoveries"), fresh_path(spark, "checkpoint")

    def run(path: str) -> None:
        source = spark.readStream.schema(rows.schema).parquet(path)
        found = stream_latency.recovery_stream(
            source.where("baseline is null"), source.where("baseline is not null")
        )
        with stream_latency.keyed_state(spark):
            drained(parquet_writer(found, root, checkpoint))

    in_slices(spark, rows, run)
    return spark.read.parquet(root)


@query
def stream_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of five landed files while a stream takes at most two at a time."""
    path, _ = landed_messages(spark, sf_dir, files=5)
    with stream_metrics.following(stream_metrics.ProgressTable(spark, fresh_path(spark, "progress"))) as listener:
        source = message_source.message_files(spark, path, max_files_per_trigger=2)
        counted = stream_backlogs.counting_files(source)
        drained(parquet_writer(counted, fresh_path(spark, "copied"), fresh_path(spark, "checkpoint")))
    left = stream_backlogs.backlog(
        stream_metrics.read_progress(spark, listener.path), stream_backlogs.landed_files(spark, path)
    )
    rows = left.agg(F.sum("input_rows").alias("rows"))
    return left.select(
        "batch_id",
        "files_read",
        "files_left",
        (F.col("bytes_left") == 0).alias("all_bytes_read"),
        rows.scalar().alias("rows_in_all"),
    )


@query
def stream_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag p95 per pilot from merged sketches of micro-batches, judged by the exact ranks."""
    lags = telemetry(spark, sf_dir).select(
        "seq", "pilot_index", (F.col("arrival_ms") + F.col("seq") % 977 - F.col("t_emit")).alias("lag_ms")
    )
    root, checkpoint = fresh_path(spark, "p95"), fresh_path(spark, "checkpoint")
    group = ["pilot_index"]
    write = stream_sketches.sketch_writer(root, "lag_ms", group)

    def run(path: str) -> None:
        source = spark.readStream.schema(lags.schema).parquet(path)
        drained(stream_sketches.sketch_stream(source, checkpoint, write))

    in_slices(spark, lags, run)
    told = stream_sketches.merged_percentile(spark, root, group, name="p95_lag_ms")
    judged = stream_sketches.rank_error(lags, "lag_ms", told, "p95_lag_ms", group)
    within = (F.col("rank_error") <= stream_sketches.STATED_ERROR).alias("within_error")
    return told.join(judged, group).select("pilot_index", "rows", within)
