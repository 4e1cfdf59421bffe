"""Run facts, their validation, the latest valid run and the comparison tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetstream.functions import loglines
from fleetstream.functions.rows import computed_once, null_safe_join
from fleetstream.functions.scalars import (
    memory_mb,
    or_na,
    percent,
    rounded_even,
    whole_number_text,
)
from fleetstream.schemas import RUN_FACT_FIELDS
from fleetstream.session import materialise
from fleetstream.sources.run_files import container_samples, run_lines

# Name prefix of the containers that count; pass the prefix of the measured project.
PROJECT_PREFIX = "fleet-"
# Configured seconds of a run per scenario (fixed values).
SCENARIO_SECONDS = {"A": 30, "B": 120, "C": 180, "D": 180}
RECOVERY_LIMIT_S = 60
LEAST_EMITTED = 100
METRIC_FILES = {
    "ingest": "ingest_metrics.txt",
    "storage": "storage_metrics.txt",
    "analytics": "analytics_metrics.txt",
}


COUNTERS = ("received_total", "persisted_total", "dropped_total", "batches_total")
GAUGES = ("lag_ms", "p95_lag_ms")
# Names in the metric dumps.
DUMP_FIELDS = [
    "storage_received_total",
    "storage_persisted_total",
    "storage_dropped_total",
    "storage_batches_total",
    "storage_lag_ms",
    "storage_p95_lag_ms",
    "ingest_emitted_total",
    "ingest_throughput_msg_per_sec",
]


def is_snapshot(file_name: Column) -> Column:
    """Dumps of the storage service, those taken during a run included."""
    return file_name.startswith("storage_metrics") & file_name.endswith(".txt")


def _whole(value: Column) -> Column:
    """Truncated to a whole number; null for NaN and infinities."""
    finite = F.abs(value) < F.lit(9.2e18)
    return F.when(finite, value).cast("bigint")


def line_fields(lines: DataFrame) -> DataFrame:
    """Up to three numbers per line, and the metric name of a dump line.

    ``n1`` to ``n3`` mean, by file: ingestion.log emitted and dropped of the final line
    and emitted of the mode line; analytics.log alerts and mean; timing.log recovery
    seconds, 1 for no recovery, latency seconds; storage.log batches, received, persisted;
    a dump the value of ``metric``.
    """
    file, value = F.col("file_name"), F.col("value")
    is_dump = is_snapshot(file) | file.isin(*METRIC_FILES.values())
    # The name is asked of dump lines only, and parsed once for all its uses.
    name = F.when(is_dump, loglines.metric_name(value))
    named = computed_once(
        lines, {"metric": F.when(name.isin(*DUMP_FIELDS), name)}, ["run_id", "file_name", "line_no", "value"]
    )

    def number(mark: str, pattern: str, group: int = 1) -> Column:
        # A search for a fixed text is far cheaper than the expression it guards.
        return F.when(value.contains(mark), loglines.captured_number(value, pattern, group))

    def counter(name: str) -> Column:
        return F.when(value.startswith(name), loglines.counter_line(value, name).cast("double"))

    numbers = {
        "ingestion.log": [
            number("dropped=", loglines.EMITTED_DROPPED),
            number("dropped=", loglines.EMITTED_DROPPED, 2),
            number("mode završen:", loglines.EMITTED_AT_END),
        ],
        "analytics.log": [
            F.when(
                value.contains(loglines.ALERT_MARK), F.regexp_count(value, F.lit(loglines.ALERT_MARK))
            )
            .otherwise(F.when(value.isNotNull(), 0))
            .cast("double"),
            number("mean_engine_temp=", loglines.MEAN_ENGINE),
        ],
        "timing.log": [
            number("Recovery detected", loglines.RECOVERED),
            F.when(value.contains(loglines.NO_RECOVERY), 1.0),
            number("E2E latency", loglines.E2E_SECONDS),
        ],
        "storage.log": [counter("batches"), counter("received"), counter("persisted")],
    }
    slots = [F.when(F.col("metric").isNotNull(), loglines.metric_value(value)), F.when(F.lit(False), 0.0)]
    slots.append(slots[1])
    for file_name, columns in numbers.items():
        for slot, column in enumerate(columns):
            slots[slot] = F.when(file == file_name, column).otherwise(slots[slot])
    numbered = (slot.alias(f"n{i}") for i, slot in enumerate(slots, 1))
    return named.select("run_id", "file_name", "line_no", "metric", *numbered)


def file_facts(lines: DataFrame) -> DataFrame:
    """First, last and summed numbers per run and file.

    Partial aggregation leaves one row per task and file for the shuffle, however many
    lines a run has.
    """
    position, metric, n1 = F.col("line_no"), F.col("metric"), F.col("n1")

    def where(condition: Column) -> Column:
        return F.when(condition, position)

    return (
        line_fields(lines)
        .groupBy("run_id", "file_name")
        .agg(
            *(
                F.min_by(n, where(F.col(n).isNotNull())).alias(f"first_{n}")
                for n in ("n1", "n2", "n3")
            ),
            F.max_by("n2", where(F.col("n2").isNotNull())).alias("last_n2"),
            F.sum("n1").alias("sum_n1"),
            *(
                F.max_by(n1, where((metric == name) & n1.isNotNull())).alias(name)
                for name in DUMP_FIELDS
            ),
        )
    )


def log_facts(lines: DataFrame) -> DataFrame:
    """Everything the logs and metric dumps say about a run, from one pass over the lines.

    ``lines`` hold ``run_id``, ``file_name``, ``line_no`` and ``value``; a row without
    ``value`` only marks the file as present.
    """
    file = F.col("file_name")

    def of(name: str, value: Column) -> Column:
        return F.max(F.when(file == name, value))

    def first(name: str, slot: int) -> Column:
        return of(name, _whole(F.col(f"first_n{slot}")))

    def flag(condition: Column) -> Column:
        return F.coalesce(F.max(condition), F.lit(False))

    def metric_of(name: str, *metrics: str) -> Column:
        return of(name, F.coalesce(*metrics, F.lit(0.0)))

    dump = METRIC_FILES["storage"]
    backlog = _whole(F.col("storage_received_total")) - _whole(F.col("storage_persisted_total"))
    services = METRIC_FILES.items()
    alerts = of("analytics.log", F.col("sum_n1")).cast("bigint")
    gathered = file_facts(lines).groupBy("run_id").agg(
        *(flag(file == name).alias(f"has_{service}") for service, name in services),
        first("ingestion.log", 1).alias("final_emitted"),
        first("ingestion.log", 2).alias("final_dropped"),
        first("ingestion.log", 3).alias("mode_emitted"),
        F.coalesce(alerts, F.lit(0)).alias("alerts"),
        of("analytics.log", F.col("last_n2")).alias("last_mean"),
        first("timing.log", 1).alias("recovery_s"),
        flag((file == "timing.log") & F.col("first_n2").isNotNull()).alias("no_recovery"),
        first("timing.log", 3).alias("e2e_latency_s"),
        first("storage.log", 1).alias("log_batches"),
        first("storage.log", 2).alias("log_received"),
        first("storage.log", 3).alias("log_persisted"),
        *(of(dump, _whole(F.col(f"storage_{name}"))).alias(f"dump_{name}") for name in COUNTERS),
        *(of(dump, F.col(f"storage_{name}")).alias(f"storage_{name}") for name in GAUGES),
        *(
            metric_of(name, "ingest_emitted_total", "storage_received_total").alias(
                f"{service}_emitted"
            )
            for service, name in services
        ),
        *(
            metric_of(name, "ingest_throughput_msg_per_sec").alias(f"{service}_throughput")
            for service, name in services
        ),
        F.max(F.when(is_snapshot(file), backlog)).alias("peak_backlog"),
    )

    def from_dump(counter: str, log_value: Column) -> Column:
        counted = F.coalesce(F.col(f"dump_{counter}_total"), F.lit(0))
        return F.when(F.col("has_storage"), counted).otherwise(log_value)

    return gathered.select(
        "run_id",
        F.coalesce("final_emitted", "mode_emitted").alias("emitted"),
        "alerts",
        "last_mean",
        "recovery_s",
        (F.col("no_recovery") & F.col("recovery_s").isNull()).alias("recovery_timeout"),
        "e2e_latency_s",
        from_dump("received", F.col("log_received")).alias("received"),
        from_dump("persisted", F.col("log_persisted")).alias("persisted"),
        from_dump("dropped", F.col("final_dropped")).alias("dropped"),
        from_dump("batches", F.col("log_batches")).alias("batches"),
        *(f"storage_{name}" for name in GAUGES),
        *(f"{service}_{name}" for service in METRIC_FILES for name in ("emitted", "throughput")),
        "peak_backlog",
        # No source gives a duration; it is filled from the scenario.
        F.lit(None).cast("bigint").alias("duration_s"),
    )


def metric_values(lines: DataFrame) -> DataFrame:
    """Every metric of every dump: the last line that gives a name a number wins."""
    parsed = computed_once(
        lines.where(F.col("value").isNotNull()),
        {
            "metric": loglines.metric_name(F.col("value")),
            "amount": loglines.metric_value(F.col("value")),
        },
        keep=["run_id", "file_name", "line_no"],
    )
    return (
        parsed.where(F.col("metric").isNotNull() & F.col("amount").isNotNull())
        .groupBy("run_id", "file_name", "metric")
        .agg(F.max_by("amount", "line_no").alias("amount"))
    )


def peak_backlog(lines: DataFrame) -> DataFrame:
    """Largest received minus persisted over the run's snapshots that have both."""
    facts = log_facts(lines.where(is_snapshot(F.col("file_name"))))
    return facts.where(F.col("peak_backlog").isNotNull()).select("run_id", "peak_backlog")


def container_means(samples: DataFrame, prefix: str = PROJECT_PREFIX) -> DataFrame:
    """Mean CPU and memory per container of the project.

    CPU text that is not a percentage is left out of the mean and counted.
    """
    cpu = percent(F.col("cpu"))
    return (
        samples.where((F.col("name") != "") & F.col("name").startswith(prefix))
        .groupBy("run_id", "name")
        .agg(
            F.avg(cpu).alias("cpu_avg"),
            F.avg(memory_mb(F.coalesce("memory", F.lit("0MiB / 0MiB")))).alias("mem_mb_avg"),
            F.count_if(cpu.isNull()).alias("bad_cpu"),
        )
    )


def container_usage(samples: DataFrame, prefix: str = PROJECT_PREFIX) -> DataFrame:
    """Sum over a run's containers of their mean CPU and memory."""
    return (
        container_means(samples, prefix)
        .groupBy("run_id")
        .agg(
            rounded_even(F.sum("cpu_avg"), 2).alias("total_cpu_avg"),
            rounded_even(F.sum("mem_mb_avg"), 2).alias("total_mem_mb_avg"),
        )
    )


def default_seconds(scenario: Column) -> Column:
    """Configured duration of a scenario: four fixed values, so no join."""
    chosen = F.lit(30)
    for name, seconds in SCENARIO_SECONDS.items():
        chosen = F.when(scenario == name, seconds).otherwise(chosen)
    return chosen.cast("bigint")


def with_derived(facts: DataFrame) -> DataFrame:
    """Fill the duration and derive throughput and loss, where messages were emitted."""
    emitted = F.col("emitted")
    has_emitted = F.coalesce(emitted != 0, F.lit(False))
    default = F.when(has_emitted, default_seconds(F.col("scenario")))
    seconds = F.nullif(F.col("duration_s"), F.lit(0))
    filled = facts.withColumn("duration_s", F.coalesce("duration_s", default))
    lost = F.try_divide(100.0 * (emitted - F.col("persisted")), emitted)
    return filled.withColumns(
        {
            "throughput_msg_per_sec": F.when(
                has_emitted, rounded_even(F.try_divide(emitted, seconds), 1)
            ),
            "loss_pct": F.when(has_emitted, rounded_even(lost, 2)),
        }
    )


def invalid_reason() -> Column:
    """The first plausibility rule a run breaks, or null."""
    e2e, duration = F.col("e2e_latency_s"), F.coalesce("duration_s", F.lit(0))
    recovery = F.col("recovery_s")
    emitted, received, batches, alerts = (
        F.coalesce(name, F.lit(0)) for name in ("emitted", "received", "batches", "alerts")
    )
    started = (emitted == 0) | (emitted >= LEAST_EMITTED)
    no_traffic = (received == 0) & started & ((emitted == 0) | (batches == 0))

    def text(*parts) -> Column:
        return F.concat(
            *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts)
        )

    return (
        F.when(e2e < 0, text("e2e_latency_s=", e2e, " (negative)"))
        .when((duration != 0) & (e2e > duration), text("e2e_latency_s=", e2e, " > duration_s=", duration))
        .when(F.coalesce("recovery_timeout", F.lit(False)), "recovery_s=timeout")
        .when(recovery > RECOVERY_LIMIT_S, text("recovery_s=", recovery, f" > {RECOVERY_LIMIT_S}"))
        .when((emitted > 0) & (emitted < LEAST_EMITTED), text("emitted=", emitted, f" < {LEAST_EMITTED}"))
        .when((emitted > 0) & (received > emitted), text("received=", received, " > emitted=", emitted))
        .when(no_traffic, "received=0")
        .when((alerts == 0) & F.col("run_id").contains("scenario-D"), "alerts=0")
    )


def validated(facts: DataFrame) -> DataFrame:
    """Add ``_valid`` and ``_invalid_reason`` (empty for a valid run)."""
    reason = F.coalesce(invalid_reason(), F.lit(""))
    return facts.withColumn("_invalid_reason", reason).withColumn(
        "_valid", F.col("_invalid_reason") == ""
    )


def run_facts(
    lines: DataFrame, samples: DataFrame, prefix: str = PROJECT_PREFIX
) -> DataFrame:
    """One validated fact row per run with all report columns."""
    run_id = F.col("run_id")
    facts = (
        log_facts(lines)
        .join(container_usage(samples, prefix), "run_id", "left")
        .withColumns(
            {
                part: F.coalesce(loglines.run_id_part(run_id, part), F.lit(""))
                for part in ("scenario", "broker", "num_devices", "level")
            }
            | {
                "total_cpu_avg": F.coalesce("total_cpu_avg", F.lit(0.0)),
                "total_mem_mb_avg": F.coalesce("total_mem_mb_avg", F.lit(0.0)),
                # Declared in the report and never filled.
                "first_alert_after_reconnect": F.lit(None).cast("string"),
            }
        )
    )
    checked = validated(with_derived(facts))
    return checked.select(*(F.col(n).cast(t).alias(n) for n, t in RUN_FACT_FIELDS.items()))


def matching_lines(
    lines: DataFrame, file_name: str, pattern: str, n: int, *, last: bool = True
) -> DataFrame:
    """The last (or first) ``n`` lines of each run's file that match a pattern.

    The rank limit is applied in every task before the shuffle, so a run with very many
    matching lines sends at most ``n`` of them per task.
    """
    position = F.col("line_no")
    order = Window.partitionBy("run_id").orderBy(position.desc() if last else position.asc())
    return (
        lines.where((F.col("file_name") == file_name) & F.col("value").rlike(pattern))
        .withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= n)
        .drop("__rank")
    )


def union_facts(*parts: DataFrame) -> DataFrame:
    """Facts with different columns as one table, columns sorted, missing ones null."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole.select(*sorted(whole.columns))


def write_facts(facts: DataFrame, path: str) -> None:
    """One CSV directory per scenario, columns in name order, missing values empty."""
    columns = sorted(facts.columns)
    facts.select(*columns).write.mode("overwrite").partitionBy("scenario").option(
        "header", True
    ).csv(path)


def latest_valid(facts: DataFrame) -> DataFrame:
    """Per scenario and broker the valid run with the largest id, else the largest id.

    The ids are aggregated before the shuffle and the facts are then filtered by one id per
    scenario and broker, so no broker's runs are sorted together.
    """
    chosen = facts.groupBy("scenario", "broker").agg(
        F.coalesce(
            F.max(F.when(F.coalesce("_valid", F.lit(True)), F.col("run_id"))), F.max("run_id")
        ).alias("run_id")
    )
    return null_safe_join(facts, chosen, ["scenario", "broker", "run_id"], "left_semi")


def comparison_tables(latest: DataFrame) -> dict[str, DataFrame]:
    """The report table of each scenario, cells as text with ``n/a`` for missing values."""
    rate = or_na(F.col("throughput_msg_per_sec").cast("decimal(38,1)"))
    usage = [or_na(F.col("total_cpu_avg")), or_na(F.col("total_mem_mb_avg"))]
    recovery = F.when(F.coalesce("recovery_timeout", F.lit(False)), "timeout").otherwise(
        or_na(F.col("recovery_s"))
    )
    blank_na = F.coalesce(F.nullif(F.col("num_devices"), F.lit("")), F.lit("n/a"))
    cells: dict[str, dict[str, Column]] = {
        "A": {
            "num_devices": or_na(F.col("num_devices")),
            "level": or_na(F.col("level")),
            "throughput": rate,
            "loss_pct": or_na(F.col("loss_pct")),
        },
        "B": {
            "num_devices": F.lit("n/a"),
            "duration_s": or_na(F.col("duration_s")),
            "recovery_s": recovery,
            "e2e_s": or_na(F.col("e2e_latency_s")),
            "alert_after_reconnect": or_na(F.col("first_alert_after_reconnect")),
        },
        "C": {
            "num_devices": blank_na,
            "duration_s": or_na(F.col("duration_s")),
            "lag_ms": whole_number_text(F.col("storage_lag_ms")),
            "p95_lag_ms": whole_number_text(F.col("storage_p95_lag_ms")),
            "peak_backlog": or_na(F.col("peak_backlog")),
        },
        "D": {
            "alerts": F.coalesce("alerts", F.lit(0)).cast("string"),
            "last_mean": or_na(F.col("last_mean")),
            "e2e_s": or_na(F.col("e2e_latency_s")),
        },
    }
    return {
        scenario: latest.where(F.col("scenario") == scenario).select(
            "broker",
            *(cell.alias(name) for name, cell in columns.items()),
            usage[0].alias("cpu_avg"),
            usage[1].alias("mem_mb_avg"),
        )
        for scenario, columns in cells.items()
    }


def report(
    spark: SparkSession, root: str, path: str, prefix: str = PROJECT_PREFIX
) -> dict[str, DataFrame]:
    """Read all runs below ``root``, write their facts to ``path``, return the comparison."""
    lines, samples = run_lines(spark, root), container_samples(spark, root)
    # One row per run, used by the written tables and by the comparison.
    facts = materialise(run_facts(lines, samples, prefix))
    write_facts(facts, path)
    return comparison_tables(latest_valid(facts))
