"""Progress of running streams as a table."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from fleetstream.operators.ranks import index_percentile

PROGRESS_SCHEMA = (
    "query_id string, run_id string, batch_id bigint, at string, input_rows bigint, "
    "input_rows_per_s double, processed_rows_per_s double, duration_ms bigint, "
    "dropped_by_watermark bigint, observed string"
)


def progress_row(progress) -> tuple:
    """One micro-batch as a row of ``PROGRESS_SCHEMA``."""
    body = json.loads(progress.json)
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for op in body.get("stateOperators", []))
    return (
        body["id"],
        body["runId"],
        int(body["batchId"]),
        body["timestamp"],
        int(body.get("numInputRows", 0)),
        float(body.get("inputRowsPerSecond", 0.0)),
        float(body.get("processedRowsPerSecond", 0.0)),
        int(body.get("batchDuration", 0)),
        int(dropped),
        # What ``observe`` counted in the batch, by the names it was given.
        json.dumps(body.get("observedMetrics") or {}),
    )


class ProgressTable(StreamingQueryListener):
    """Appends the progress of micro-batches to a JSON table.

    Rows are kept until there are ``rows`` of them or a query ends, so that the callback
    writes one file for many micro-batches.
    """

    def __init__(self, spark: SparkSession, path: str, rows: int = 500):
        self.spark = spark
        self.path = path
        self.rows = rows
        self.waiting: list[tuple] = []
        self.lock = Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.waiting.append(progress_row(event.progress))
            full = len(self.waiting) >= self.rows
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        """Write what is waiting."""
        with self.lock:
            rows, self.waiting = self.waiting, []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").json(self.path)


@contextmanager
def following(listener: ProgressTable) -> Iterator[ProgressTable]:
    """Attach the listener; all progress of queries that ended inside is in its table after.

    Spark tells listeners asynchronously, so they are waited for before the listener goes.
    """
    spark = listener.spark
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        spark.streams.removeListener(listener)
        listener.flush()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS_SCHEMA).json(path)


def observed_totals(progress: DataFrame, name: str, counters: list[str]) -> DataFrame:
    """Sums over all batches of the counters observed under a name."""
    kind = f"`{name}` struct<{', '.join(f'`{c}`: bigint' for c in counters)}>"
    seen = progress.select(F.from_json("observed", kind)[name].alias("seen"))
    return seen.agg(*(F.coalesce(F.sum(F.col("seen")[c]), F.lit(0)).alias(c) for c in counters))


def batch_durations(progress: DataFrame) -> DataFrame:
    """Batches, rows, longest and p95 micro-batch duration per query."""
    work = progress.where(F.col("input_rows") > 0)
    p95 = index_percentile(work, "duration_ms", ["query_id"], name="p95_duration_ms")
    totals = work.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("input_rows").alias("rows"),
        F.max("duration_ms").alias("max_duration_ms"),
    )
    return totals.join(p95, "query_id")
