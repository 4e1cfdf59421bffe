"""Message stream to the telemetry table, rejects and per-batch counts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.operators.decode import accepted, classified, rejected
from fleetstream.operators.persist import BATCH_ID, EVENT_DATE, append_batch, persisted_rows
from fleetstream.schemas import PERSISTED_FIELDS

TELEMETRY_SCHEMA = (
    ", ".join(f"{name} {PERSISTED_FIELDS[name]}" for name in PERSISTED_FIELDS)
    + f", {EVENT_DATE} date, {BATCH_ID} bigint"
)

BatchWriter = Callable[[DataFrame, int], None]


def batch_path(root: str, table: str, batch_id: int) -> str:
    return f"{root}/{table}/batch_id={batch_id}"


def table_writer(root: str) -> BatchWriter:
    """Micro-batch writer of ``telemetry``, ``rejects`` and ``counts`` below ``root``.

    Each output belongs to its batch id and is overwritten when the batch is replayed, so
    a batch that fails halfway leaves nothing behind twice.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        t_persist = datetime.now(UTC)
        batch = classified(messages).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = persisted_rows(accepted(batch), t_persist)
            append_batch(rows, f"{root}/telemetry", batch_id)
            refused = rejected(batch)
            refused.write.mode("overwrite").parquet(batch_path(root, "rejects", batch_id))
            is_rejected = F.col("reject_reason").isNotNull()
            counts = batch.agg(
                F.count(F.lit(1)).alias("received"),
                F.count_if(~is_rejected).alias("persisted"),
                F.count_if(is_rejected).alias("rejected"),
                F.lit(t_persist).cast("timestamp").alias("t_persist"),
            )
            counts.write.mode("overwrite").parquet(batch_path(root, "counts", batch_id))
        finally:
            batch.unpersist()

    return write


def counting_writer(root: str) -> BatchWriter:
    """Micro-batch writer that drops the events and keeps only their counts."""

    def write(messages: DataFrame, batch_id: int) -> None:
        counts = messages.agg(F.count(F.lit(1)).alias("received"))
        counts.write.mode("overwrite").parquet(batch_path(root, "counts", batch_id))

    return write


def jdbc_writer(url: str, table: str, properties: dict[str, str], batch_size: int = 500) -> BatchWriter:
    """Micro-batch writer that appends accepted events to a database table.

    Appending is at least once: a replayed batch appends again, so rows carry ``batch_id``
    for the table's own unique key.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        rows = persisted_rows(accepted(classified(messages)), datetime.now(UTC))
        (
            rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("append")
            .option("batchsize", batch_size)
            .option("isolationLevel", "READ_COMMITTED")
            .jdbc(url, table, properties=properties)
        )

    return write


def persist_stream(messages: DataFrame, checkpoint: str, write: BatchWriter) -> DataStreamWriter:
    """Stream writer; choose a trigger and start it.

    A query with its own checkpoint is an independent reader: several may follow one
    source, and each resumes where its checkpoint stands.
    """
    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """One of the tables below ``root``; ``telemetry`` is empty while no row was accepted."""
    path = f"{root}/{table}"
    if table != "telemetry":
        return spark.read.option("basePath", path).parquet(path)
    if not _exists(spark, path):
        return spark.createDataFrame([], TELEMETRY_SCHEMA)
    return spark.read.schema(TELEMETRY_SCHEMA).option("basePath", path).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place)
