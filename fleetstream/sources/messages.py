"""Event streams as raw messages: Kafka sources and sinks, per-device topics, arrival order.

The Kafka connector is an optional package of Spark.  Everything downstream only needs a
DataFrame with the columns of ``MESSAGE_SCHEMA``, from whatever source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from fleetstream.functions.scalars import event_json
from fleetstream.functions.topics import device_topic, topic_matches
from fleetstream.schemas import MESSAGE_SCHEMA

DEFAULT_TOPIC = "iot-telemetry"
DEVICE_TOPIC_PREFIX = "iot/telemetry"


def kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str = DEFAULT_TOPIC,
    *,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """A topic from its earliest offset; later runs resume from the checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
    )
    if max_offsets_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load()


def message_files(
    spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Raw messages landed as Parquet files, as a stream in file order."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def subscribed(messages: DataFrame, topic_filter: str) -> DataFrame:
    """Messages whose topic matches a subscription filter."""
    return messages.where(topic_matches(F.col("topic"), topic_filter))


def with_arrival(messages: DataFrame) -> DataFrame:
    """Add ``seq`` and ``arrival_ms``: order by broker time, then partition, then offset.

    ``seq`` is a struct of the three, which compares and aggregates without sorting.
    """
    arrival = F.struct(F.unix_micros("timestamp").alias("at_us"), "partition", "offset")
    return messages.withColumns({"seq": arrival, "arrival_ms": F.unix_millis("timestamp")})


def keyed_messages(events: DataFrame, topic: str = DEFAULT_TOPIC) -> DataFrame:
    """Events as messages keyed by device, so a device keeps to one partition."""
    return events.select(
        F.col("device_id").alias("key"), event_json().alias("value"), F.lit(topic).alias("topic")
    )


def device_messages(events: DataFrame, prefix: str = DEVICE_TOPIC_PREFIX) -> DataFrame:
    """Events as messages on one topic per device.

    The topic stays a column: as a partition directory it would make one per device.
    """
    return events.select(
        F.col("device_id").alias("key"),
        event_json().alias("value"),
        device_topic(prefix, F.col("device_id")).alias("topic"),
    )


# Producer settings of the delivery levels of a keyed topic.
ACKS = {"0": "0", "1": "1", "all": "all"}


def write_kafka(messages: DataFrame, brokers: str, *, acks: str = "all") -> None:
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", ACKS[acks])
        .save()
    )


def stream_to_kafka(
    messages: DataFrame, brokers: str, checkpoint: str, *, acks: str = "all"
) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", ACKS[acks])
        .option("checkpointLocation", checkpoint)
    )
