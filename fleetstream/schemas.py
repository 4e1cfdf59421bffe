"""Schemas by name; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns read from the wide telemetry CSV, in event order.  The tyre cell
# is text holding one value per tyre.
CSV_FIELDS: dict[str, str] = {
    "sessionTime": "float",
    "frameIdentifier": "int",
    "pilot_index": "int",
    "worldPositionX": "float",
    "worldPositionY": "float",
    "worldPositionZ": "float",
    "speed": "float",
    "engineTemperature": "float",
    "tyresSurfaceTemperature": "multi",
}

# Field names of the event JSON (fixed values of the wire format).
EVENT_FIELDS: dict[str, str] = {
    "device_id": "string",
    "pilot_index": "int",
    "replica": "int",
    "sessionTime": "float",
    "frameIdentifier": "int",
    "speed": "float",
    "engineTemperature": "float",
    "tyresSurfaceTemperature": "float",
    "worldPositionX": "float",
    "worldPositionY": "float",
    "worldPositionZ": "float",
    "t_emit": "bigint",
}

# Raw message contract: what a Kafka source delivers.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Columns of a persisted telemetry row.
PERSISTED_FIELDS: dict[str, str] = {
    "device_id": "string",
    "pilot_index": "int",
    "replica": "int",
    "sessionTime": "float",
    "frameIdentifier": "int",
    "speed": "float",
    "engineTemperature": "float",
    "tyresSurfaceTemperature": "float",
    "worldPositionX": "float",
    "worldPositionY": "float",
    "worldPositionZ": "float",
    "t_emit": "timestamp",
    "t_persist": "timestamp",
    "payload": "string",
}

# Run fact columns and types; a scenario that lacks a column reports it as null.
RUN_FACT_FIELDS: dict[str, str] = {
    "_invalid_reason": "string",
    "_valid": "boolean",
    "alerts": "bigint",
    "analytics_emitted": "double",
    "analytics_throughput": "double",
    "batches": "bigint",
    "broker": "string",
    "dropped": "bigint",
    "duration_s": "bigint",
    "e2e_latency_s": "bigint",
    "emitted": "bigint",
    "first_alert_after_reconnect": "string",
    "ingest_emitted": "double",
    "ingest_throughput": "double",
    "last_mean": "double",
    "level": "string",
    "loss_pct": "double",
    "num_devices": "string",
    "peak_backlog": "bigint",
    "persisted": "bigint",
    "received": "bigint",
    "recovery_s": "bigint",
    "recovery_timeout": "boolean",
    "run_id": "string",
    "scenario": "string",
    "storage_emitted": "double",
    "storage_lag_ms": "double",
    "storage_p95_lag_ms": "double",
    "storage_throughput": "double",
    "throughput_msg_per_sec": "double",
    "total_cpu_avg": "double",
    "total_mem_mb_avg": "double",
}
