import json

import pytest
from pyspark.sql import functions as F

from fleetstream.functions.scalars import event_json
from fleetstream.operators import decode, persist
from fleetstream.schemas import PERSISTED_FIELDS
from fleetstream.sources import messages as source

GOOD = {
    "device_id": "17-3", "pilot_index": 17, "replica": 3, "sessionTime": 640.25, "frameIdentifier": 90071,
    "speed": 211.75, "engineTemperature": 61.5, "tyresSurfaceTemperature": 49.0, "worldPositionX": 18.5,
    "worldPositionY": 2.125, "worldPositionZ": -36.75, "t_emit": 1733055100877,
}


def messages(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "seq bigint, text string")
    return df.select(F.lit(None).cast("binary").alias("key"), F.col("text").cast("binary").alias("value"), "seq")


def changed(**fields):
    event = GOOD | fields
    return json.dumps({k: v for k, v in event.items() if v is not ...})


def reasons(spark, texts):
    rows = decode.classified(messages(spark, texts)).orderBy("seq").collect()
    return [r.reject_reason for r in rows]


def test_rejects(spark):
    cases = {
        changed(): None,
        changed(t_emit="5"): decode.MISSING_REQUIRED,
        changed(t_emit=...): decode.MISSING_REQUIRED,
        changed(t_emit=None): decode.MISSING_REQUIRED,
        changed(device_id=7): decode.MISSING_REQUIRED,
        changed(device_id=...): decode.MISSING_REQUIRED,
        "nope": decode.INVALID_JSON,
        "": decode.INVALID_JSON,
        "null": decode.MISSING_REQUIRED,
        "[1]": decode.MISSING_REQUIRED,
        changed() + " x": decode.INVALID_JSON,
        changed() + changed(): decode.INVALID_JSON,
        changed() + ",1": decode.INVALID_JSON,
        changed()[:-7]: decode.INVALID_JSON,
        "  " + changed() + " \n": None,
        changed(speed="fast"): decode.BAD_FIELD,
        changed(t_emit=9e15 + 2): decode.BAD_FIELD,
        changed(t_emit=5.5): None,
        changed(replica=...): None,
        changed(replica=None): None,
        changed(note={"device_id": "x"}): None,
        changed(device_id=7, note={"device_id": "x"}): decode.MISSING_REQUIRED,
        changed(device_id=7, note='"device_id":"x"'): decode.MISSING_REQUIRED,
        changed()[:-1] + ',"device_id":9}': decode.MISSING_REQUIRED,
        changed()[:-1] + ',"device_id":"last"}': None,
    }
    assert reasons(spark, list(cases)) == list(cases.values())


def test_accepted_values(spark):
    texts = [changed(), changed(replica=...), changed(t_emit=1733055100877.25, extra=[1, {"a": 2}])]
    rows = decode.accepted(decode.classified(messages(spark, texts))).orderBy("seq").collect()
    for name, value in GOOD.items():
        assert rows[0][name] == value
    assert [r.replica for r in rows] == [3, 0, 3]
    assert rows[2].t_emit == 1733055100877 and rows[2].ts.microsecond == 877250
    assert [json.loads(r.payload) for r in rows] == [json.loads(t) for t in texts]


def test_excerpt(spark):
    row = decode.rejected(decode.classified(messages(spark, ["x" * 500]))).first()
    assert row.excerpt == "x" * 200


def test_strict(spark):
    cases = [
        (changed(), 61.5), (changed(engineTemperature=...), 0.0), (changed(engineTemperature=None), None),
        (changed(engineTemperature="x"), None), (changed(engineTemperature="2.5"), None),
        (changed(engineTemperature="NaN"), None), (changed(t_emit=1.0), None), (changed(t_emit="1"), None),
        (changed(t_emit=...), None), (changed(engineTemperature=7), 7.0), (changed(device_id=7), 61.5),
        ("nope", None), (changed() + "x", None), (changed(note={"a": 1}), 61.5), (changed(t_emit=2**70), None),
    ]
    rows = decode.decode_strict(messages(spark, [text for text, _ in cases])).collect()
    found = {r.seq: r.engineTemperature for r in rows}
    assert found == {i: v for i, (_, v) in enumerate(cases) if v is not None}


def test_round_trip_through_messages(spark):
    events = decode.accepted(decode.classified(messages(spark, [changed()])))
    sent = source.keyed_messages(events).first()
    assert sent.key == "17-3" and json.loads(sent.value) == GOOD
    assert source.device_messages(events).first().topic == "iot/telemetry/17-3"
    assert events.select(event_json()).count() == 1


def test_persisted_rows_and_layout(spark, tmp_path):
    events = decode.accepted(decode.classified(messages(spark, [changed(), changed(t_emit=1733155100000)])))
    rows = persist.persisted_rows(events, F.timestamp_millis(F.lit(1733055101877)))
    assert rows.columns == list(PERSISTED_FIELDS)
    for _ in range(2):
        persist.append_batch(rows, str(tmp_path / "batch"))
    table = spark.read.parquet(str(tmp_path / "batch"))
    assert table.count() == 2 and table.select("event_date").distinct().count() == 2
    persist.compact(rows, str(tmp_path / "compact"))
    assert spark.read.parquet(str(tmp_path / "compact")).count() == 2
    lag = persist.row_lag(rows.where("t_emit < timestamp'2024-12-02'")).first()
    assert (lag.rows, lag.max_lag_ms, lag.p95_lag_ms, lag.mean_lag_ms) == (1, 1000, 1000, 1000.0)


def test_arrival_order_of_kafka_rows(spark):
    rows = [("2024-01-01 00:00:00.001", 1, 5), ("2024-01-01 00:00:00.001", 0, 9), ("2024-01-01 00:00:00", 3, 7)]
    df = spark.createDataFrame(rows, "t string, partition int, offset bigint").withColumn("timestamp", F.to_timestamp("t"))
    ordered = source.with_arrival(df).orderBy("seq").collect()
    assert [(r.partition, r.offset) for r in ordered] == [(3, 7), (0, 9), (1, 5)]


def test_subscription(spark):
    df = spark.createDataFrame([("iot/telemetry/1",), ("other/1",)], "topic string")
    assert [r.topic for r in source.subscribed(df, "iot/telemetry/#").collect()] == ["iot/telemetry/1"]


def test_csv_by_name(spark, tmp_path):
    from fleetstream.sources.telemetry_csv import read_telemetry_csv, telemetry_csv_rejects

    header = "worldPositionZ,extra,tyresSurfaceTemperature,speed,sessionTime,frameIdentifier,pilot_index,worldPositionX,worldPositionY,engineTemperature"
    lines = [header, "1,x, 84/85/83/82 ,80.5,0.25,7,3,2,-3,90", ",,,,,,,,,", "1,x,bad,1,1,1,1,1,1,1", "1,x,5,1,1,1,1,1,1,9f"]
    path = tmp_path / "data.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = read_telemetry_csv(spark, str(path)).collect()
    rejects = telemetry_csv_rejects(spark, str(path)).collect()
    assert [(r.bad_column, r.tyresSurfaceTemperature) for r in rejects] == [("tyresSurfaceTemperature", "bad"), ("engineTemperature", "5")]
    assert [(r.tyresSurfaceTemperature, r.engineTemperature, r.frameIdentifier) for r in rows] == [(85.0, 90.0, 7), (0.0, None, None)]
    with pytest.raises(Exception, match="not a number"):
        read_telemetry_csv(spark, str(path), strict=True).collect()
    (tmp_path / "short.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks columns"):
        read_telemetry_csv(spark, str(tmp_path / "short.csv"))
