import pytest
from pyspark.sql import functions as F

from fleetstream.functions import loglines, scalars, topics


def values(spark, texts, expression, schema="v string"):
    df = spark.createDataFrame([(t,) for t in texts], schema)
    return [row[0] for row in df.select(expression(F.col("v"))).collect()]


def test_multi_value_max(spark):
    cells = ["84/84/89/89", "84", "", "a/b", "1/x/3", "NaN/2", None, "  ", " 5 ", "1f", "1.5d", "x", "-3/-4", "1e2/7"]
    assert values(spark, cells, scalars.multi_value_max) == [
        89.0, 84.0, 0.0, 0.0, 3.0, 2.0, 0.0, 0.0, 5.0, None, None, None, -3.0, 100.0,
    ]


def test_multi_value_max_strict_raises(spark):
    with pytest.raises(Exception, match="not a number"):
        values(spark, ["abc"], lambda c: scalars.multi_value_max(c, strict=True))


def test_memory(spark):
    texts = ["1GiB / x", "512MiB / x", "100KiB / x", "junk", "7B / 1GiB", "3kB / 1", "12MiB", None]
    found = values(spark, texts, scalars.memory_mb)
    assert [round(v, 9) if v is not None else None for v in found] == [1024.0, 512.0, 0.1, 0.0, 7e-6, 0.0, 12.0, 0.0]


def test_percent(spark):
    assert values(spark, ["83.1%", "", None, "abc%"], scalars.percent) == [83.1, 0.0, 0.0, None]


def test_mask_password(spark):
    urls = ["postgres://iot:pw@h:5432/iot", "postgres://h:5432/iot", "a://u:p@h/x:y@z"]
    assert values(spark, urls, scalars.mask_password) == [
        "postgres://iot:***@h:5432/iot", "postgres://h:5432/iot", "a://u:***@h/x:y@z",
    ]


def test_rounding_follows_the_exact_value(spark):
    numbers = [0.125, 0.375, 2.675, 0.25, 1234.565, -0.125]
    found = values(spark, numbers, lambda c: scalars.rounded_even(c, 2), "v double")
    assert found == [round(n, 2) for n in numbers]


def test_whole_number_text(spark):
    assert values(spark, [3.0, 3.5, None], scalars.whole_number_text, "v double") == ["3", "3.5", "n/a"]


def test_topic_filters(spark):
    names = ["iot/telemetry", "iot/telemetry/5-1", "iot/telemetry/a/b", "iot/telemetryx", "iot.telemetry/1", "x"]
    matches = lambda f: values(spark, names, lambda c: topics.topic_matches(c, f))
    assert matches("iot/telemetry/#") == [True, True, True, False, False, False]
    assert matches("iot/+/+") == [False, True, False, False, False, False]
    assert matches("#") == [True] * 6
    with pytest.raises(ValueError):
        topics.topic_pattern("a/#/b")


def test_run_id_parts(spark):
    ids = ["scenario-A-kafka-1000-acksall", "scenario-B-mqtt-20260614-152243", "other", "scenario-D-kafka"]
    for part, expected in {
        "scenario": ["A", "B", None, "D"],
        "broker": ["kafka", "mqtt", None, "kafka"],
        "started": [None, "20260614-152243", None, None],
        "num_devices": ["1000", None, None, None],
        "level": ["acksall", None, None, None],
    }.items():
        assert values(spark, ids, lambda c, part=part: loglines.run_id_part(c, part)) == expected


def test_normalise_level(spark):
    rows = [("mqtt", "QoS2"), ("kafka", "qos2"), ("kafka", "acksAll"), ("mqtt", "all"), ("mqtt", "1"), ("kafka", "acks0"), ("x", "0"), ("mqtt", ""), ("mqtt", "9")]
    df = spark.createDataFrame(rows, "b string, l string")
    found = [r[0] for r in df.select(loglines.normalise_level(F.col("b"), F.col("l"))).collect()]
    assert found == ["2", None, "all", None, "1", "0", None, "", None]


def test_metric_lines(spark):
    lines = ["a 1", "# c", 'b{le="0.05"} 3', "a 2", "z q", "", "n 1d", "i +Inf", "single", "\ta 4\t"]
    names = values(spark, lines, loglines.metric_name)
    amounts = values(spark, lines, loglines.metric_value)
    kept = {}
    for name, amount in zip(names, amounts):
        if name is not None and amount is not None:
            kept[name] = amount
    assert kept == {"a": 4.0, 'b{le="0.05"}': 3.0, "i": float("inf")}


def test_clock(spark):
    found = values(spark, ["10:00:07", "bad"], lambda c: scalars.clock_epoch_s(F.lit("20240102"), c))
    assert found == [1704189607, None]
