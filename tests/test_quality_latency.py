import pytest

from fleetstream.operators import latency, quality


def test_duplicates(spark):
    df = spark.createDataFrame([(v,) for v in [5, 3, 3, 9, 9, 9, 1]], "id bigint").repartition(3)
    assert tuple(quality.duplicate_summary(df, ["id"]).first()) == (7, 4, 3)
    assert [tuple(r) for r in quality.duplicate_keys(df, ["id"]).orderBy("id").collect()] == [(3, 2), (9, 3)]
    assert [r.id for r in quality.duplicate_keys(df, ["id"], n=1).collect()] == [3]
    assert quality.distinct_keys(df, ["id"]).count() == 4
    assert quality.approx_distinct(df, ["id"]).first().distinct == 4
    ends = quality.key_head_tail(df, "id", 2, 1).collect()
    assert sorted((r.part, r.id) for r in ends) == [("first", 1), ("first", 3), ("last", 9)]
    assert tuple(quality.duplicate_summary(df.limit(0), ["id"]).first()) == (0, 0, 0)


def test_delivery(spark):
    def stage(**counts):
        return spark.createDataFrame([(r, i) for r, n in counts.items() for i in range(n)], "run_id string, id bigint")

    expected = stage(a=4, b=2, c=3, d=5)
    observed = stage(a=4, b=4, d=3).unionByName(stage(a=3)).unionByName(stage(a=1))
    counts = quality.stage_counts({"expected": expected, "emitted": expected, "dropped": stage(d=2)}, observed, key=["id"])
    rows = {r.run_id: r for r in quality.delivery_report(counts).collect()}
    assert [rows[k].verdict for k in "abcd"] == ["delivered once", "delivered twice", "no observation", "unexpected"]
    assert (rows["b"].observed_ratio, rows["a"].received, rows["a"].emitted_ratio) == (2.0, None, 1.0)
    assert (rows["a"].observed_total, rows["a"].observed, rows["a"].observed_duplicates) == (8, 4, 4)
    assert (rows["c"].observed, rows["d"].dropped, rows["d"].observed_per_emitted) == (None, 2, 0.6)


def test_first_and_last_keys_by_arrival(spark):
    df = spark.createDataFrame([(9, 1), (3, 2), (7, 3), (1, 4)], "id bigint, arrival bigint")
    ends = quality.key_head_tail(df, "id", 2, 1, order="arrival").collect()
    assert sorted((r.part, r.id) for r in ends) == [("first", 3), ("first", 9), ("last", 1)]


def test_recovery(spark):
    polls = [("a", t, 5 if t < 23 else 6 + t) for t in range(1, 61)] + [("b", t, 7) for t in range(1, 61)] + [("b", 61, 9), ("c", 3, None)]
    baselines = spark.createDataFrame([("a", 5), ("b", 7), ("c", 1)], "run_id string, baseline bigint")
    df = spark.createDataFrame(polls, "run_id string, tick_s bigint, value bigint")
    found = {r.run_id: (r.recovery_s, r.recovery_timeout) for r in latency.recovery_time(df, baselines).collect()}
    assert found == {"a": (23, False), "b": (None, True), "c": (None, True)}


@pytest.fixture
def lines(spark):
    day = 1704153600  # 2024-01-02
    alert = lambda s, top: f"[x WRN] ALERT window_start={(day + s) * 1000} window_end=1 max_engine_temp={top} y"
    inject = "[10:00:05 WRN] INJECT_HIGH_TEMP: emitting"
    rows = [
        ("a", "ingestion.log", 3, inject), ("a", "ingestion.log", 9, inject.replace(":05", ":59")),
        ("a", "analytics.log", 1, alert(36000, 95)), ("a", "analytics.log", 2, alert(36010, 1500)), ("a", "analytics.log", 3, alert(36020, 1500)),
        ("b", "ingestion.log", 1, inject), ("b", "analytics.log", 5, alert(36000, 95)),
        ("c", "analytics.log", 1, "quiet"),
        ("e", "analytics.log", 1, alert(35990, 1500)), ("e", "ingestion.log", 1, inject),
    ]
    return spark.createDataFrame(rows, "run_id string, file_name string, line_no bigint, value string"), day


def test_alert_latency(spark, lines):
    df, day = lines
    starts = spark.createDataFrame([(r, "20240102", day + 35_980) for r in "abcde"], "run_id string, run_date string, started_s bigint")
    found = {r.run_id: (r.e2e_latency_s, r.measured) for r in latency.alert_latency(df, starts).collect()}
    assert found == {"a": (15, "inject"), "b": (20, "fallback"), "c": (None, "no alert"), "d": (None, "no alert"), "e": (-5, "inject")}
