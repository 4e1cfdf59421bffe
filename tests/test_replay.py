import pytest
from pyspark.sql import functions as F

from fleetstream.operators import lookup, replay
from fleetstream.operators.scan import row_rank


@pytest.mark.parametrize("n", [7, 20, 45, 100])
def test_fleet(spark, n):
    rows = replay.devices(spark, n).orderBy("device_number").collect()
    expected = []
    for pilot in range(min(n, 20)):
        replicas = 1 if n < 20 else n // 20 + (1 if pilot < n % 20 else 0)
        expected += [(pilot, r, f"{pilot}-{r}") for r in range(replicas)]
    assert [(r.pilot_index, r.replica, r.device_id) for r in rows] == expected


def test_empty_fleet_is_an_error(spark):
    with pytest.raises(ValueError):
        replay.devices(spark, 0)
    with pytest.raises(ValueError):
        replay.fan_out(spark.range(1), 0)
    with pytest.raises(Exception, match="at least one device"):
        replay.fan_out(spark.range(1), F.lit(0)).collect()


def test_large_fleets_are_expanded_in_chunks(spark, monkeypatch):
    fleets = spark.createDataFrame([("a", 45), ("b", 3), ("c", 30)], "f string, n int")
    whole = sorted(map(tuple, replay.fan_out(fleets, F.col("n")).collect()))
    monkeypatch.setattr(replay, "CHUNK", 7)
    assert sorted(map(tuple, replay.fan_out(fleets, F.col("n")).collect())) == whole
    assert len(whole) == 78
    assert replay.fan_out(spark.range(2), 20).count() == 40


def rows(spark, times):
    return spark.createDataFrame(
        [(i, "s", float(t), 50.0 + i) for i, t in enumerate(times)],
        "row_index bigint, session string, sessionTime float, engineTemperature float",
    )


def test_timeline(spark):
    found = replay.replay_timeline(rows(spark, [0, 0.5, 3, 1])).orderBy("row_index").collect()
    assert [r.wait_ms for r in found] == [0, 500, 1000, 0]
    assert [r.offset_ms for r in found] == [0, 500, 1500, 1500]


def test_duration_includes_the_row_that_reaches_it(spark):
    timeline = replay.replay_timeline(rows(spark, [1, 2, 4, 3, 9]))
    kept = replay.until_duration(timeline, duration_ms=3000, session="session")
    assert sorted(r.row_index for r in kept.collect()) == [0, 1, 2]
    from_zero = replay.replay_timeline(rows(spark, [0, 2, 4, 3, 9]))
    assert replay.until_duration(from_zero, duration_ms=3000, session="session").count() == 5
    assert replay.until_duration(timeline, duration_ms=0, session="session").count() == 5


def test_devices_replay_one_after_the_other(spark):
    found = replay.device_replay(rows(spark, [0.1, 0.5]), devices=3, duration_ms=10_000, t0_ms=1000, session="session")
    ordered = found.orderBy("device_number", "row_index").collect()
    assert [(r.device_id, r.t_emit) for r in ordered] == [
        ("0-0", 1100), ("0-0", 1500), ("1-0", 1600), ("1-0", 2000), ("2-0", 2100), ("2-0", 2500),
    ]


@pytest.mark.parametrize("chunk", [100_000, 2])
def test_cyclic_expansion(spark, monkeypatch, chunk):
    monkeypatch.setattr(replay, "CHUNK", chunk)
    indexed = row_rank(rows(spark, range(7)).drop("row_index").withColumn("o", F.col("sessionTime").cast("bigint")), "o", name="row_index")
    found = replay.cyclic_expand(indexed, devices=25, rate=300, duration_ms=100, t0_ms=0).orderBy("emission").collect()
    assert len(found) == 30
    for i, row in enumerate(found):
        assert (row.emission, row.row_index, row.t_emit) == (i, i % 7, i * 3333 // 1000)
    assert [r.device_id for r in found[25:]] == [r.device_id for r in found[:5]]
    assert [r.pilot_index for r in found[:6]] == [0, 0, 1, 1, 2, 2]


def test_at_least_one_emission():
    assert replay.emission_total(10, 1) == 1 and replay.emission_total(3, 1500) == 4


def test_critical_overlay(spark):
    expanded = replay.cyclic_expand(rows(spark, range(5)), devices=3, rate=100, duration_ms=200, t0_ms=1000)
    found = replay.overlay_critical(expanded, inject_at_ms=55, t0_ms=1000)
    critical = found.where("is_critical").orderBy("t_emit").collect()
    assert len(critical) == 100 and found.count() == 120
    assert {r.emission for r in critical} == {6} and {r.engineTemperature for r in critical} == {1500.0}
    assert [r.t_emit for r in critical] == [1060 + i for i in range(100)]
    assert replay.overlay_critical(expanded, inject_at_ms=10_000, t0_ms=1000).count() == 20


def test_large_index_joins_equal_small_ones(spark, monkeypatch):
    source = rows(spark, [1, 2, 4, 3, 9] * 20)
    small = {tuple(r) for r in replay.device_replay(source, devices=2, duration_ms=3000, t0_ms=0, session="session").collect()}
    monkeypatch.setattr(lookup, "MAX_SMALL_BYTES", 0)
    large = {tuple(r) for r in replay.device_replay(source, devices=2, duration_ms=3000, t0_ms=0, session="session").collect()}
    assert small == large and small


def test_timeline_over_buckets_equals_a_loop(spark, monkeypatch):
    import random

    monkeypatch.setattr(replay, "BUCKET_BITS", 2)
    rng = random.Random(9)
    data = [
        (i, rng.choice(["a", "b", None]), None if rng.random() < 0.2 else rng.randrange(0, 60) / 10)
        for i in rng.sample(range(500), 150)
    ]
    df = spark.createDataFrame(data, "row_index bigint, session string, sessionTime float")
    found = {r.row_index: r for r in replay.replay_timeline(df, session=["session"]).collect()}
    last, total = {}, {}
    for i, s, _ in sorted(data, key=lambda r: r[0]):
        time = found[i].session_ms
        wait = 0 if time is None else min(max(time - last.get(s, 0), 0), 1000)
        total[s] = total.get(s, 0) + wait
        last[s] = last.get(s, 0) if time is None else time
        assert (found[i].wait_ms, found[i].offset_ms) == (wait, total[s])
