import random

import pytest
from pyspark.sql import functions as F

from fleetstream.operators import lookup, windows

SCHEMA = "seq bigint, arrival_ms bigint, t_emit bigint, engineTemperature float, tyresSurfaceTemperature float"


def events(spark, times, temperatures=None):
    temperatures = temperatures or [60.0] * len(times)
    rows = [(i, 100_000 + i, t, float(v), float(v) / 2) for i, (t, v) in enumerate(zip(times, temperatures))]
    return spark.createDataFrame(rows, SCHEMA)


def model(rows, size):
    """Event-by-event reading of the window rules."""
    current, late, state, closed = None, [], {}, []
    for seq, arrival, t, engine, tyre in rows:
        key = int(t / size)
        if current is not None and key < current:
            late.append(seq)
            continue
        if current is not None and key > current:
            for k in sorted(k for k in state if k < key):
                closed.append((k, arrival, state.pop(k)))
        current = key if current is None else max(current, key)
        state.setdefault(key, []).append((t, engine, tyre))
    return late, closed, state


def test_known_arrivals(spark):
    df = events(spark, [1000, 12000, 2000, 3000, 13000, 25000, 14000, 41000])
    counts = windows.late_counts(df).first()
    assert (counts.accepted, counts.late) == (5, 3)
    closed = windows.exact_windows(df).orderBy("window_start").collect()
    assert [(r.window_start, r["count"]) for r in closed] == [(0, 1), (10000, 2), (20000, 1)]
    flushed = windows.exact_windows(df, flush_at_ms=200_000).orderBy("window_start").collect()
    assert (flushed[-1].window_start, flushed[-1].closed_at_ms) == (40000, 200_000)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [500_000, 5])
def test_against_event_by_event_model(spark, monkeypatch, seed, limit):
    # A limit of 5 keys takes the path for an index too large to broadcast.
    monkeypatch.setattr(lookup, "MAX_SMALL_BYTES", limit * 100)
    monkeypatch.setattr(lookup, "HOT_SHARE", 0.05)
    rng = random.Random(seed)
    # A third of the events fall into one window.
    times = [
        50_000 + rng.randrange(10_000) if rng.random() < 0.34 and i > 60 else max(0, i * 700 - rng.randrange(25_000))
        for i in range(300)
    ]
    temperatures = [rng.uniform(20, 90) for _ in times]
    df = events(spark, times, temperatures).repartition(3)
    rows = sorted(tuple(r) for r in df.collect())
    late, closed, _ = model(rows, 10_000)
    marked = windows.mark_late(df)
    assert sorted(r.seq for r in marked.where("is_late").collect()) == late
    found = {r.window_start: r for r in windows.exact_windows(df).collect()}
    assert len(found) == len(closed)
    for key, arrival, members in closed:
        row = found[key * 10_000]
        assert (row["count"], row.closed_at_ms) == (len(members), arrival)
        assert row.mean_engine_temp == pytest.approx(sum(m[1] for m in members) / len(members))
        assert row.e2e_latency_ms == arrival - min(m[0] for m in members)


def test_maxima_truncate_and_never_go_negative(spark):
    df = events(spark, [0, 1, 10_000, 20_000, 30_000, 40_000], [92.1, 92.05, -3, 0.4, float("nan"), 1])
    rows = windows.windows(df, flush=True).orderBy("window_start").collect()
    assert [r.max_engine_temp for r in rows] == [92, 0, 0, 0, 1]
    assert [r.window_start for r in windows.alerts(windows.windows(df)).collect()] == [0]


def test_threshold_is_strict_and_empty_windows_do_not_appear(spark):
    df = events(spark, [0, 1, 50_000, 90_000], [40, 60, 50.1, 1])
    closed = windows.windows(df)
    assert sorted(r.window_start for r in closed.collect()) == [0, 50_000]
    assert [r.window_start for r in windows.alerts(closed).collect()] == [50_000]


def test_histogram_and_lines(spark):
    rows = [(0, 10_000, 3, 51.125, 60.0, 99, 88, 0, 9, 50 * i) for i in range(4)]
    closed = spark.createDataFrame(
        rows,
        "window_start bigint, window_end bigint, count bigint, mean_engine_temp double, mean_tyre_temp double, "
        "max_engine_temp bigint, max_tyre_temp bigint, earliest_t_emit bigint, latest_t_emit bigint, e2e_latency_ms bigint",
    )
    found = {r.le: r.observations for r in windows.latency_histogram(closed).collect()}
    assert (found["0.05"], found["0.1"], found["0.25"], found["+Inf"]) == (2, 3, 4, 4)
    line = windows.alert_lines(closed).first().line
    assert line == (
        "ALERT window_start=0 window_end=10000 count=3 mean_engine_temp=51.12 mean_tyre_temp=60.00 "
        "max_engine_temp=99 max_tyre_temp=88 e2e_latency_ms=0"
    )


def test_decimal_arrival_order(spark):
    df = events(spark, [1000, 12000, 2000]).withColumn("seq", F.col("seq").cast("decimal(38,0)"))
    counts = windows.late_counts(df).first()
    assert (counts.accepted, counts.late) == (2, 1)
