import math
import random

import pytest
from pyspark.sql import functions as F

from fleetstream.operators import batches, lookup, ranks
from fleetstream.operators.scan import Running, row_rank, running


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
def test_running_matches_a_loop(spark, reverse, grouped):
    rng = random.Random(7)
    rows = [(rng.choice("aab"), order, rng.randrange(100)) for order in rng.sample(range(-500, 5000), 400)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint").repartition(4)
    kinds = ["sum", "max", "min", "last"]
    found = running(
        df, "o", [Running(k, k, "v") for k in kinds], ["g"] if grouped else [], reverse=reverse, bits=5
    ).collect()
    assert len(found) == len(rows)
    for row in found:
        before = sorted(
            (o, v)
            for g, o, v in rows
            if (not grouped or g == row.g) and (o > row.o if reverse else o < row.o)
        )
        seen = [v for _, v in before]
        if not seen:
            assert [row["sum"], row["max"], row["min"], row["last"]] == [None] * 4
            continue
        assert [row["sum"], row["max"], row["min"]] == [sum(seen), max(seen), min(seen)]
        assert row["last"] == (seen[0] if reverse else seen[-1])


def test_row_rank(spark):
    df = spark.range(50).withColumn("o", F.col("id") * 97)
    assert {r.id: r.row_rank for r in row_rank(df, "o", bits=4).collect()} == {i: i for i in range(50)}


@pytest.mark.parametrize("n, expected", [(40, 39), (41, 39), (1000, 951), (1, 1)])
def test_index_percentile(spark, n, expected):
    df = spark.range(1, n + 1)
    assert ranks.index_percentile(df, "id").first().percentile == expected


def test_index_percentile_in_groups_with_hot_group_and_negatives(spark):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(5)}", rng.randrange(-300_000, 300_000)) for _ in range(900)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    found = {r.g: r.percentile for r in ranks.index_percentile(df, "v", ["g"]).collect()}
    for group in {g for g, _ in rows}:
        ordered = sorted(v for g, v in rows if g == group)
        assert found[group] == ordered[min(math.floor(len(ordered) * 0.95), len(ordered) - 1)]


def test_empty_percentile(spark):
    assert ranks.index_percentile(spark.range(0), "id").first().percentile == 0


def test_one_tick_is_cut_by_size(spark):
    events = spark.range(1200).select(
        F.col("id").alias("seq"), F.lit(5).cast("bigint").alias("arrival_ms"), F.lit(0).cast("bigint").alias("t_emit")
    )
    found = batches.flush_batches(events).orderBy("batch_seq").collect()
    assert [(r.batch_seq, r.size) for r in found] == [(0, 500), (1, 500), (2, 200)]
    assert [r.flush_ms for r in found] == [5, 5, 205]


@pytest.mark.parametrize("limit", [500_000, 3])
def test_batches_match_a_loop(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "MAX_SMALL_BYTES", limit * 100)
    rng = random.Random(5)
    arrivals = sorted(rng.randrange(3000) for _ in range(400))
    events = spark.createDataFrame(
        [(i, a, a - 7) for i, a in enumerate(arrivals)], "seq bigint, arrival_ms bigint, t_emit bigint"
    ).repartition(3)
    found = batches.flush_batches(events, batch_size=9, t0_ms=0).orderBy("batch_seq").collect()
    expected, current = [], []
    for i, a in enumerate(arrivals):
        if current and arrivals[current[0]] // 200 != a // 200:
            expected.append(len(current))
            current = []
        current.append(i)
        if len(current) == 9:
            expected.append(9)
            current = []
    if current:
        expected.append(len(current))
    assert [r.size for r in found] == expected
    assert [r.batch_seq for r in found] == list(range(len(expected)))


def test_rolling_percentile_across_blocks(spark):
    rng = random.Random(9)
    lags = [rng.randrange(1000) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(lags)), "batch_seq bigint, lag_ms bigint").repartition(4)
    found = batches.rolling_percentile(df, rows=40, block=64).orderBy("batch_seq").collect()
    assert len(found) == 300
    for i, row in enumerate(found):
        history = sorted(lags[max(0, i - 39) : i + 1])
        assert row.p95_lag_ms == history[min(math.floor(len(history) * 0.95), len(history) - 1)]


def test_null_groups_are_groups(spark):
    rng = random.Random(11)
    rows = [(rng.choice(["a", None]), i, rng.randrange(100)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, o bigint, v bigint")
    found = {r.g: r.percentile for r in ranks.index_percentile(df, "v", ["g"]).collect()}
    for group in ("a", None):
        ordered = sorted(v for g, _, v in rows if g == group)
        assert found[group] == ordered[min(math.floor(len(ordered) * 0.95), len(ordered) - 1)]
    summed = running(df, "o", [Running("s", "sum", "v")], ["g"], bits=4).collect()
    for r in summed:
        before = [v for g, o, v in rows if g == r.g and o < r.o]
        assert r.s == (sum(before) if before else None)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_index_joins_null_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(lookup, "MAX_SMALL_BYTES", limit)
    monkeypatch.setattr(lookup, "HOT_SHARE", 0.3)
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, v bigint")
    counts = df.groupBy("k").count().withColumnRenamed("count", "n").withColumn("m", F.col("n") + 1)
    joined = lookup.Index.of(counts, "k", "n").join(df, ["m"])
    assert sorted((r.v, r.m) for r in joined.collect()) == [(1, 3), (2, 3), (3, 2), (4, 2)]


def test_ranks_by_a_struct(spark):
    df = spark.createDataFrame([(i // 3, i % 3, i) for i in range(60)], "a bigint, b int, want bigint")
    ranked = row_rank(df.withColumn("o", F.struct("a", "b")), "o", bits=2)
    assert all(r.row_rank == r.want for r in ranked.collect())


@pytest.mark.parametrize("kind", ["bigint", "double"])
def test_rolling_percentile_with_missing_values_in_groups(spark, kind):
    rng = random.Random(12)

    def value():
        return rng.choice([None, float("nan") if kind == "double" else None, *range(9)])

    rows = [(g, i, None if (v := value()) is None else float(v) if kind == "double" else v) for g in ("a", None) for i in range(150)]
    df = spark.createDataFrame(rows, f"g string, batch_seq bigint, lag_ms {kind}").repartition(3)
    found = {(r.g, r.batch_seq): r.p95_lag_ms for r in batches.rolling_percentile(df, group=["g"], rows=20, block=32).collect()}
    assert len(found) == 300
    for g in ("a", None):
        values = [v for h, _, v in rows if h == g]
        for i in range(150):
            history = sorted((v for v in values[max(0, i - 19) : i + 1] if v is not None), key=lambda v: (v != v, v))
            expected = history[min(math.floor(len(history) * 0.95), len(history) - 1)] if history else None
            assert repr(found[g, i]) == repr(expected)
