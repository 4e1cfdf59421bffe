"""Alert latency on a stream when run ids, starts and rows are many."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetstream.functions import loglines
from fleetstream.operators import latency
from fleetstream.plans import catalog
from fleetstream.streaming import latency as stream_latency

ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
DAY, NOON, NEXT = datetime(2024, 1, 2), datetime(2024, 1, 2, 12), datetime(2024, 1, 3)
COPIES = [(3 + 1_000_000 * i, 3, DAY) for i in range(6)]
ODD = [
    (3, 3, DAY), (1_000_003, 5, DAY), (2_000_003, 7, NOON),  # one id, two times
    (4, 3, DAY), (4, 3, NEXT), (4, 5, None), (8, 7, None),  # an id without a day in it
    (7, 2, DAY), (7, 2, DAY), (11, 6, None), (None, 3, DAY), (15, None, NEXT),
]


def landed_rows(spark, monkeypatch, path):
    """What ``stream_alert_latency`` lands, without the run after all others."""
    told = []
    monkeypatch.setattr(catalog, "in_slices", lambda spark, rows, run, **how: told.append(rows))
    monkeypatch.setattr(catalog, "fresh_path", lambda spark, name: str(path / "orders.parquet"))
    catalog.stream_alert_latency(spark, str(path))
    return told[0].where("run_id <> 'after all' and seq is not null")


def joined_rows(spark, path):
    """Starts and lines at the days of all runs of the same id, found by a join."""
    runs, lines = catalog.runs_and_lines(spark, str(path))
    days = runs.select("run_id", "day_s")
    begun = catalog.injection_starts(runs).join(days, "run_id").withColumn("at", F.timestamp_seconds("started_s"))
    logs = lines.where(F.col("file_name").isin("ingestion.log", "analytics.log")).join(days, "run_id")
    told = logs.withColumn("at", F.timestamp_seconds(F.col("day_s") + 36_000 + 10 * F.col("line_no")))
    return begun.unionByName(told, allowMissingColumns=True).withColumn("seq", F.col("day_s")).where("seq is not null")


def texts(rows):
    return sorted(map(str, rows.collect()))


@pytest.mark.parametrize("orders", [COPIES, ODD])
def test_rows_landed_are_those_of_a_join_by_id(spark, tmp_path, monkeypatch, orders):
    spark.createDataFrame(orders, ORDERS).write.parquet(str(tmp_path / "orders.parquet"))
    landed = landed_rows(spark, monkeypatch, tmp_path)
    joined = joined_rows(spark, tmp_path).select(landed.columns)
    assert texts(landed.distinct()) == texts(joined.distinct())


def test_runs_of_one_id_are_landed_once_each(spark, tmp_path, monkeypatch):
    spark.createDataFrame(COPIES, ORDERS).write.parquet(str(tmp_path / "orders.parquet"))
    _, lines = catalog.runs_and_lines(spark, str(tmp_path))
    assert lines.select("run_id").distinct().count() == 1
    landed = landed_rows(spark, monkeypatch, tmp_path)
    logs = lines.where(F.col("file_name").isin("ingestion.log", "analytics.log"))
    assert landed.count() == len(COPIES) + logs.count()


def test_starts_told_again_do_not_meet_the_marks_again(spark, tmp_path):
    mark = f"[x WRN] {loglines.ALERT_MARK}1704153610000 max_engine_temp=95 y"
    at = lambda s: F.timestamp_seconds(F.lit(1_704_153_600) + s)
    lines = spark.range(50).select(
        F.lit("a").alias("run_id"), F.lit("analytics.log").alias("file_name"),
        F.col("id").alias("line_no"), F.lit(mark).alias("value"), at(F.col("id")).alias("at"),
    )
    starts = spark.range(40).select(
        F.lit("a").alias("run_id"), F.lit("20240102").alias("run_date"),
        F.lit(1_704_153_600).cast("bigint").alias("started_s"), at(F.lit(0)).alias("started_at"),
    )
    root, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for part in (lines, lines.limit(1).withColumn("run_id", F.lit("end")).withColumn("at", at(F.lit(9000)))):
        part.write.mode("append").parquet(str(tmp_path / "lines"))
    starts.unionByName(
        starts.limit(1).withColumn("run_id", F.lit("end")).withColumn("started_at", at(F.lit(9000)))
    ).write.parquet(str(tmp_path / "starts"))
    found = stream_latency.alert_latency_stream(
        spark.readStream.schema(lines.schema).parquet(str(tmp_path / "lines")),
        spark.readStream.schema(starts.schema).parquet(str(tmp_path / "starts")),
    )
    query = catalog.parquet_writer(found, root, checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    joins = [s for p in query.recentProgress for s in p.stateOperators if s.operatorName == "symmetricHashJoin"]
    # Both runs' marks and one start of each.
    assert max(s.numRowsUpdated for s in joins) == 50 + 1 + 2
    expected = latency.alert_latency(lines, starts.distinct())
    assert texts(spark.read.parquet(root)) == texts(expected)


def test_slices_grow_in_number_and_not_in_rows(spark):
    rows = spark.range(100).withColumnRenamed("id", "seq")
    for most, slices in [(None, 3), (1000, 3), (20, 5)]:
        told = []
        catalog.in_slices(spark, rows, lambda path: told.append(spark.read.parquet(path).count()), most=most)
        assert len(told) == slices and told[-1] == 100
        if most == 20:
            assert told == [20, 40, 60, 80, 100]


def test_short_state_bounds_partitions_and_puts_back(spark):
    partitions, versions = "spark.sql.shuffle.partitions", "spark.sql.streaming.maxBatchesToRetainInMemory"
    before = spark.conf.get(partitions)
    cores = spark.sparkContext.defaultParallelism
    try:
        for given, used in [(1000 * cores, 2 * cores), (1, 1)]:
            spark.conf.set(partitions, str(given))
            with stream_latency.short_state(spark):
                assert int(spark.conf.get(partitions)) == used and spark.conf.get(versions) == "1"
            assert int(spark.conf.get(partitions)) == given and spark.conf.get(versions) == "2"
    finally:
        spark.conf.set(partitions, before)
