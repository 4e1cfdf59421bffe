"""Plans that matter at scale: no cross joins, no Python rows, pruned scans."""

import contextlib
import io
import re

import pytest

from fleetstream.operators import quality, windows
from fleetstream.plans import catalog, run_report, views
from fleetstream.plans.views import HOUR_MS

DIRECTORY = "/root/testdata/sf0.001"
SLOW_TO_BUILD = {name for name in catalog.QUERIES if name.startswith("stream_")}


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW_TO_BUILD))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(catalog.QUERIES[name](spark, DIRECTORY))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_late_test_neither_sorts_nor_shuffles_events(spark):
    text = plan(windows.mark_late(views.telemetry(spark, DIRECTORY), HOUR_MS))
    assert "BroadcastHashJoin" in text
    # Only the index, a row per window, is exchanged or sorted for its own scan.
    moved = re.findall(r"\) (?:Exchange|Sort)\nInput \[\d+\]: \[(.*?)\]", text)
    assert moved and not any("t_emit" in columns or "seq#" in columns for columns in moved)


def test_window_scan_reads_needed_columns(spark):
    text = plan(windows.late_counts(views.telemetry(spark, DIRECTORY), HOUR_MS))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_aggregations_combine_before_the_shuffle(spark):
    events = views.telemetry(spark, DIRECTORY)
    for df in (
        windows.windows(events, HOUR_MS, flush=True),
        quality.duplicate_summary(events),
        run_report.file_facts(views.run_lines_of(views.run_orders(spark, DIRECTORY))),
    ):
        text = plan(df)
        assert "partial_" in text and "SortAggregate" not in text


def test_top_keys_do_not_sort_everything(spark):
    text = plan(catalog.first_duplicates(spark, DIRECTORY))
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_timeline_orders_the_rows_once(spark):
    df = catalog.replay_timeline(spark, DIRECTORY)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    # The rows by session and bucket, and the totals of the buckets by session.
    assert len(re.findall(r"Exchange hashpartitioning", final)) - final.count("ReusedExchange") <= 4


def test_rolling_percentile_keeps_no_list_per_row(spark):
    text = plan(catalog.rolling_p95(spark, DIRECTORY))
    assert "collect_list" not in text and "array_sort" not in text and "MapInArrow" in text
    # The batches are dealt once for it, by block.
    assert len(re.findall(r"hashpartitioning\(__block", text)) == 1
