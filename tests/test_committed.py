"""Committed batches: what readers see, replays, races and compaction."""

import pytest
from pyspark.sql import functions as F

from fleetstream.plans import views
from fleetstream.streaming import committed

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture
def messages(spark):
    return views.as_messages(views.event_text(spark, DIRECTORY))


def part(messages, i, n=4):
    return messages.where(F.col("seq") % n == i)


def good(df):
    return df.where("seq % 6 < 3").count()


def test_readers_see_committed_batches_only(spark, tmp_path, messages):
    root = str(tmp_path / "t")
    assert committed.telemetry(spark, root).count() == 0
    committed.committed_writer(root)(part(messages, 0), 0)

    def lost(batch_id):
        assert committed.telemetry(spark, root).count() == good(part(messages, 0))
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        committed.committed_writer(root, lost)(part(messages, 1), 1)
    assert committed.telemetry(spark, root).count() == good(part(messages, 0))
    assert len(committed.CommitLog(spark, root).attempts()) == 2
    # The replay leaves no file of the lost attempt.
    committed.committed_writer(root)(part(messages, 1), 1)
    log = committed.CommitLog(spark, root)
    assert sorted(log.attempts()) == sorted(log.live()) and len(log.live()) == 2
    both = messages.where("seq % 4 < 2")
    assert committed.telemetry(spark, root).count() == good(both)
    assert committed.rejects(spark, root).count() == both.count() - good(both)
    counts = [tuple(r) for r in committed.batch_counts(spark, root).orderBy("batch_id").collect()]
    assert counts == [
        (i, part(messages, i).count(), good(part(messages, i)), part(messages, i).count() - good(part(messages, i))) for i in (0, 1)
    ]


def test_a_committed_batch_is_not_written_again(spark, tmp_path, messages):
    root = str(tmp_path / "t")
    write = committed.committed_writer(root)
    write(part(messages, 0), 0)
    before = committed.CommitLog(spark, root).live()
    write(part(messages, 0), 0)
    assert committed.CommitLog(spark, root).live() == before
    committed.compact(spark, root)
    write(part(messages, 0), 0)
    assert committed.telemetry(spark, root).count() == good(part(messages, 0))


def test_two_committers_take_two_versions(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    log = committed.CommitLog(spark, root)
    assert log._published(1, {"add": "a", "batch": 0}, False)
    assert not log._published(1, {"add": "b", "batch": 1}, False)
    # The slower one sees an old listing first and then takes the next version.
    answers = [[], log.versions()]
    monkeypatch.setattr(log, "versions", lambda: answers.pop(0))
    assert log.append("b", 1, {}) == 2
    monkeypatch.undo()
    assert log.live() == ["a", "b"] and not [n for n in log._names("log") if not n.endswith(".json")]


def test_compaction_is_read_and_keeps_later_batches(spark, tmp_path, messages, monkeypatch):
    root = str(tmp_path / "t")
    write = committed.committed_writer(root)
    write(part(messages, 0), 0)
    write(part(messages, 1), 1)
    planned = committed.telemetry(spark, root)
    expected = {r.payload for r in planned.collect()}
    commit = committed.CommitLog.commit

    def with_another_batch(self, body, snapshot=False):
        if snapshot:
            monkeypatch.undo()
            write(part(messages, 2), 2)
        return commit(self, body, snapshot)

    monkeypatch.setattr(committed.CommitLog, "commit", with_another_batch)
    assert committed.compact(spark, root) == 4
    log = committed.CommitLog(spark, root)
    live = log.live()
    assert len(live) == 2 and live[0].startswith("compacted-") and live[1].startswith(f"{2:020d}-")
    assert [c.version for c in log.since_snapshot()] == [4] and log.has_batch(2) and not log.has_batch(3)
    # A reader that planned before the compaction still finds its files.
    assert {r.payload for r in planned.collect()} == expected
    assert committed.telemetry(spark, root).count() == good(messages.where("seq % 4 < 3"))
    assert len(committed.remove_superseded(spark, root)) == 2
    write(part(messages, 3), 3)
    assert committed.telemetry(spark, root).count() == good(messages)
    assert committed.batch_counts(spark, root).count() == 4


def test_a_batch_without_rows(spark, tmp_path, messages):
    root = str(tmp_path / "t")
    committed.committed_writer(root)(messages.where("false"), 0)
    assert committed.telemetry(spark, root).count() == 0
    assert tuple(committed.batch_counts(spark, root).first()) == (0, 0, 0, 0)
    committed.compact(spark, root)
    assert committed.telemetry(spark, root).count() == 0
