"""A table of micro-batches that readers see whole or not at all.

A batch writes its files below ``data/attempt=<batch>-<unique>`` in one job and then commits
by renaming one small file into ``log``: ``<version>.json`` names the attempt, the batch and
what was observed while it was written.  Renaming never replaces a file, so two committers cannot
take one version; the second reads on and takes the next.  A reader lists the log, and nothing
else decides which files belong to the table.  A batch that is already committed is skipped
when it is replayed, and what an earlier attempt left is removed.

``compact`` rewrites the table as one attempt and commits a snapshot: the list of attempts that
make up the table from then on, batches committed meanwhile included.  Readers start at the
newest snapshot, so what they read of the log is bounded by the batches since.  Attempts that
are no longer listed stay until ``remove_superseded``, for readers that planned before.

A table belongs to one stream and its checkpoint: batch ids tell what has been committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fleetstream.operators.decode import classified, excerpt
from fleetstream.operators.persist import EVENT_DATE
from fleetstream.schemas import PERSISTED_FIELDS

OUTCOME, ATTEMPT = "outcome", "attempt"
ACCEPTED, REJECTED = "accepted", "rejected"
PLACE = {"topic": "string", "partition": "int", "offset": "bigint"}
REJECT_FIELDS = {"reject_reason": "string", "excerpt": "string"}
SCHEMA = ", ".join(
    f"{name} {kind}"
    for name, kind in (
        PERSISTED_FIELDS | PLACE | REJECT_FIELDS | {OUTCOME: "string", EVENT_DATE: "date", ATTEMPT: "string"}
    ).items()
)


@dataclass(frozen=True)
class Commit:
    """One version: an attempt added, or a snapshot that lists all of them."""

    version: int
    add: str | None = None
    batch: int | None = None
    observed: dict = field(default_factory=dict)
    live: list[str] | None = None
    through: int = -1


class CommitLog:
    """The log of a table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.context = spark.sparkContext
        self.jvm = self.context._jvm
        self.conf = self.context._jsc.hadoopConfiguration()
        self.root = root
        self.fs = self._path(root).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, folder: str) -> list[str]:
        place = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(place)) if self.fs.exists(place) else []

    def versions(self) -> list[tuple[int, str]]:
        """Version and file name of every commit."""
        return [(int(n.split(".")[0]), n) for n in self._names("log") if n.endswith(".json") and not n.startswith(".")]

    def _read(self, version: int, name: str) -> Commit:
        stream = self.fs.open(self._path(f"{self.root}/log/{name}"))
        try:
            body = json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Commit(version, **body)

    def since_snapshot(self) -> list[Commit]:
        """The newest snapshot, if there is one, and every commit after it."""
        found = self.versions()
        first = max((v for v, name in found if name.endswith(".snapshot.json")), default=0)
        return [self._read(v, name) for v, name in found if v >= first]

    def history(self) -> list[Commit]:
        """Every commit of a batch."""
        commits = [self._read(v, name) for v, name in self.versions() if not name.endswith(".snapshot.json")]
        return [c for c in commits if c.batch is not None]

    def live(self) -> list[str]:
        """The attempts that make up the table."""
        attempts: list[str] = []
        for commit in self.since_snapshot():
            attempts = list(commit.live) if commit.live is not None else [*attempts, commit.add]
        return attempts

    def has_batch(self, batch_id: int) -> bool:
        return any(c.batch == batch_id or c.through >= batch_id for c in self.since_snapshot())

    def _published(self, version: int, body: dict, snapshot: bool) -> bool:
        """Whether this version could be taken: one rename that never replaces a file."""
        suffix = ".snapshot.json" if snapshot else ".json"
        target = self._path(f"{self.root}/log/{version:020d}{suffix}")
        pending = self._path(f"{self.root}/log/.{uuid.uuid4().hex}")
        out = self.fs.create(pending, True)
        out.write(bytearray(json.dumps(body).encode()))
        out.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        options = self.context._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        files = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        try:
            files.rename(self.fs.makeQualified(pending), self.fs.makeQualified(target), options)
        except Py4JJavaError as error:
            self.fs.delete(pending, False)
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def commit(self, body: Callable[[], dict], snapshot: bool = False) -> int:
        """Take the next free version; ``body`` is asked again when another took it."""
        while True:
            taken = [v for v, _ in self.versions()]
            version = max(taken, default=0) + 1
            if self._published(version, body(), snapshot):
                return version

    def append(self, attempt: str, batch_id: int, observed: dict) -> int:
        return self.commit(lambda: {"add": attempt, "batch": batch_id, "observed": observed})

    def remove(self, attempts: list[str]) -> None:
        for attempt in attempts:
            self.fs.delete(self._path(f"{self.root}/data/{ATTEMPT}={attempt}"), True)

    def attempts(self) -> list[str]:
        """Attempts that have files, committed or not."""
        return [n.partition("=")[2] for n in self._names("data") if n.startswith(f"{ATTEMPT}=")]

    def path(self, attempt: str) -> str:
        return f"{self.root}/data/{ATTEMPT}={attempt}"


def outcome_rows(judged: DataFrame, t_persist: datetime) -> DataFrame:
    """Accepted events and rejected messages as rows of one table, from one pass."""
    valid = F.col("reject_reason").isNull()
    ready = judged.withColumns(
        {"t_emit": F.col("ts"), "t_persist": F.lit(t_persist).cast("timestamp"), "replica": F.coalesce("replica", F.lit(0))}
    )
    fields = [F.when(valid, F.col(name)).cast(kind).alias(name) for name, kind in PERSISTED_FIELDS.items()]
    place = [
        (F.when(~valid, F.col(name)) if name in judged.columns else F.lit(None)).cast(kind).alias(name)
        for name, kind in PLACE.items()
    ]
    return ready.select(
        *fields,
        *place,
        "reject_reason",
        F.when(~valid, excerpt(F.col("payload"))).alias("excerpt"),
        F.when(valid, ACCEPTED).otherwise(REJECTED).alias(OUTCOME),
        F.when(valid, F.to_date("ts")).alias(EVENT_DATE),
    )


def committed_writer(
    root: str, before_commit: Callable[[int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Micro-batch writer of accepted events and rejected messages, each batch committed once.

    One job decodes, writes and counts: the counts are observed on the rows that the writing
    tasks pass on.  ``before_commit`` is called between the two steps.
    """

    def write(messages: DataFrame, batch_id: int) -> None:
        log = CommitLog(messages.sparkSession, root)
        if log.has_batch(batch_id):
            return
        attempt = f"{batch_id:020d}-{uuid.uuid4().hex}"
        laid = (
            outcome_rows(classified(messages), datetime.now(UTC))
            .hint("rebalance", OUTCOME, EVENT_DATE)
            .sortWithinPartitions(OUTCOME, EVENT_DATE, "device_id", "t_emit")
        )
        seen = Observation(f"batch-{attempt}")
        counted = laid.observe(
            seen,
            F.count(F.lit(1)).alias("received"),
            F.count_if(F.col(OUTCOME) == ACCEPTED).alias("persisted"),
            F.count_if(F.col(OUTCOME) == REJECTED).alias("rejected"),
        )
        counted.write.partitionBy(OUTCOME, EVENT_DATE).parquet(log.path(attempt))
        observed = {name: int(value or 0) for name, value in seen.get.items()}
        if before_commit:
            before_commit(batch_id)
        log.append(attempt, batch_id, observed)
        # What earlier attempts at this batch left behind.
        log.remove([a for a in log.attempts() if a.startswith(f"{batch_id:020d}-") and a != attempt])

    return write


def read_committed(spark: SparkSession, root: str) -> DataFrame:
    """The table as of the newest commit: ``outcome`` tells events from rejected messages."""
    log = CommitLog(spark, root)
    paths = [log.path(a) for a in log.live() if log.fs.exists(log._path(log.path(a)))]
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", f"{root}/data").parquet(*paths)


def telemetry(spark: SparkSession, root: str) -> DataFrame:
    """Accepted events."""
    rows = read_committed(spark, root).where(F.col(OUTCOME) == ACCEPTED)
    return rows.select(*PERSISTED_FIELDS, EVENT_DATE)


def rejects(spark: SparkSession, root: str) -> DataFrame:
    """Rejected messages."""
    rows = read_committed(spark, root).where(F.col(OUTCOME) == REJECTED)
    return rows.select(*PLACE, *REJECT_FIELDS)


def batch_counts(spark: SparkSession, root: str) -> DataFrame:
    """What was observed while each batch was written."""
    rows = [
        (c.batch, *(c.observed.get(n) for n in ("received", "persisted", "rejected"))) for c in CommitLog(spark, root).history()
    ]
    return spark.createDataFrame(rows, "batch_id bigint, received bigint, persisted bigint, rejected bigint")


def compact(spark: SparkSession, root: str) -> int:
    """Rewrite the table as one attempt, by date, device and time; returns the version.

    A range partitioning splits a date or device with a large share of the rows.
    """
    log = CommitLog(spark, root)
    commits = log.since_snapshot()
    old = log.live()
    through = max((max(c.through, -1 if c.batch is None else c.batch) for c in commits), default=-1)
    attempt = f"compacted-{uuid.uuid4().hex}"
    order = (OUTCOME, EVENT_DATE, "device_id", "t_emit")
    rows = read_committed(spark, root).drop(ATTEMPT)
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(OUTCOME, EVENT_DATE).parquet(
        log.path(attempt)
    )

    def snapshot() -> dict:
        # Batches committed while the rows were rewritten stay as they are.
        later = [a for a in log.live() if a not in set(old)]
        reached = max([through, *(c.batch for c in log.since_snapshot() if c.batch is not None)])
        return {"live": [attempt, *later], "through": reached}

    return log.commit(snapshot, snapshot=True)


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Delete attempts that no reader of the newest version needs; for times without writers."""
    log = CommitLog(spark, root)
    live = set(log.live())
    gone = [a for a in log.attempts() if a not in live]
    log.remove(gone)
    return gone
