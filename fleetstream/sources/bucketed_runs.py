"""Run logs landed by run, so that later reports neither exchange nor sort their lines.

Lines and container samples are bucketed alike by run id: both aggregations of a report and
its join then work inside a bucket.  A run with more than its share of all rows would make one
bucket's task the longest, so such runs are kept in a partition of their own that is read
without buckets and spread over all tasks.  There are few of them by definition.

Defined cases: rows without a run id are one run; repeated rows are kept; an empty table
gives an empty landing; further columns are kept.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstream.functions.rows import null_safe_join
from fleetstream.session import fresh_path, materialise

# A run is large if it has more than this part of the rows of an average bucket.
LARGE_PART = 0.5
LARGE = "_large_run"


@dataclass(frozen=True)
class LandedTable:
    """A table of the session's catalog, and the folder its files are in."""

    name: str
    path: str
    columns: tuple[str, ...]

    def bucketed(self, spark: SparkSession) -> DataFrame:
        """All rows but those of large runs, in buckets of the run id."""
        return spark.table(self.name).where(~F.col(LARGE)).select(*self.columns)

    def large(self, spark: SparkSession) -> DataFrame:
        """The rows of large runs, spread over tasks."""
        schema = spark.table(self.name).schema
        return spark.read.schema(schema).parquet(self.path).where(LARGE).select(*self.columns)


@dataclass(frozen=True)
class LandedRuns:
    lines: LandedTable
    samples: LandedTable
    has_large: bool

    def report(self, spark: SparkSession, facts: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """``facts(lines, samples)`` of all runs, for any report that is one per run."""
        found = facts(self.lines.bucketed(spark), self.samples.bucketed(spark))
        if self.has_large:
            found = found.unionByName(facts(self.lines.large(spark), self.samples.large(spark)))
        return found

    def drop(self, spark: SparkSession) -> None:
        """Forget the tables; their files go with the application's folder."""
        for landed in (self.lines, self.samples):
            spark.sql(f"DROP TABLE IF EXISTS {landed.name}")


def large_runs(tables: list[DataFrame], buckets: int) -> DataFrame:
    """``run_id`` of the runs that have too large a part of any of the tables."""
    found = []
    for df in tables:
        counts = materialise(df.groupBy("run_id").agg(F.count(F.lit(1)).alias("n")))
        total = counts.agg(F.sum("n")).first()[0] or 0
        found.append(counts.where(F.col("n") > LARGE_PART * total / buckets).select("run_id"))
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return materialise(whole.distinct())


def _land(df: DataFrame, large: DataFrame, name: str, buckets: int) -> LandedTable:
    spark = df.sparkSession
    # At most buckets / LARGE_PART runs of each table are large.
    flags = F.broadcast(large.withColumn(LARGE, F.lit(True)))
    flagged = null_safe_join(df, flags, ["run_id"], "left").withColumn(
        LARGE, F.coalesce(F.col(LARGE), F.lit(False))
    )
    bucket = F.pmod(F.hash("run_id"), F.lit(buckets))
    # One file per bucket, while rows of large runs go anywhere.
    spread = F.when(F.col(LARGE), F.xxhash64(*df.columns))
    landed = LandedTable(f"{name}_{uuid.uuid4().hex}", fresh_path(spark, name), tuple(df.columns))
    (
        flagged.repartition(buckets, bucket, spread)
        .write.partitionBy(LARGE)
        .bucketBy(buckets, "run_id")
        .sortBy("run_id")
        .option("path", landed.path)
        .saveAsTable(landed.name)
    )
    return landed


def land_runs(lines: DataFrame, samples: DataFrame, buckets: int | None = None) -> LandedRuns:
    """Land lines and samples in equally many buckets, as many as shuffle partitions if not said."""
    spark = lines.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    large = large_runs([lines, samples], n)
    return LandedRuns(
        _land(lines, large, "run_lines", n), _land(samples, large, "run_samples", n), not large.isEmpty()
    )
