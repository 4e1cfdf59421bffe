"""Raw files of measurement runs: one directory per run with logs, dumps and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetstream.sources.run_source import RunDirectories, RunSamples

SAMPLES_FILE = "stats.csv"
LOG_FILES = "*.log,*.txt"
SAMPLES_HEADER = "Name,CPUPerc,MemUsage"


def _registered(spark: SparkSession) -> SparkSession:
    for source in (RunDirectories, RunSamples):
        spark.dataSource.register(source)
    return spark


def run_lines(spark: SparkSession, root: str, slices: int = 1) -> DataFrame:
    """Lines of the logs and metric dumps, with a position that orders a file's lines.

    Files also contribute rows without text: a run counts from its files, and a dump is
    present even when it is empty (a failed scrape means zeros and not "no dump").  ``slices``
    tasks share every file above the source's slice size.
    """
    reader = _registered(spark).read.format(RunDirectories.name()).option("files", LOG_FILES)
    return reader.option("slices", slices).load(root)


def container_samples(spark: SparkSession, root: str) -> DataFrame:
    """Container samples of all runs: ``run_id``, ``name``, ``cpu`` and ``memory`` text."""
    return _registered(spark).read.format(RunSamples.name()).option("files", SAMPLES_FILE).load(root)


def sample_lines(samples: DataFrame) -> DataFrame:
    """Container samples as the lines of each run's sample file, header first."""
    header = samples.select("run_id").distinct().select(
        "run_id", F.lit(-1).cast("bigint").alias("line_no"), F.lit(SAMPLES_HEADER).alias("value")
    )
    rows = samples.select(
        "run_id",
        F.monotonically_increasing_id().alias("line_no"),
        F.to_csv(F.struct("name", "cpu", "memory")).alias("value"),
    )
    return header.unionByName(rows).select("run_id", F.lit(SAMPLES_FILE).alias("file_name"), "line_no", "value")


def write_runs(lines: DataFrame, root: str) -> None:
    """Write lines (``run_id, file_name, line_no, value``) as the files of run directories.

    The rows of a file go to one task, which streams them to the file; the files of a run may
    go to different ones.
    """
    _registered(lines.sparkSession)
    ordered = lines.select("run_id", "file_name", F.col("line_no").cast("bigint").alias("line_no"), "value")
    (
        ordered.repartition("run_id", "file_name")
        .sortWithinPartitions("run_id", "file_name", "line_no")
        .write.format(RunDirectories.name())
        .mode("append")
        .save(root)
    )
