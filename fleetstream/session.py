"""Session settings and the shared folder used for materialised tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    # t_emit is epoch milliseconds; every timestamp rendering is UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON field takes its last value instead of failing the row.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # The JVM never compiles methods above 8000 bytes; a stage that large runs faster as
    # separately generated projections.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for name, value in RUNTIME_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@contextmanager
def with_setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what is started inside; the one before is put back after."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine for tests, checks and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetstream")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Checkpoints go when nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Small test files are split over the cores too.
        .config("spark.sql.files.maxPartitionBytes", "1m")
        .config("spark.sql.files.openCostInBytes", "64k")
        # Call-site capture costs several JVM calls per column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@lru_cache(maxsize=1)
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="fleetstream-")


def shared_dir(spark: SparkSession) -> str:
    """Folder visible to every executor.

    It is the one ``spark.checkpoint.dir`` names, else the one given to
    ``SparkContext.setCheckpointDir``.  The setting is only read: a running session cannot
    change it.  Only a local master may fall back to a folder of its own; on a cluster a
    machine-local path would vanish with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    given = spark.sparkContext.getCheckpointDir()
    if given:
        return given
    master = spark.sparkContext.master
    if not re.match(r"local($|\[)", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


def own_dir(spark: SparkSession) -> str:
    """Where this application keeps its tables below the shared folder."""
    return f"{shared_dir(spark)}/fleetstream/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_own_tables(spark: SparkSession) -> None:
    """Delete what this application has written below the shared folder.

    For the end of a job: tables derived from them cannot be read afterwards.
    """
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Checkpoint a derived table so that it is computed once and survives executor loss."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
