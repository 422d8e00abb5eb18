"""Spark session defaults and lineage cutting.

The library never creates machine-local scratch space on a cluster: the
shared folder comes from ``spark.checkpoint.dir`` of the running session.
Only local runs (tests, bench) fill that setting in when it is unset.
"""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", app: str = "cohortlens",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  driver_memory: str = "8g", checkpoint_folder: str | None = None) -> SparkSession:
    """Session for local runs; ``checkpoint_folder`` holds its scratch tables (a
    fresh temporary folder if unset). On a cluster, pass your own builder instead."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
    )
    if checkpoint_folder:
        builder = builder.config(CHECKPOINT_CONF, checkpoint_folder)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_local_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    On a cluster it must be configured (``spark.checkpoint.dir``, a folder
    every executor can reach); only a local-mode session without one gets a
    local folder filled in.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if spark.sparkContext.master.startswith("local"):
        return ensure_local_checkpoint_dir(spark)
    raise RuntimeError(
        f"{CHECKPOINT_CONF} is not set; point it at a folder every executor can reach")


def ensure_local_checkpoint_dir(spark: SparkSession) -> str:
    """Local runs only: fill in a checkpoint folder when the session has none."""
    path = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must be set on a cluster")
        path = tempfile.mkdtemp(prefix="cohortlens-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark opens."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


_RUN: contextvars.ContextVar[str] = contextvars.ContextVar("scratch_run", default="")


def scratch_root(spark: SparkSession) -> str:
    """This application's scratch folder (inside ``scratch_run``: the run's)."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens/{spark.sparkContext.applicationId}"
    return f"{base}/{_RUN.get()}" if _RUN.get() else base


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables below ``scratch_root``. DataFrames that still read
    them stop working, so call it when a result has been written or counted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Scratch tables written inside go to a folder of their own, deleted at the end."""
    token = _RUN.set(f"run-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        clear_scratch(spark)
        _RUN.reset(token)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage, so a lost executor re-reads the written files instead of
    recomputing the whole upstream plan (iterative model fits re-scan their
    input many times).
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
