"""Session builder and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(app_name: str = "wayside", **conf: str) -> SparkSession:
    """Session with the settings the engine relies on; ``conf`` wins over them.

    Shuffle partitions are left to the caller (a cluster sets its own, and AQE
    coalesces them); the rest fixes semantics, lets AQE split skewed joins, and
    bounds by bytes what Spark broadcasts.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "64m")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    A folder of this machine is made up only for a local master, where driver
    and executors are one process.
    """
    named = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wayside-"))
    return spark.sparkContext.getCheckpointDir()


#: Lists of the scratch tables of the jobs that the current thread or task is inside of.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("open scratch lists", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for paths in _open.get():
        paths.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the scratch tables made inside, also after an error.

    What is wanted later must be written elsewhere before the end. Jobs in other threads
    keep theirs; a thread started inside takes part if it runs in a copy of the context.
    """
    paths: list[str] = []
    before = _open.set((*_open.get(), paths))
    try:
        yield
    finally:
        _open.reset(before)
        for name in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, **options: str) -> DataFrame:
    """Compute ``df`` once: write it to the shared folder and read it back.

    A written table survives lost executors, has a known size, and gives later
    filters and column choices to the scan.
    """
    path = scratch_path(df.sparkSession, "part")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
