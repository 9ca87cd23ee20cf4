"""Session and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Scratch tables of this process, by session application id.
_scratch: dict[str, list[str]] = {}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sparkretrieve") -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on.

    On a cluster the master and most settings come from spark-submit; only
    unset values are filled in here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose tasks all run on this machine, gets a folder of
    its own where none is set; on a cluster a missing setting is an error,
    never a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
        configured = os.path.join(tempfile.gettempdir(), f"sparkretrieve-{spark.sparkContext.applicationId}")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique table location under the shared checkpoint folder. It is
    removed by ``drop_scratch``, at the latest when this process ends."""
    root = checkpoint_root(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path in its form."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table location exists, in the file system that Spark uses for it."""
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a table location, in the file system that Spark uses for it."""
    fs, target = file_system(spark, path)
    return fs.delete(target, True)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process made; returns how many. Frames
    that still read them must not be used afterwards."""
    return sum(remove_path(spark, p) for p in _scratch.pop(spark.sparkContext.applicationId, []))


@atexit.register
def _drop_at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    try:
        drop_scratch(spark)
    except Exception:  # noqa: BLE001 - the JVM may be going down already
        pass
