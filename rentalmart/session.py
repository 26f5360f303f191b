"""Spark session and shared-folder helpers.

Jobs never create a session themselves; they take the caller's. ``get_session`` is the
convenience used by tests, the bench and the command line. It sets an option only where
neither ``--conf`` nor spark-defaults has it, so a cluster's own configuration wins.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults for a session we create. Every one of them is only a default: anything the
# cluster already configured (spark-defaults, --conf) is kept.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Call-site capture costs several driver<->JVM round trips per Column function.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only a side AQE measured below this size (Spark's 10 MB default, stated
    # explicitly); bigger sides sort-merge, with skew-join splitting of hot keys.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(master: str | None = None, app: str = "rentalmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the defaults above."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    launch = SparkConf(loadDefaults=False).setAll(list((extra or {}).items()))
    SparkContext._ensure_initialized(conf=launch)  # starts the JVM, which knows what was submitted
    submitted = SparkConf()
    for key, value in DEFAULT_CONF.items():
        if not submitted.contains(key):
            builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():  # asked for in code: always set
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


class SharedFolderMissing(RuntimeError):
    """No folder that all executors share is configured."""


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables: ``spark.checkpoint.dir``, or the
    folder registered with the SparkContext.

    Where neither is set, a session on a local master (one machine, as in tests) registers a
    private temp folder; on a cluster that would scatter files over the machines' own disks,
    so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured:
        if not is_local(sc.master):
            raise SharedFolderMissing("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rentalmart-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured if spark.conf.get("spark.checkpoint.dir", None) else sc.getCheckpointDir()


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` is not)."""
    return master == "local" or master.startswith("local[")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the shared folder for one table of one run; ``discard``
    it, or have it deleted with ``discard_at_exit`` once it is written."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/rentalmart/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's path of ``path`` and the file system that it lies in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (a file, or a folder with anything but hidden files) exists, asked of
    its file system."""
    where, fs = file_system(spark, path)
    if not fs.exists(where):
        return False
    if not fs.getFileStatus(where).isDirectory():
        return True
    return any(not f.getPath().getName().startswith(("_", ".")) for f in fs.listStatus(where))


def discard(spark: SparkSession, path: str) -> None:
    where, fs = file_system(spark, path)
    fs.delete(where, True)


def discard_at_exit(spark: SparkSession, path: str) -> str:
    """Delete ``path`` when the application ends."""
    where, fs = file_system(spark, path)
    fs.deleteOnExit(where)
    return path
