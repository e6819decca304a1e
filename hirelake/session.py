"""Session settings (S16, S17) and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Shuffle width is left to AQE: it coalesces small
# partitions and splits skewed ones at run time, so the same code serves 1 MB
# and 100 TB inputs.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    # remove reliable checkpoint files once their frame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def s3a_conf(endpoint: str, access_key: str | None = None, secret_key: str | None = None,
             path_style: bool = True) -> dict[str, str]:
    """Object-store settings (S16). Keys are passed in, never read from files."""
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }
    if access_key is not None:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
    if secret_key is not None:
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf


def build_session(master: str | None = None, app_name: str = "hirelake",
                  conf: Mapping[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults plus ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> None:
    """Set the SQL settings the engine relies on for a session made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
                "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(key, DEFAULT_CONF[key])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint dir); where
    neither is set, a folder in the warehouse, which all executors share as well.
    Never a machine-local temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        configured = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{os.getpid()}-{os.urandom(6).hex()}"
    atexit.unregister(remove_scratch)
    atexit.register(remove_scratch, spark)
    _scratch.append(path)
    if (inside := _passing.get()) is not None:
        inside.append(path)
    return path


def stored(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: a lost
    executor then costs the tasks that read the table, not what led to it. Files hold
    ``rows_per_file`` rows at most, if given."""
    path = scratch_path(df.sparkSession, name)
    with released(df.sparkSession):
        df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_scratch: list[str] = []
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def released(spark: SparkSession):
    """Writes that run inside delete their shuffle files as they end; else these stay
    until the driver's garbage collection finds them unused, often for the whole job."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def unsorted(spark: SparkSession, folders: int):
    """Writes by a column that run inside keep up to ``folders`` files open a task, in place
    of sorting its rows by that column first; tasks that meet more folders sort the rest."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(folders))


def dealt_at(spark: SparkSession, size: int):
    """Tasks after a shuffle that run inside take ``size`` bytes of it, or what is set if less."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    least = min(size, spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get(name)))
    return _setting(spark, name, f"{least}b")


def split_at(spark: SparkSession, size: int):
    """Scans that run inside take ``size`` bytes of files a task, or what is set if less."""
    least = min(size, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return _setting(spark, "spark.sql.files.maxPartitionBytes", str(least))


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Folders of ``scratch_path`` that are given out inside are deleted at the end:
    for tables that nothing reads once the step's own output is written."""
    paths: list[str] = []
    outer = _passing.set(paths)
    try:
        yield
    finally:
        _passing.reset(outer)
        for path in paths:
            fs, where = file_system(spark, path)
            fs.delete(where, True)
            if path in _scratch:
                _scratch.remove(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop's ``(file system, path)`` for a path, wherever it lies."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove_scratch(spark: SparkSession) -> None:
    """Delete the folders that ``scratch_path`` has given out in this process.

    Runs at exit if the session is still there; frames that read these folders
    cannot be used afterwards.
    """
    while _scratch:
        path = _scratch.pop()
        try:
            fs, where = file_system(spark, path)
            fs.delete(where, True)
        except Exception:  # noqa: BLE001  the session has ended; the cluster's own
            break          # clean-up of the checkpoint folder takes over

