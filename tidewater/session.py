"""Session and shared-storage helpers.

Everything in the library works on whatever ``SparkSession`` the caller
hands in.  ``get_session`` is a convenience for tests, the bench and the
command line; on a cluster the platform's session is used as is.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.  The reference handles timezone-aware UTC
# datetimes only, so the session zone is pinned to UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "tidewater",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone to UTC (runtime setting, safe to call often)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Folder on shared storage for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir).
    Only a local-mode session (tests, bench) may fall back to a fresh
    temporary folder; on a cluster a machine-local folder would be lost
    with its executor, so an unset setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "(HDFS/S3/ABFS) before running tidewater operators on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# Paths by owner: the first list is the driver's, each open scope of a thread adds its own.
_SCRATCH: list[str] = []
_SCOPES = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder (tracked for cleanup)."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    scopes = getattr(_SCOPES, "open", None)
    (scopes[-1] if scopes else _SCRATCH).append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Staged copies made inside belong to this block and are deleted at its end.

    For steps that write their result: nothing lazy may leave the block."""
    if not hasattr(_SCOPES, "open"):
        _SCOPES.open = []
    _SCOPES.open.append([])
    try:
        yield
    finally:
        _delete(spark, _SCOPES.open.pop())


def cleanup_scratch(spark: SparkSession) -> int:
    """Delete the staged copies this driver created outside scopes; call it once
    the results that read them have been written.  Returns the paths removed."""
    return _delete(spark, _SCRATCH)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while paths:
        jpath = jvm.org.apache.hadoop.fs.Path(paths.pop())
        fs = jpath.getFileSystem(conf)
        if fs.exists(jpath):
            fs.delete(jpath, True)
            removed += 1
    return removed


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint).

    Survives executor loss: the data lives on shared storage and the
    plan below it is dropped.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    Cuts the lineage like a checkpoint, but the copy is columnar: later
    reads prune columns and push filters, and a lost executor never
    recomputes the upstream shuffles.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side file checks."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's file system (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is one file (any Hadoop scheme); False for a folder."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jpath).isFile())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder or file through Hadoop's file system; False if there was none."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly under ``path`` (any Hadoop scheme)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return []
    return [status.getPath().getName() for status in fs.listStatus(jpath)]


__all__ = [
    "DEFAULT_CONF",
    "get_session",
    "use_utc",
    "shared_dir",
    "scratch_path",
    "scratch_scope",
    "cleanup_scratch",
    "cut_lineage",
    "stage_table",
    "local_path",
    "path_exists",
    "is_file",
    "delete_path",
    "list_names",
]
