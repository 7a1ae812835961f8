"""Session and shared-folder helpers.

Every operator in this package is a lazy ``DataFrame -> DataFrame`` function;
only the jobs and the sinks run actions. Anything written as an
intermediate result goes below the shared folder the cluster names in
``spark.checkpoint.dir``. Only a session that runs on one machine (master
``local``, as in unit tests) may do without that setting and gets a temporary
folder; on a cluster its absence is an error.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job relies on. AQE coalesces small shuffle partitions and
# splits skewed ones at run time; the session time zone is pinned because
# trip timestamps are zone-less (timestamp_ntz) and must stay wall-clock.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "lakeops",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, as the session names it.

    Raises ``RuntimeError`` if a cluster session names none: executors there
    would write to their own disks. A ``local`` session gets a temporary folder.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="lakeops-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/lakeops/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python can inspect a local folder."""
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(jpath))


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, by the path's file system; 0 if it is not there."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(jpath).getLength()) if fs.exists(jpath) else 0


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if it is not there."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def rename_path(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder to a name that is free, by its file system; the parent is created."""
    jvm = spark.sparkContext._jvm
    source, goal = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(target)
    fs = source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(goal.getParent())
    if not fs.rename(source, goal):
        raise OSError(f"cannot rename {path} to {target}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop file system (works on any store)."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(jpath):
        fs.delete(jpath, True)


__all__ = [
    "DEFAULT_CONF", "build_session", "ensure_checkpoint_dir", "scratch_path",
    "local_path", "path_exists", "delete_path", "folder_bytes", "child_names", "rename_path",
]
