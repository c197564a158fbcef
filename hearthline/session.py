"""Session helpers: where checkpoints and intermediate tables may be written."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    driver and executors share one disk, falls back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="hearthline-")
    return _LOCAL_FOLDERS[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a dataset this run writes and reads back."""
    return f"{shared_dir(spark)}/hearthline/{uuid.uuid4().hex}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to shared storage and read it back, so iterative plans stay short.

    The rows survive the loss of any executor and are computed once. ``discard``
    deletes them when nothing will read them any more.
    """
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._scratch = path
    return stored


def delete(spark: SparkSession, location: str) -> None:
    """Delete a file or folder on any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder another name on the same file system, making the folders above it; whether it worked."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = old.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(new.getParent())
    return files.rename(old, new)


def exists(spark: SparkSession, location: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def discard(*stored: DataFrame) -> None:
    """Delete what ``cut_lineage`` wrote for these; frames that still read them must not run again."""
    for df in stored:
        delete(df.sparkSession, df._scratch)
