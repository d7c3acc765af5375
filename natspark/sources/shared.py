"""The folder that driver and executors share, and written intermediate tables."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder on a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="spark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@functools.lru_cache(maxsize=64)
def _session_folder(folder: str) -> str:
    """``folder``, made now and deleted when the session's JVM ends."""
    context = SparkSession.active().sparkContext
    at = context._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(at)
    fs.deleteOnExit(at)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for a table that no one needs after the session."""
    folder = _session_folder(f"{shared_dir(spark)}/tables-{spark.sparkContext.applicationId}")
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: its lineage ends there, so a lost executor costs a
    read and not a recomputation."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
