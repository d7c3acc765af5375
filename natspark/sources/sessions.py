"""The session table, partitioned by day and node, and atomic publication of report partitions."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from natspark.functions.times import event_date
from natspark.schema import PARTITIONS, SESSIONS


class MissingNode(Exception):
    """A node has no partition for the day; an empty partition would be fine."""


def _fs(spark: SparkSession, path: str):
    """Spark's file system for ``path``, and the path as its kind of object."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def partition_path(path: str, **keys: object) -> str:
    return "/".join([path.rstrip("/"), *(f"{k}={v}" for k, v in keys.items())])


def read_sessions(spark: SparkSession, path: str, day: datetime.date, nodes: Iterable[str]) -> DataFrame:
    """One day of some nodes, each of which must be there. Only their partitions are listed and read."""
    nodes = list(nodes)
    for node in nodes:
        fs, at = _fs(spark, partition_path(path, event_date=day, node=node))
        if not fs.exists(at):
            raise MissingNode(f"{node} has no sessions of {day}")
    table = spark.read.schema(f"{SESSIONS}, event_date date, node string").parquet(path).where(F.col("event_date") == F.lit(day))
    return table.where(F.col("node").isin(nodes))


def write_sessions(sessions: DataFrame, path: str, files_per_partition: int = 4, max_records: int = 20_000_000) -> None:
    """Append each session to the day that it ended in. Rows of a day and node go to a few tasks and not to one, as
    there are few nodes; they are sorted for row-group pruning."""
    dated = sessions if "event_date" in sessions.columns else sessions.withColumn("event_date", event_date(F.col("end_time")))
    salt = F.pmod(F.xxhash64("private_ip", "private_port", "start_time"), F.lit(files_per_partition))
    spread = dated.withColumn("salt", salt).repartition("event_date", "node", "salt").sortWithinPartitions("event_date", "node", "end_time", "router_ip").drop("salt")
    spread.write.mode("append").partitionBy(*PARTITIONS).option("maxRecordsPerFile", max_records).parquet(path)


def _sweep(spark: SparkSession, path: str, target: str, part: str) -> None:
    """Clear what a killed publication of this partition left: the old partition goes back if there is no new one."""
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return
    _, at = _fs(spark, target)
    for left in fs.listStatus(root):
        folder = left.getPath()
        name = folder.getName()
        if name.startswith(("_old-", "_staging-")):
            _, inside = _fs(spark, f"{folder.toString()}/{part}")
            if fs.exists(inside):
                if name.startswith("_old-") and not fs.exists(at):
                    fs.mkdirs(at.getParent())
                    fs.rename(inside, at)
                fs.delete(folder, True)


def publish_partition(df: DataFrame, path: str, **keys: object) -> int:
    """Replace exactly one partition of a Parquet table by ``df`` and return its rows.

    The new rows are staged beside the table, counted as they are written and again from there; only then is the
    partition moved away and the staged folder moved in. No rows remove the partition. If anything fails, the old
    partition is back in place; if the job is killed between the two moves, the next publication of this partition, or
    anyone who moves ``_old-*`` back, restores it. Two publications of one partition must not run at a time.
    """
    spark = df.sparkSession
    target, run, part = partition_path(path, **keys), uuid.uuid4().hex, partition_path("", **keys).lstrip("/")
    folders = [f"{path.rstrip('/')}/_{kind}-{run}" for kind in ("staging", "old")]
    (fs, at), (_, staged_at), (_, old_at) = (_fs(spark, p) for p in (target, *(f"{f}/{part}" for f in folders)))
    _sweep(spark, path, target, part)
    body, written = df.drop(*keys), Observation()
    try:
        body.observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(staged_at.toString())
        rows = spark.read.schema(body.schema).parquet(staged_at.toString()).count()
        if rows != written.get["rows"]:
            raise RuntimeError(f"{rows} rows were staged of {written.get['rows']}")
        moved = fs.exists(at)
        if moved:
            fs.mkdirs(old_at.getParent())
            if not fs.rename(at, old_at):
                raise RuntimeError(f"could not move {target} away")
        try:
            if rows:
                fs.mkdirs(at.getParent())
                if not fs.rename(staged_at, at):
                    raise RuntimeError(f"could not move the staged rows to {target}")
        except Exception:
            if moved:
                fs.rename(old_at, at)
            raise
    finally:
        for folder in folders:
            _, left = _fs(spark, folder)
            if fs.exists(left):
                fs.delete(left, True)
    return rows
