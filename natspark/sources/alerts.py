"""Versioned incident records, appended or merged, and a sink of streams that adds each version once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from natspark.schema import ALERTS
from natspark.sources.sessions import _fs, partition_path, publish_partition
from natspark.sources.shared import stored


def write_alert_records(records: DataFrame, path: str, form: str = "parquet") -> None:
    """Append records, by the month in which their incident began."""
    month = F.date_format("start_time", "yyyyMM").cast("int")
    records.withColumn("month", month).write.mode("append").partitionBy("month").format(form).save(path)


def read_alert_records(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    return spark.read.schema(f"{ALERTS}, month int").format(form).load(path)


#: What tells versions apart, and the second by whose month they are filed.
VERSION = ["host", "alert", "incident", "version"]
START = "start_tick"


def merge_versions(versions: DataFrame, path: str, key: list[str] = VERSION, start: str = START) -> int:
    """Add versions to the month partitions of their incidents' starts, but none that is there; returns the months
    touched. Each month is replaced as a whole by :func:`publish_partition`, so that a merge that was killed, or is run
    again, leaves each version once."""
    spark = versions.sparkSession
    dated = versions.withColumn("month", F.date_format(F.timestamp_seconds(start), "yyyyMM").cast("int"))
    # As many rows as months, of which a batch has few.
    months = [r.month for r in dated.select("month").distinct().collect()]
    for month in months:
        new = dated.where(F.col("month") == month).drop("month")
        fs, at = _fs(spark, partition_path(path, month=month))
        if fs.exists(at):
            new = spark.read.schema(new.schema).parquet(at.toString()).unionByName(new)
        publish_partition(new.dropDuplicates(key).withColumn("month", F.lit(month)), path, month=month)
    return len(months)


def read_versions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, month int").parquet(path)


class VersionSink:
    """Applies the micro-batches of a stream of versions once each: a batch that the record of its query names is passed
    over, and one that was killed before the record is merged again, which adds nothing twice."""

    def __init__(self, path: str, query: str, key: list[str] = VERSION, start: str = START):
        self.path, self.query, self.key, self.start = path.rstrip("/"), query, key, start

    def _record(self, spark: SparkSession, batch: int):
        return _fs(spark, f"{self.path}/_applied/{self.query}/{batch}")

    def applied(self, spark: SparkSession, batch: int) -> bool:
        fs, at = self._record(spark, batch)
        return fs.exists(at)

    def __call__(self, versions: DataFrame, batch: int) -> None:
        spark = versions.sparkSession
        if self.applied(spark, batch):
            return
        # Written first: each look at a batch would run its stateful plan again.
        merge_versions(stored(versions, "versions"), self.path, self.key, self.start)
        fs, at = self._record(spark, batch)
        fs.create(at, True).close()

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint).outputMode("append")
