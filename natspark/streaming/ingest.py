"""Packets to the session table as a stream; the checkpoint takes the place of a spool."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from natspark.functions.times import event_date
from natspark.operators.decode import decode_packets
from natspark.schema import PARTITIONS, SESSIONS
from natspark.sources.runs import RunTable
from natspark.streaming.indicators import PROVIDER

INGESTED = f"{SESSIONS}, event_date date, node string"


def finish(writer: DataStreamWriter) -> None:
    """Run a stream over all there is now."""
    writer.trigger(availableNow=True).start().awaitTermination()


def routed(packets: DataFrame, node: str) -> DataFrame:
    """Decoded sessions with the day and node that they belong to."""
    numbered = packets if "packet_id" in packets.columns else packets.withColumn("packet_id", F.xxhash64("payload", "received_s"))
    return decode_packets(numbered).drop("packet_id", "record").withColumns({"event_date": event_date(F.col("end_time")), "node": F.lit(node)})


def stream_ingest(packets: DataFrame, out: str, checkpoint: str, node: str, once: bool = False, every: str = "10 seconds") -> StreamingQuery:
    """Decode a stream of packets and append them to ``out`` in micro-batches, of all there is if ``once``."""
    writer = routed(packets, node).writeStream.format("parquet").partitionBy(*PARTITIONS).option("path", out).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


class SessionSink:
    """Adds the sessions of each micro-batch to a table of runs once: a batch is a run, named by its query and number, that
    counts as a whole. A batch that was killed is written anew. Small runs are merged by :meth:`RunTable.compact`, while
    the stream goes on."""

    def __init__(self, path: str, query: str, node: str, files: int = 4):
        self.path, self.query, self.node, self.files = path, query, node, files

    def __call__(self, packets: DataFrame, batch: int) -> None:
        table, run = RunTable(packets.sparkSession, self.path), f"{self.query}-{batch}"
        if run in table.names():
            return
        salt = F.pmod(F.xxhash64("private_ip", "private_port", "start_time"), F.lit(self.files))
        spread = routed(packets, self.node).withColumn("_salt", salt).repartition(*PARTITIONS, "_salt").drop("_salt")
        spread.write.mode("overwrite").partitionBy(*PARTITIONS).parquet(table.folder(run, "sessions"))
        table.append(run)

    def writer(self, packets: DataFrame, checkpoint: str) -> DataStreamWriter:
        return packets.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """The sessions of all micro-batches that count."""
    return RunTable(spark, path).read("sessions", INGESTED)


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> int:
    """Merge the small files of what was ingested, by day and node; returns the number of runs merged."""
    return RunTable(spark, path).compact("sessions", INGESTED, PARTITIONS, target_bytes)


def stream_dedup(packets: DataFrame, delay: str = "10 minutes", event_time: str = "received_time") -> DataFrame:
    """Packets without the repeats that ambiguous retries leave within ``delay``, by router and payload. The state has 16 bytes of
    a packet's SHA-256 (``packet_hash``) and a time. Sets the session's state store to RocksDB, which holds it on disk, and doesn't count its rows."""
    conf = packets.sparkSession.conf
    conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    # A count takes one more read for each write.
    conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", False)
    whole = F.sha2(F.concat_ws("|", F.hex("payload"), F.col("router_ip").cast("string"), F.col("received_s").cast("string")), 256)
    keyed = packets.withColumn("packet_hash", F.unhex(F.substring(whole, 1, 32)))
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["packet_hash"])
