"""Raw packet captures: JSON lines with hex payloads, and a framed binary form."""

from __future__ import annotations

import struct
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.functions.ipv4 import ip_to_long, long_to_ip
from natspark.functions.times import OFFSET_S
from natspark.schema import RAW_PACKETS_JSON
from natspark.sources.files import dealt, listed, opened, pieces, write_made
from natspark.sources.shared import stored

MAGIC = b"HCGNRAW2\n"
#: Big-endian: length of the rest, receive time in nanoseconds, router port, lengths of the router's text and of the data.
FRAME = struct.Struct(">IQHHH")
RAW = "received_s bigint, received_ns bigint, router_ip bigint, router_port int, payload binary"


def _local_seconds(text: Column) -> Column:
    """Seconds of a local ``yyyy-MM-dd HH:mm:ss``, whatever the session's time zone."""
    parts = [F.try_element_at(F.split(text, "[- :]"), F.lit(k)).try_cast("int") for k in range(1, 7)]
    day = F.unix_date(F.make_date(*parts[:3])).cast("bigint")
    return day * 86_400 + parts[3] * 3600 + parts[4] * 60 + parts[5] - OFFSET_S


def packets_of_json(rows: DataFrame) -> DataFrame:
    payload = F.unhex("raw_hex")
    return rows.select(_local_seconds(F.col("received_time")).alias("received_s"), ip_to_long(F.col("router_ip")).alias("router_ip"), "router_port", payload.alias("payload"))


def read_packets_jsonl(spark: SparkSession, path: str) -> DataFrame:
    return packets_of_json(spark.read.schema(RAW_PACKETS_JSON).json(path))


def stream_packets_jsonl(spark: SparkSession, path: str, files_per_trigger: int = 100, bytes_per_trigger: int | None = None) -> DataFrame:
    """Captures as a stream; a micro-batch takes so many new files, or as many as ``bytes_per_trigger`` hold (one at least)."""
    limit = ("maxFilesPerTrigger", files_per_trigger) if bytes_per_trigger is None else ("maxBytesPerTrigger", bytes_per_trigger)
    return packets_of_json(spark.readStream.schema(RAW_PACKETS_JSON).option(*limit).json(path))


def frame(received_ns: int, router_ip: str, router_port: int, data: bytes) -> bytes:
    ip = router_ip.encode()
    return FRAME.pack(FRAME.size - 4 + len(ip) + len(data), received_ns, router_port, len(ip), len(data)) + ip + data


#: Of a frame after its length, and of a range that a task decodes.
MOST_FRAME_BYTES, RANGE_BYTES = FRAME.size - 4 + 2 * 65_535, 32 << 20


def walk(content: bytes, at: int = 0) -> Iterator[tuple[int, int, str, int, bytes]]:
    """The whole frames from a place on: where each ends, and its packet."""
    while at + FRAME.size <= len(content):
        size, nanos, port, ip_size, data_size = FRAME.unpack_from(content, at)
        if size > MOST_FRAME_BYTES or FRAME.size - 4 + ip_size + data_size > size:
            raise ValueError(f"a frame of {size} bytes with {ip_size} and {data_size} bytes in it")
        body, at = at + FRAME.size, at + 4 + size
        if at > len(content):
            return
        yield at, nanos, content[body : body + ip_size].decode(errors="replace"), port, content[body + ip_size : body + ip_size + data_size]


def _walked(path: str, size: int) -> Iterator[tuple[int, int, int, str | None]]:
    """Ranges of whole frames of a capture, and an error range for what isn't one."""
    at = start = frames = 0
    rest, problem, begun = b"", None, False
    for piece in pieces(path):
        rest += piece
        if not begun and len(rest) >= len(MAGIC):
            if not rest.startswith(MAGIC):
                break
            begun, at, start, rest = True, len(MAGIC), len(MAGIC), rest[len(MAGIC) :]
        here = 0
        try:
            for here, *_ in walk(rest) if begun else ():
                frames += 1
                if at + here - start >= size:
                    yield start, at + here, frames, None
                    start, frames = at + here, 0
        except ValueError as e:
            problem = str(e)
        at, rest = at + here, rest[here:]
        if problem:
            break
    if at > start:
        yield start, at, frames, None
    if not begun:
        yield 0, len(rest), 0, "not a raw packet capture"
    elif rest:
        yield at, at + len(rest), 0, f"{problem or 'the last frame is cut off'}, after byte {at}"


def capture_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, stop, frames, error``: ranges of whole frames of each capture (``path``), found in one pass. What isn't
    a whole frame is a range with an error and no frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path in (p for batch in batches for p in batch.column("path").to_pylist()):
            columns = [pa.array(c, t) for c, t in zip(zip(*_walked(path, range_bytes)), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(path), len(columns[0])), *columns], names=["path", "start", "stop", "frames", "error"])

    return dealt(files.select("path")).mapInArrow(run, "path string, start long, stop long, frames long, error string")


def _typed(got: DataFrame) -> DataFrame:
    seconds = F.floor(F.col("received_ns") / F.lit(1_000_000_000)).cast("bigint")
    return got.select(seconds.alias("received_s"), "received_ns", ip_to_long(F.col("router")).alias("router_ip"), "router_port", "payload")


_FRAMES = "received_ns bigint, router string, router_port int, payload binary"


def _batches(content: bytes) -> Iterator[pa.RecordBatch]:
    for rows in batched(walk(content), 10_000):
        columns = list(zip(*rows))[1:]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.binary()))], names=["received_ns", "router", "router_port", "payload"])


def packets_of_ranges(ranges: DataFrame) -> DataFrame:
    """Packets of the ranges without error, dealt out evenly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, stop in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "stop"))):
                yield from _batches(opened(path, start, stop))

    dealt = ranges.where("error is null").select("path", "start", "stop").repartition(max(2, 2 * ranges.sparkSession.sparkContext.defaultParallelism), "path", "start")
    return _typed(dealt.mapInArrow(run, _FRAMES))


def read_packets_raw(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Packets of the captures of a folder, and ``path, start, stop, error`` of the bytes that aren't whole frames. Captures are
    walked once to find ranges, of which each is a task's work, so that a file may have any size."""
    files = spark.createDataFrame([(f.path,) for f in listed(path)], "path string")
    ranges = stored(capture_ranges(files, range_bytes), "capture-ranges")
    return packets_of_ranges(ranges), ranges.where("error is not null").select("path", "start", "stop", "error")


def packets_to_json(packets: DataFrame) -> DataFrame:
    """Packets as the columns of a JSON line."""
    local = F.col("received_s") + OFFSET_S
    day = F.date_from_unix_date(F.floor(local / 86_400).cast("int")).cast("string")
    clock = [F.lpad((F.floor(F.pmod(local, F.lit(86_400)) / n) % m).cast("string"), 2, "0") for n, m in ((3600, 24), (60, 60), (1, 60))]
    return packets.select(
        F.concat_ws(" ", day, F.concat_ws(":", *clock)).alias("received_time"), long_to_ip(F.col("router_ip")).alias("router_ip"),
        "router_port", F.length("payload").alias("packet_size"), F.lower(F.hex("payload")).alias("raw_hex"),
    )


def write_packets_json(packets: DataFrame, folder: str, packets_per_file: int = 100_000) -> None:
    """Add packets to a folder as JSON lines, compressed, as payloads in hex are mostly zeros. A file is read by one task, so
    none has more than so many packets."""
    packets_to_json(packets).write.mode("append").option("compression", "lz4").option("maxRecordsPerFile", packets_per_file).json(folder)


def write_captures(packets: DataFrame, folder: str, packets_per_file: int = 20_000, more: bytes = b"") -> int:
    """Write framed captures of some packets each, with the bytes ``more`` at their end, and return their number. Each is
    written by the task that makes it."""

    def made(batch: pa.RecordBatch) -> Iterator[list[tuple[str, bytes]]]:
        for begin in range(0, batch.num_rows, packets_per_file):
            rows = zip(*(c.to_pylist() for c in batch.slice(begin, packets_per_file).columns))
            yield [("", b"".join([MAGIC, *(frame(s * 1_000_000_000, router, port, data) for s, router, port, data in rows), more]))]

    rows = packets.select("received_s", long_to_ip(F.col("router_ip")).alias("router"), "router_port", "payload")
    return write_made(rows, folder, "capture-", made)
