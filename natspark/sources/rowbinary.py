"""Fixed-width (schema 2) and variable-width (schema 1) row batches, little-endian without padding.

Files are read in byte ranges, so that one file is the work of many tasks and none holds more than a range: ranges of
schema 2 follow from the length alone, those of schema 1 from one pass that finds where rows begin, and whether they end. The format
``rowbinary`` reads folders of schema 2, at once or as a stream, and writes batch files with their sidecars.
"""

from __future__ import annotations

import functools
import json
import struct
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage

from natspark.functions.times import OFFSET_S
from natspark.schema import SESSION_COLUMNS, SESSIONS, SESSIONS_V1
from natspark.sources.files import dealt, listed, opened, pieces, place, write_made

#: Bytes and order of the columns of a row.
ROW = np.dtype([
    ("start_time", "<u4"), ("end_time", "<u4"), ("router_ip", "<u4"), ("router_port", "<u2"), ("protocol_id", "u1"),
    ("private_ip", "<u4"), ("private_port", "<u2"), ("public_ip", "<u4"), ("public_port", "<u2"),
    ("destination_ip", "<u4"), ("destination_port", "<u2"), ("packet_size", "<u2"),
])
EVENT_ID = 40
ROWS_PER_BATCH = 200_000
#: Rows of schema 1 that are decoded at a time.
_V1_ROWS = 20_000
#: Bytes of a range, and of a row of schema 1 at most: a longer one is an error, not a reason to read on.
RANGE_BYTES, MOST_ROW_BYTES = 32 << 20, 4 << 20
DONE, SIDECAR_SUFFIX = ".rowbinary.done", ".json"
_TIMES = ("event_time", "start_time", "end_time")
_KINDS = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "string": pa.string()}


class Unfinished(ValueError):
    """A row goes on where its bytes end."""


def _names(version: int) -> list[str]:
    return SESSION_COLUMNS if version == 2 else [c.split()[0] for c in SESSIONS_V1.split(", ")]


def _schema(version: int) -> str:
    return SESSIONS if version == 2 else SESSIONS_V1


def _typed(columns: dict, version: int) -> pa.RecordBatch:
    out = {}
    for name, kind in (c.split() for c in _schema(version).split(", ")):
        value = columns[name]
        if kind == "timestamp":
            value = pa.array(np.asarray(value, np.int64) * 1_000_000).cast(pa.timestamp("us", "UTC"))
        out[name] = value if kind == "timestamp" else pa.array(value).cast(_KINDS[kind])
    return pa.RecordBatch.from_pydict(out)


def rows_v2(content: bytes) -> np.ndarray:
    if len(content) % ROW.itemsize:
        raise ValueError(f"{len(content)} bytes aren't a number of whole rows")
    return np.frombuffer(content, ROW)


def _text(content: bytes, at: int) -> tuple[int, int]:
    """Where a string begins and ends; its length stands before it, seven bits a byte from the lowest."""
    if at >= len(content):
        raise Unfinished
    size = content[at]
    at += 1
    if size > 127:
        size, shift, byte = size & 127, 7, 128
        while byte > 127:
            if at >= len(content):
                raise Unfinished
            byte = content[at]
            at += 1
            size |= (byte & 127) << shift
            shift += 7
            if size > MOST_ROW_BYTES:
                raise ValueError(f"a string of {size} bytes or more")
    if at + size > len(content):
        raise Unfinished
    return at, at + size


_V1_PARTS = (struct.Struct("<3I"), struct.Struct("<IHB"), struct.Struct("<IHIHIHH"))
_V1_KINDS = ([("event_time", "<u4"), ("start_time", "<u4"), ("end_time", "<u4")], [("router_ip", "<u4"), ("router_port", "<u2"), ("protocol_id", "u1")], ROW.descr[-7:])


def _row_v1(content: bytes, at: int) -> tuple[int, ...]:
    """The places of the row at a place: its beginning, those and the ends of its three strings, and where the next row begins."""
    times, router, rest = _V1_PARTS
    kind, kind_end = _text(content, at + times.size + EVENT_ID)
    header, header_end = _text(content, kind_end)
    name, name_end = _text(content, header_end + router.size)
    after = name_end + rest.size
    if after > len(content):
        raise Unfinished
    return at, kind, kind_end, header, header_end, name, name_end, after


def _rows_v1(content: bytes) -> Iterator[tuple[int, ...]]:
    after = 0
    while after < len(content):
        places = _row_v1(content, after)
        after = places[-1]
        yield places


def _columns_v1(content: bytes, places: list[tuple[int, ...]]) -> dict:
    """The columns of rows at their places: numbers are gathered, strings cut out."""
    at, kind, kind_end, header, header_end, name, name_end, _ = columns = list(zip(*places))
    raw, out = np.frombuffer(content, np.uint8), {}
    for begin, fields in zip((columns[0], header_end, name_end), _V1_KINDS):
        of = np.dtype(fields)
        rows = raw[np.array(begin)[:, None] + np.arange(of.itemsize)].view(of)[:, 0]
        out |= {c: rows[c] for c in of.names}
    first = _V1_PARTS[0].size
    out["event_id"] = _strings([content[a + first : a + first + EVENT_ID].rstrip(b"\0") for a in at])
    for c, begin, end in (("event_type", kind, kind_end), ("header", header, header_end), ("protocol", name, name_end)):
        out[c] = _strings([content[a:b] for a, b in zip(begin, end)])
    return out


def _strings(values: list[bytes]) -> pa.Array:
    try:
        return pa.array(values, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # not UTF-8
        return pa.array([v.decode(errors="replace") for v in values], pa.string())


def _decoded(content: bytes, version: int) -> Iterator[pa.RecordBatch]:
    names = _names(version)
    if version == 2:
        rows = rows_v2(content)
        for b in range(0, len(rows), ROWS_PER_BATCH):
            yield _typed({c: rows[c][b : b + ROWS_PER_BATCH] for c in names}, 2)
    else:
        for part in batched(_rows_v1(content), _V1_ROWS):
            yield _typed(_columns_v1(content, part), 1)


def _kept(df: DataFrame, keep: tuple[str, ...]) -> str:
    return "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in keep)


def decode_rowbinary(files: DataFrame, version: int = 2, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sessions of the batches in ``content``, with the columns ``keep`` of their files; a file is decoded in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for rows in _decoded(batch.column("content")[k].as_py(), version):
                    for c in keep:
                        rows = rows.append_column(c, pa.repeat(batch.column(c)[k], rows.num_rows))
                    yield rows

    return files.select("content", *keep).mapInArrow(run, _schema(version) + _kept(files, keep))


# ---- ranges


_RANGES = "start long, stop long, rows long, error string"


def _walked_v1(path: str, size: int) -> Iterator[tuple[int, int, int, str | None]]:
    """Ranges of whole rows of a file, and an error range for what follows the last whole row."""
    at = start = rows = 0
    rest, problem = b"", None
    for piece in pieces(path):
        rest += piece
        here = 0
        try:
            while here < len(rest):
                here = _row_v1(rest, here)[-1]
                rows += 1
                if at + here - start >= size:
                    yield start, at + here, rows, None
                    start, rows = at + here, 0
        except Unfinished:
            if len(rest) - here > MOST_ROW_BYTES:
                problem = f"a row of over {MOST_ROW_BYTES} bytes"
        except ValueError as e:
            problem = str(e)
        at, rest = at + here, rest[here:]
        if problem:
            break
    if at > start:
        yield start, at, rows, None
    if rest:
        yield at, at + len(rest), 0, f"{problem or 'the last row is cut off'}, after byte {at}"


def ranges_of(files: DataFrame, version: int, keep: tuple[str, ...] = (), range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, stop, rows, error`` and the columns ``keep`` of the files (``path``, ``length``): ranges of whole rows. What isn't a
    whole row at a file's end is a range with an error and no rows."""
    if version == 2:
        step = range_bytes // ROW.itemsize * ROW.itemsize
        whole = F.col("length") - F.col("length") % ROW.itemsize
        starts = F.when(whole > 0, F.sequence(F.lit(0).cast("long"), whole - 1, F.lit(step).cast("long")))
        good = files.select("path", *keep, whole.alias("whole"), F.explode(starts).alias("start")).withColumn("stop", F.least(F.col("start") + step, "whole"))
        good = good.select("path", *keep, "start", "stop", ((F.col("stop") - F.col("start")) / ROW.itemsize).cast("long").alias("rows"), F.lit(None).cast("string").alias("error"))
        left = F.concat(F.lit("the last row is cut off, after byte "), whole.cast("string"))
        cut = files.where(F.col("length") > whole).select("path", *keep, whole.alias("start"), F.col("length").alias("stop"), F.lit(0).cast("long").alias("rows"), left.alias("error"))
        return good.unionByName(cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = list(_walked_v1(batch.column("path")[k].as_py(), range_bytes))
                if found:
                    columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                    of_file = [pa.repeat(batch.column(c)[k], len(found)) for c in ("path", *keep)]
                    yield pa.RecordBatch.from_arrays([*of_file, *columns], names=["path", *keep, "start", "stop", "rows", "error"])

    # A file is walked by one task.
    return dealt(files.select("path", *keep)).mapInArrow(run, f"path string{_kept(files, keep)}, {_RANGES}")


def decode_ranges(ranges: DataFrame, version: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Sessions of ranges without error (``path, start, stop``), dealt out evenly, with their columns ``keep``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                path, start, stop = (batch.column(c)[k].as_py() for c in ("path", "start", "stop"))
                for rows in _decoded(opened(path, start, stop), version):
                    for c in keep:
                        rows = rows.append_column(c, pa.repeat(batch.column(c)[k], rows.num_rows))
                    yield rows

    wanted = ranges.select(*dict.fromkeys(("path", "start", "stop", *keep)))
    dealt = wanted.repartition(max(2, 2 * ranges.sparkSession.sparkContext.defaultParallelism), "path", "start")
    return dealt.mapInArrow(run, _schema(version) + _kept(ranges, keep))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Batch files of a folder, without their contents."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.rowbinary*").load(path)
    return found.where(~F.col("path").endswith(SIDECAR_SUFFIX)).select("path", "length")


def read_rowbinary(spark: SparkSession, path: str, version: int = 2) -> DataFrame:
    """Sessions of all batch files of a folder, read in ranges. Bytes that aren't a whole row raise an error when the
    ranges are made; :func:`ranges_of` gives them as rows."""
    ranges = ranges_of(_files(spark, path), version)
    checked = ranges.withColumn("start", F.when(F.col("error").isNull(), F.col("start")).otherwise(F.raise_error(F.concat_ws(": ", "path", "error")).cast("long")))
    return decode_ranges(checked, version)


# ---- the format


@dataclass
class ByteRanges(InputPartition):
    """Ranges (path, start, stop) that a task reads, of about the wanted size together."""

    parts: list[tuple[str, int, int]]


def _cut(files: list[tuple[str, int]], range_bytes: int) -> list[ByteRanges]:
    """Large files in ranges, small ones together: the number of tasks follows the bytes and not the files."""
    step = range_bytes // ROW.itemsize * ROW.itemsize
    for path, size in files:
        if size % ROW.itemsize:
            raise ValueError(f"{path}: {size} bytes aren't a number of whole rows")
    tasks, held = [], 0
    for path, size in files:
        for start in range(0, size, step):
            stop = min(start + step, size)
            if not tasks or held + stop - start > range_bytes:
                tasks.append(ByteRanges([]))
                held = 0
            tasks[-1].parts.append((path, start, stop))
            held += stop - start
    return tasks


class RowBinaryFormat(DataSource):
    """``rowbinary``: folders of batch files of schema 2. Options: ``path``; reading: ``rangeBytes``; writing: ``tableName``, ``rowsPerBatch``, ``reason`` (the sidecar's ``error``)."""

    @classmethod
    def name(cls) -> str:
        return "rowbinary"

    def schema(self) -> str:
        return SESSIONS

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return _StreamReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("batch files are only added to a folder")
        if [f.name for f in schema] != SESSION_COLUMNS:
            raise ValueError(f"the columns must be {SESSION_COLUMNS}")
        return _Writer(self.options)


def _read(task: ByteRanges) -> Iterator[pa.RecordBatch]:
    for path, start, stop in task.parts:
        yield from _decoded(opened(path, start, stop), 2)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range_bytes = options["path"], int(options.get("rangeBytes", RANGE_BYTES))

    def partitions(self) -> list[ByteRanges]:
        return _cut([(f.path, f.size) for f in listed(self.path) if f.path.endswith(DONE)], self.range_bytes)

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class _StreamReader(DataSourceStreamReader):
    """Files in the order of their time and name; an offset is the newest one there was. Files appear by a rename, so they are
    whole; one that appears with an older time than the offset's is not seen. A micro-batch takes all new files, in ranges."""

    def __init__(self, options: dict):
        self.path, self.range_bytes = options["path"], int(options.get("rangeBytes", RANGE_BYTES))
        self.newest = [0, ""]

    def _files(self) -> list[tuple[list, str, int]]:
        return [([f.mtime_ns, f.path], f.path, f.size) for f in listed(self.path) if f.path.endswith(DONE)]

    def initialOffset(self) -> dict:
        return {"last": [0, ""]}

    def latestOffset(self) -> dict:
        self.newest = max([self.newest, *(key for key, *_ in self._files())])
        return {"last": self.newest}

    def partitions(self, start: dict, end: dict) -> list[ByteRanges]:
        return _cut([(path, size) for key, path, size in sorted(self._files()) if start["last"] < key <= end["last"]], self.range_bytes)

    def read(self, partition: ByteRanges) -> Iterator[pa.RecordBatch]:
        return _read(partition)


@dataclass
class _Written(WriterCommitMessage):
    #: Names of data files as staged and as committed; each has its sidecar.
    names: list[tuple[str, str]]


class _Writer(DataSourceArrowWriter):
    """Two phases: tasks write into a folder of this job, and the commit moves each sidecar and then its data into place;
    a data file is never without its sidecar. What a failed job or task wrote goes with the folder."""

    def __init__(self, options: dict):
        self.path, self.rows = options["path"].rstrip("/"), int(options.get("rowsPerBatch", ROWS_PER_BATCH))
        self.table, self.reason = options.get("tableName", "sessions"), options.get("reason", "")
        self.job = uuid.uuid4().hex
        self.staging = f"{self.path}/_staging-{self.job}"

    def _meta(self, n: int) -> bytes:
        created = time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime(time.time() + OFFSET_S))
        return json.dumps({"schema_version": 2, "created_time": created, "table_name": self.table, "rows": n, "bytes": n * ROW.itemsize, "format": "RowBinary", "error": self.reason}).encode()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        # A name of its own for every attempt: a task that runs twice leaves files that no message names.
        task, names = uuid.uuid4().hex[:12], []
        fs, at = place(self.staging)
        fs.create_dir(at, recursive=True)
        # Rows go to the open file as they come: a task holds a batch of them, whatever the size of a file.
        out, n = None, 0

        def close() -> None:
            out.close()
            staged = f"{task}_{len(names)}"
            with fs.open_output_stream(f"{at}/{staged}{SIDECAR_SUFFIX}") as beside:
                beside.write(self._meta(n))
            names.append((staged, f"batch_{self.job}_{staged}_rows{n}{DONE}"))

        for batch in iterator:
            rows = np.empty(batch.num_rows, ROW)
            for c in SESSION_COLUMNS:
                column = batch.column(c)
                if column.null_count:
                    raise ValueError(f"{c} has no value")
                rows[c] = column.cast(pa.int64()).to_numpy() // 1_000_000 if c in _TIMES else column.to_numpy()
            begin = 0
            while begin < len(rows):
                if not n:
                    out = fs.open_output_stream(f"{at}/{task}_{len(names)}")
                part = rows[begin : begin + self.rows - n]
                out.write(part.tobytes())
                begin, n = begin + len(part), n + len(part)
                if n == self.rows:
                    close()
                    n = 0
        if n:
            close()
        return _Written(names)

    def commit(self, messages: list[_Written | None]) -> None:
        (fs, staged), (_, to) = place(self.staging), place(self.path)
        for own, name in (pair for m in messages if m for pair in m.names):
            for end in (SIDECAR_SUFFIX, ""):
                fs.move(f"{staged}/{own}{end}", f"{to}/{name}{end}")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        fs, staged = place(self.staging)
        if fs.get_file_info(staged).type.name == "Directory":
            fs.delete_dir(staged)


def register(spark: SparkSession) -> None:
    """Make the format ``rowbinary`` known to a session."""
    spark.dataSource.register(RowBinaryFormat)


# ---- batches in a column


def _packed_text(text: str) -> bytes:
    data = text.encode()
    size, head = len(data), bytearray()
    while size > 127:
        head.append(size & 127 | 128)
        size >>= 7
    head.append(size)
    return bytes(head) + data


_packed_again = functools.lru_cache(4096)(_packed_text)


def _packed_v1(columns: list[list]) -> bytes:
    times, router, rest = _V1_PARTS
    text = lambda t: _packed_again(t) if len(t) < 256 else _packed_text(t)
    parts = []
    for a, b, c, event_id, event_type, header, ip, port, protocol_id, protocol, *numbers in zip(*columns):
        parts += (times.pack(a, b, c), event_id.encode()[:EVENT_ID].ljust(EVENT_ID, b"\0"), text(event_type), text(header), router.pack(ip, port, protocol_id), text(protocol), rest.pack(*numbers))
    return b"".join(parts)


def _packed(batch: pa.RecordBatch, rows_per_batch: int, version: int) -> Iterator[tuple[bytes, int]]:
    """Batches of the rows (numbers and texts), and how many are in each."""
    names = _names(version)
    for begin in range(0, batch.num_rows, rows_per_batch):
        part = batch.slice(begin, rows_per_batch)
        if version == 1:
            yield _packed_v1([part.column(c).to_pylist() for c in names]), part.num_rows
            continue
        rows = np.empty(part.num_rows, ROW)
        for c in names:
            rows[c] = part.column(c).to_numpy(zero_copy_only=False)
        yield rows.tobytes(), part.num_rows


def _numbered(sessions: DataFrame, version: int) -> DataFrame:
    return sessions.select(*(F.unix_seconds(c).alias(c) if c in _TIMES else F.col(c) for c in _names(version)))


def write_rowbinary(sessions: DataFrame, rows_per_batch: int = ROWS_PER_BATCH, version: int = 2) -> DataFrame:
    """``blob, rows``: batches of schema 2 or 1, each from rows of one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, n in _packed(batch, rows_per_batch, version):
                yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary()), pa.array([n], pa.int64())], names=["blob", "rows"])

    return _numbered(sessions, version).mapInArrow(run, "blob binary, rows long")


def write_batch_files(sessions: DataFrame, folder: str, prefix: str, rows_per_batch: int = ROWS_PER_BATCH, version: int = 2, sidecar: dict | None = None) -> int:
    """Batches as of :func:`write_rowbinary`, written to a folder by the tasks that make them, and the number of files. With
    ``sidecar``, its fields, each gets a sidecar that has its rows and bytes too and is there first."""

    def made(batch: pa.RecordBatch) -> Iterator[list[tuple[str, bytes]]]:
        for blob, n in _packed(batch, rows_per_batch, version):
            beside = [] if sidecar is None else [(f"{DONE}{SIDECAR_SUFFIX}", json.dumps(sidecar | {"rows": n, "bytes": len(blob)}).encode())]
            yield [*beside, (DONE, blob)]

    return write_made(_numbered(sessions, version), folder, prefix, made)
