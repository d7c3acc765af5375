"""Files as tasks see them: byte ranges, pieces, listings and moves, in any store that Arrow knows by its address."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

PIECE_BYTES = 4 << 20


class Listed(NamedTuple):
    path: str
    size: int
    mtime_ns: int


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of an address, and the path in it. Spark writes ``file:/a`` for ``file:///a``."""
    scheme, colon, rest = path.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), path
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def listed(path: str) -> list[Listed]:
    """The files of a folder itself, under addresses like the folder's."""
    store, at = place(path)
    found = store.get_file_info(fs.FileSelector(at))
    return [Listed(f"{path.rstrip('/')}/{f.base_name}", f.size, f.mtime_ns or 0) for f in found if f.is_file]


def opened(path: str, start: int, stop: int) -> bytes:
    """The bytes of a range."""
    store, at = place(path)
    with store.open_input_file(at) as file:
        content = file.read_at(stop - start, start)
    if len(content) != stop - start:
        raise ValueError(f"{path} ends before byte {stop}")
    return content


def pieces(path: str, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """A file from its beginning, in pieces."""
    store, at = place(path)
    with store.open_input_stream(at) as file:
        while piece := file.read(size):
            yield piece


def exists(path: str) -> bool:
    store, at = place(path)
    return store.get_file_info(at).type != fs.FileType.NotFound


def moved(path: str, to: str) -> bool:
    """Move a file, unless it has been moved before; whether it was moved now."""
    store, at = place(path)
    if not exists(path):
        if not exists(to):
            raise FileNotFoundError(path)
        return False
    _, target = place(to)
    store.create_dir(target.rsplit("/", 1)[0], recursive=True)
    store.move(at, target)
    return True


def _put(store: fs.FileSystem, at: str, name: str, content: pa.Buffer | bytes) -> None:
    """A file of the folder ``at``, which appears whole, by a rename."""
    hidden = f"{at}/_{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(content)
    store.move(hidden, f"{at}/{name}")


def write_files(contents: DataFrame, folder: str) -> int:
    """Write ``name, content`` rows as files of a folder, and return their number. A file appears whole, by a rename; a task that
    runs twice writes the same file again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = place(folder)
        store.create_dir(at, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                _put(store, at, name, content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return contents.select("name", "content").mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0


def write_made(rows: DataFrame, folder: str, prefix: str, made: Callable[[pa.RecordBatch], Iterator[list[tuple[str, bytes]]]]) -> int:
    """Write what ``made`` makes of a batch of rows, lists of file ends and contents, as files of a folder named by ``prefix``,
    task and number, and return their number. A task writes each list as soon as it is made and holds no other, and no
    content goes through Spark's rows. Files appear as in :func:`write_files`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, at = place(folder)
        store.create_dir(at, recursive=True)
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = 0
            for files in made(batch):
                for end, content in files:
                    _put(store, at, f"{prefix}{task}_{k}{end}", content)
                k, n = k + 1, n + len(files)
            yield pa.RecordBatch.from_arrays([pa.array([n])], names=["n"])

    return rows.mapInArrow(run, "n long").groupBy().sum("n").first()[0] or 0


def dealt(files: DataFrame) -> DataFrame:
    """``files`` by their ``path`` over all cores, in a number of partitions that adaptive execution leaves as it is: paths
    are few bytes, and it would put all files into one task."""
    return files.repartition(max(2, 4 * files.sparkSession.sparkContext.defaultParallelism), "path")
