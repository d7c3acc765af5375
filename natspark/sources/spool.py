"""The spool: a folder of batch files with sidecars, listed as tables, from which pairs are set aside."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.sources.files import exists, listed, moved
from natspark.sources.rowbinary import DONE, SIDECAR_SUFFIX


def list_spool(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The batch files of a folder (``path, mtime_s, length``), and their sidecars (``path`` of the data file,
    ``sidecar_mtime_s, sidecar``). Only sidecars are opened; other files are left out."""
    files = [(f.path, f.mtime_ns // 1_000_000_000, f.size) for f in listed(folder)]
    data = [f for f in files if f[0].endswith(DONE)]
    beside = [(path.removesuffix(SIDECAR_SUFFIX), at) for path, at, _ in files if path.endswith(f"{DONE}{SIDECAR_SUFFIX}")]
    frame = spark.createDataFrame(beside, "path string, sidecar_mtime_s long")
    # Empty files are listed, but Spark reads no row from them.
    read = spark.read.format("binaryFile").option("pathGlobFilter", f"*{DONE}{SIDECAR_SUFFIX}").load(folder)
    name = lambda c: F.element_at(F.split(c, "/"), -1)
    texts = read.select(name("path").alias("name"), F.decode("content", "utf-8").alias("sidecar"))
    sidecars = frame.withColumn("name", F.concat(name("path"), F.lit(SIDECAR_SUFFIX))).join(texts, "name", "left").drop("name")
    return spark.createDataFrame(data, "path string, mtime_s long, length long"), sidecars.withColumn("sidecar", F.coalesce("sidecar", F.lit("")))


_SET_ASIDE = "path string, to string, outcome string, problem string"


def set_aside(pairs: DataFrame) -> DataFrame:
    """Move pairs (``path`` of the data file, ``to``: a folder) with their sidecars, and say what became of each:
    ``moved``, ``already`` or ``failed`` with the problem.

    ``pairs`` is the manifest of these moves and should be a written table: after a kill, the same manifest finishes
    what is left, as a file that is at its target counts as moved. The data file goes first, so that a pair that was cut in two isn't
    taken for one that lacks its sidecar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path, to in zip(batch.column("path").to_pylist(), batch.column("to").to_pylist()):
                target = f"{to.rstrip('/')}/{path.rsplit('/', 1)[-1]}"
                try:
                    now = moved(path, target)
                    if exists(f"{path}{SIDECAR_SUFFIX}") or exists(f"{target}{SIDECAR_SUFFIX}"):
                        now |= moved(f"{path}{SIDECAR_SUFFIX}", f"{target}{SIDECAR_SUFFIX}")
                    rows.append((path, to, "moved" if now else "already", None))
                except OSError as e:
                    rows.append((path, to, "failed", f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 4, names=["path", "to", "outcome", "problem"])

    return pairs.select("path", "to").mapInArrow(run, _SET_ASIDE)
