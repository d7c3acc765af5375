"""A table made of runs that are there as a whole or not at all.

A run writes its rows, and any other table, into partitions of its own (``run``). It counts once a manifest names it:
manifests are numbered without a gap, and each is made by a rename that fails if the number is taken, so that of two
runs that saw the same state one is refused. Readers read the partitions that manifests name; what a killed run left is in
none and is swept by a later run. A run may replace others: their folders stay until they are swept, so that readers
who began before go on. This needs a rename that doesn't replace a file, as HDFS and local file systems have.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.sources.sessions import _fs


class Conflict(Exception):
    """Another run was committed meanwhile."""


class RunTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _manifests(self) -> list:
        """``number, run, replaces`` of all manifests, in order. Their number, and not rows, comes to the driver."""
        fs, at = _fs(self.spark, f"{self.path}/_manifests")
        names = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().isdigit()] if fs.exists(at) else []
        if not names:
            return []
        rows = self.spark.read.schema("number int, run string, replaces array<string>").json([p.toString() for p in names]).collect()
        return sorted(rows, key=lambda r: r.number)

    def committed(self) -> list[str]:
        """The runs that count, in order."""
        live: list[str] = []
        for m in self._manifests():
            live = [run for run in live if run not in set(m.replaces or ())] + [m.run]
        return live

    def names(self) -> set[str]:
        """All runs that count or have been replaced."""
        return {m.run for m in self._manifests()}

    def seen(self) -> int:
        """How many manifests there are: what a commit must still find."""
        return len(self._manifests())

    def new_run(self) -> str:
        """The name of a new run."""
        return uuid.uuid4().hex

    def folder(self, run: str, table: str) -> str:
        return f"{self.path}/{table}/run={run}"

    def read(self, table: str, schema: str) -> DataFrame:
        """A table of all committed runs, with whatever partitions their folders have."""
        runs = self.committed()
        if not runs:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(f"{schema}, run string").parquet(f"{self.path}/{table}")
        return found.where(F.col("run").isin(runs)).drop("run")

    def commit(self, run: str, seen: int, replaces: list[str] | tuple[str, ...] = ()) -> None:
        """Make a run count, and those that it ``replaces`` no longer, if the table has still the ``seen`` manifests that it started from."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        fs, folder = _fs(self.spark, f"{self.path}/_manifests")
        fs.mkdirs(folder)
        _, hidden = _fs(self.spark, f"{self.path}/_manifests/_{run}")
        out = fs.create(hidden, True)
        out.write(bytearray(json.dumps({"number": seen + 1, "run": run, "replaces": list(replaces)}).encode()))
        out.close()
        kinds = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = gateway.new_array(kinds, 1)
        options[0] = kinds.NONE
        target = jvm.org.apache.hadoop.fs.Path(folder, str(seen + 1))
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(hidden.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()).rename(hidden, target, options)
        except Exception as e:
            fs.delete(hidden, False)
            if "AlreadyExists" in str(e):
                raise Conflict(f"run {seen + 1} of {self.path} was committed meanwhile") from None
            raise

    def append(self, run: str, replaces: list[str] | tuple[str, ...] = ()) -> None:
        """Make a run count that doesn't depend on others, such as new rows, or the same rows in fewer files."""
        while True:
            try:
                return self.commit(run, self.seen(), replaces)
            except Conflict:
                if not set(replaces) <= set(self.committed()):
                    self.drop(run)
                    raise

    def files(self, run: str, table: str) -> tuple[int, int]:
        """Number and bytes of the data files of a run."""
        fs, at = _fs(self.spark, self.folder(run, table))
        if not fs.exists(at):
            return 0, 0
        found, n, size = fs.listFiles(at, True), 0, 0
        while found.hasNext():
            file = found.next()
            if not file.getPath().getName().startswith(("_", ".")):
                n, size = n + 1, size + file.getLen()
        return n, size

    def compact(self, table: str, schema: str, keys: list[str], target_bytes: int = 128 << 20, least_runs: int = 2) -> int:
        """Write the rows of all runs with files of less than half the target as one run, a file for each partition and about
        ``target_bytes`` in it, and return how many runs it replaces. Runs that are committed meanwhile stay as they are.
        After it, files of a table are at most one a partition and one for each half of the target."""
        small = {run: size for run in self.committed() for n, size in [self.files(run, table)] if size < n * target_bytes / 2 or not n}
        if len(small) < least_runs:
            return 0
        run = self.new_run()
        rows = self.spark.read.schema(f"{schema}, run string").parquet(f"{self.path}/{table}").where(F.col("run").isin(list(small))).drop("run")
        total = max(1, sum(small.values()) // target_bytes)
        rest = [c for c in rows.columns if c not in keys]
        if total > 1:
            # A partition's share of the rows is taken for its share of the bytes.
            sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            share = sizes.crossJoin(F.broadcast(sizes.agg(F.sum("_n").alias("_all")))).select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.ceil(F.col("_n") / F.col("_all") * total).alias("_parts"))
            same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
            rows = rows.join(F.broadcast(share), same).select(*keys, *rest, "_parts")
        else:
            rows = rows.withColumn("_parts", F.lit(1))
        spread = rows.withColumn("_part", F.pmod(F.xxhash64(*rest), "_parts")).drop("_parts")
        spread = spread.repartition(*keys, "_part").drop("_part")
        spread.write.partitionBy(*keys).parquet(self.folder(run, table))
        self.append(run, list(small))
        return len(small)

    def is_compact(self, table: str, partitions: int, target_bytes: int = 128 << 20) -> bool:
        """Whether files are no more than :meth:`compact` leaves of so many partitions."""
        found = [self.files(run, table) for run in self.committed()]
        return sum(n for n, _ in found) <= partitions + sum(size for _, size in found) // (target_bytes // 2)

    def _runs(self) -> list:
        """The folders of all runs."""
        fs, at = _fs(self.spark, self.path)
        tables = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and not s.getPath().getName().startswith("_")] if fs.exists(at) else []
        return [s.getPath() for t in tables for s in fs.listStatus(t) if s.getPath().getName().startswith("run=")]

    def drop(self, run: str) -> None:
        """Delete what a run has written that doesn't count."""
        fs, _ = _fs(self.spark, self.path)
        for folder in self._runs():
            if folder.getName() == f"run={run}":
                fs.delete(folder, True)

    def sweep(self) -> int:
        """Delete what uncommitted runs left, and return the number of folders. No other run may be under way."""
        fs, _ = _fs(self.spark, self.path)
        keep = {f"run={run}" for run in self.committed()}
        left = [f for f in self._runs() if f.getName() not in keep]
        for folder in left:
            fs.delete(folder, True)
        return len(left)
