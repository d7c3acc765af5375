"""Replay of batches that failed to insert: inventory, validation, replay exactly once, quarantine and accounts.

A cycle takes the oldest candidates of the spool that no committed run has, finds in one pass which of them hold whole
rows as declared, writes the sessions of those into a run of their own, and commits the run with its ledger. A batch that
can't be read fails alone: it stays in the spool with its reason in the outcome. A cycle that is killed before the
commit leaves nothing that readers see; one killed after it leaves batches in the spool that the next cycle finds in the
ledger and sets aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.functions.names import batch_id, valid_table_name
from natspark.functions.times import event_date
from natspark.schema import SESSIONS, SIDECAR
from natspark.sources.rowbinary import DONE, RANGE_BYTES, ROW, decode_ranges, ranges_of
from natspark.sources.runs import Conflict, RunTable
from natspark.sources.shared import stored
from natspark.sources.spool import list_spool, set_aside

DATA_SUFFIX = DONE
FORMAT = "rowbinary"
LEGACY, REDUCED = 1, 2
MIN_AGE_S = 60


def _meta(text: Column) -> Column:
    """The sidecar's fields. Text that isn't JSON, or has a field of the wrong type, stands in ``corrupt``."""
    return F.from_json(text, f"{SIDECAR}, corrupt string", {"columnNameOfCorruptRecord": "corrupt"})


def validate_sidecar(files: DataFrame) -> DataFrame:
    """``files`` (``length``, ``sidecar``) with the sidecar's fields, and ``reason``: null or the first check that
    fails. Fields that are missing are 0 or empty; version 0 stands for the legacy one."""
    read = files.withColumn("meta", _meta(F.col("sidecar")))
    number = lambda c: F.coalesce(F.col(f"meta.{c}"), F.lit(0))
    version = F.when(number("schema_version") == 0, LEGACY).otherwise(number("schema_version"))
    reason = (
        F.when(F.col("meta").isNull() | F.col("meta.corrupt").isNotNull(), "json")
        .when(F.lower(F.coalesce("meta.format", F.lit(""))) != FORMAT, "format")
        .when(~version.isin(LEGACY, REDUCED), "schema_version")
        .when(~valid_table_name(F.col("meta.table_name")), "table_name")
        .when(number("rows") <= 0, "rows")
        .when(number("bytes") <= 0, "bytes")
        .when(number("bytes") != F.col("length"), "size")
    )
    return read.select(*files.columns, version.alias("version"), F.col("meta.table_name").alias("table_name"), number("rows").alias("rows"), reason.alias("reason"))


def spool_inventory(files: DataFrame, sidecars: DataFrame, now_s: int, min_age_s: int = MIN_AGE_S) -> DataFrame:
    """Each data file (``path, mtime_s, length``) with its sidecar (``path`` of the data file, ``sidecar_mtime_s``,
    ``sidecar``) and its class."""
    data = files.where(F.col("path").endswith(DATA_SUFFIX))
    checked = validate_sidecar(data.join(sidecars, "path", "left"))
    kind = (
        F.when(now_s - F.col("mtime_s") < min_age_s, "too_recent")
        .when(F.col("sidecar_mtime_s").isNull(), "incomplete_pair")
        .when(now_s - F.col("sidecar_mtime_s") < min_age_s, "too_recent")
        .when(F.col("reason").isNotNull(), "invalid")
        .otherwise("candidate")
    )
    return checked.withColumn("class", kind).withColumn("reason", F.when(F.col("class") == "invalid", F.col("reason")))


def select_candidates(inventory: DataFrame, limit: int = 1000) -> DataFrame:
    """The oldest candidates."""
    return inventory.where(F.col("class") == "candidate").orderBy("mtime_s", "path").limit(limit)


def with_batch_id(files: DataFrame) -> DataFrame:
    return files.withColumn("batch_id", batch_id(F.element_at(F.split("path", "/"), -1)))


#: The two tables of a run: what was inserted, and the batches that it came from.
REPLAYED = f"{SESSIONS}, batch_id string, event_date date"
LEDGER = "batch_id string, path string, rows bigint, version int"


def checked_ranges(files: DataFrame, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """Of batches (``batch_id, path, length, rows, version``): the byte ranges of those that hold what they declare, and an
    outcome for each: ``batch_id, path, rows, version, found_rows, status`` (``ok`` or ``failed``) and ``problem``."""
    parts = [ranges_of(files.where(F.col("version") == v), v, ("batch_id", "version"), range_bytes) for v in (REDUCED, LEGACY)]
    ranges = stored(parts[0].unionByName(parts[1]), "batch-ranges")
    found = ranges.groupBy("batch_id").agg(F.sum("rows").alias("found_rows"), F.min("error").alias("error"))
    both = files.select("batch_id", "path", "rows", "version").join(found, "batch_id", "left").withColumn("found_rows", F.coalesce("found_rows", F.lit(0).cast("bigint")))
    differ = F.when(F.col("found_rows") != F.col("rows"), F.concat(F.col("rows").cast("string"), F.lit(" rows declared, "), F.col("found_rows").cast("string"), F.lit(" found")))
    outcome = both.withColumn("problem", F.coalesce("error", differ)).withColumn("status", F.when(F.col("problem").isNull(), "ok").otherwise("failed"))
    outcome = stored(outcome.select("batch_id", "path", "rows", "version", "found_rows", "status", "problem"), "batch-outcome")
    return ranges.join(outcome.where("status = 'ok'").select("batch_id"), "batch_id", "left_semi"), outcome


def stage_replay(candidates: DataFrame, table: RunTable, run: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Write the sessions of the candidates (``path, length, rows, version``) that ``table`` doesn't have into a run, with their
    ledger, and return the outcome. Nothing counts before :meth:`RunTable.commit`."""
    done = table.read("ledger", LEDGER).select("batch_id")
    new = stored(with_batch_id(candidates).join(done, "batch_id", "left_anti").select("batch_id", "path", "length", "rows", "version"), "new-batches")
    ranges, outcome = checked_ranges(new, range_bytes)
    v2, v1 = (decode_ranges(ranges.where(F.col("version") == v), v, ("batch_id",)) for v in (REDUCED, LEGACY))
    sessions = v2.unionByName(v1.select(*v2.columns)).withColumn("event_date", event_date(F.col("end_time")))
    sessions.write.partitionBy("event_date").parquet(table.folder(run, "sessions"))
    outcome.where("status = 'ok'").select("batch_id", "path", "rows", "version").write.parquet(table.folder(run, "ledger"))
    return outcome


def replay_batches(candidates: DataFrame, table: RunTable, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Insert each candidate once, whatever was killed before, and return the outcome of those that were new. Raises
    :class:`natspark.sources.runs.Conflict`, with nothing inserted, if another run was committed meanwhile."""
    seen, run = table.seen(), table.new_run()
    outcome = stage_replay(candidates, table, run, range_bytes)
    try:
        table.commit(run, seen)
    except Conflict:
        table.drop(run)
        raise
    return outcome


def replayed(table: RunTable) -> DataFrame:
    """The sessions of all committed runs."""
    return table.read("sessions", REPLAYED)


def replay_cycle(spark: SparkSession, spool: str, table: RunTable, aside: str, now_s: int, limit: int | None = 1000, min_age_s: int = MIN_AGE_S) -> DataFrame:
    """One cycle over a spool folder: replay the oldest candidates, set replayed pairs aside under ``aside/done`` and
    invalid ones under ``aside/<reason>``, and return the cycle's summary."""
    inventory = stored(spool_inventory(*list_spool(spark, spool), now_s, min_age_s), "inventory")
    taken = select_candidates(inventory, limit) if limit else inventory.where(F.col("class") == "candidate")
    outcome = replay_batches(taken, table)
    done = with_batch_id(taken).join(table.read("ledger", LEDGER).select("batch_id"), "batch_id", "left_semi").select("path", F.lit(f"{aside}/done").alias("to"))
    bad = quarantine(inventory).select("path", F.concat(F.lit(f"{aside}/"), "reason").alias("to"))
    moves = stored(set_aside(stored(done.unionByName(bad), "moves")), "moved")
    return replay_summary(inventory, outcome, limit, moves.where((F.col("outcome") == "failed") & ~F.col("to").endswith("/done")))


def replay_all(spark: SparkSession, spool: str, table: RunTable, aside: str, now_s: int, limit: int = 1000, min_age_s: int = MIN_AGE_S) -> int:
    """Cycles of up to ``limit`` batches each until one finds nothing new to insert, and their number. Batches that fail are tried in
    each cycle; once they fill one, a last cycle takes all there are, so that none waits behind them."""
    cycles = 0
    while True:
        cycles += 1
        summary = stored(replay_cycle(spark, spool, table, aside, now_s, limit, min_age_s), "summary").first()
        if not summary.inserted_rows:
            if limit is None or summary.discovered < limit:
                return cycles
            limit = None


def quarantine(inventory: DataFrame) -> DataFrame:
    """Invalid pairs, to be written by reason."""
    return inventory.where(F.col("class") == "invalid")


def verify_batch_rows(decoded: DataFrame, candidates: DataFrame) -> DataFrame:
    """Declared and decoded rows of each batch, and whether they agree."""
    counted = decoded.groupBy("batch_id").agg(F.count(F.lit(1)).alias("decoded_rows"))
    both = with_batch_id(candidates).select("batch_id", "rows").join(counted, "batch_id", "left")
    found = F.coalesce("decoded_rows", F.lit(0))
    return both.select("batch_id", F.col("rows").alias("declared_rows"), found.alias("decoded_rows"), (found == F.col("rows")).alias("agrees"))


def fixed_width_rows(inventory: DataFrame) -> DataFrame:
    """The same from sizes alone, for batches of fixed width."""
    whole = (F.col("length") / ROW.itemsize).cast("bigint")
    agrees = F.col("length") == F.col("rows") * ROW.itemsize
    return inventory.where((F.col("class") == "candidate") & (F.col("version") == REDUCED)).select("path", "rows", whole.alias("decoded_rows"), agrees.alias("agrees"))


def replay_summary(inventory: DataFrame, outcome: DataFrame | None = None, limit: int | None = None, unmoved: DataFrame | None = None) -> DataFrame:
    """One row: candidates that the limit left, those processed, rows inserted, batches or moves that failed, pairs set aside as
    invalid, and files of each other class. A dry run has no ``outcome``: nothing is processed, inserted or set aside.
    ``unmoved``: invalid pairs that couldn't be set aside."""
    spark = inventory.sparkSession
    is_class = lambda c: F.count_if(F.col("class") == c)
    found = inventory.agg(is_class("candidate").alias("candidates"), is_class("invalid").alias("invalid"), is_class("incomplete_pair").alias("incomplete"), is_class("too_recent").alias("too_recent"))
    discovered = F.col("candidates") if limit is None else F.least("candidates", F.lit(limit).cast("bigint"))
    zero = F.lit(0).cast("bigint")
    if outcome is None:
        return found.select(discovered.alias("discovered"), zero.alias("processed"), zero.alias("inserted_rows"), zero.alias("failed"), zero.alias("quarantined"), "incomplete", "too_recent")
    ok = F.col("status") == "ok"
    done = outcome.agg(F.count(F.lit(1)).alias("processed"), F.coalesce(F.sum(F.when(ok, F.col("found_rows"))), zero).alias("inserted_rows"), F.count_if(~ok).alias("failed_batches"))
    left = (spark.range(0) if unmoved is None else unmoved).agg(F.count(F.lit(1)).alias("unmoved"))
    # One row each.
    row = found.crossJoin(done).crossJoin(left)
    return row.select(
        discovered.alias("discovered"), "processed", "inserted_rows", (F.col("failed_batches") + F.col("unmoved")).alias("failed"),
        (F.col("invalid") - F.col("unmoved")).alias("quarantined"), "incomplete", "too_recent",
    )
