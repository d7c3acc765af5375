"""Health indicators over sliding windows of per-second cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_S, STEP_S, SLA_S = 60, 10, 60
RETENTION_S = 300
# Kind of event, and the counters it adds its packets and rows to.
KINDS = {
    "received": ("received_packets", None), "parsed": ("parsed_packets", "expected_rows"), "parse_failed": ("parse_failed_packets", None),
    "inserted": (None, "inserted_rows"), "spooled": (None, "spooled_rows"), "spool_failed": (None, "spool_failed_rows"), "dropped": ("kernel_drops", None),
}
COUNTERS = [c for pair in KINDS.values() for c in pair if c]
LATE_KINDS = ("inserted", "spooled", "spool_failed")


def retention(window_s: int = WINDOW_S, sla_s: int = SLA_S) -> int:
    return max(window_s + sla_s + 120, RETENTION_S)


def _second(instant: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(instant))


def _sums() -> list[Column]:
    found = []
    for kind, (packets, rows) in KINDS.items():
        for counter, value in ((packets, "packets"), (rows, "rows")):
            if counter:
                found.append(F.sum(F.when(F.col("kind") == kind, F.col(value)).otherwise(0)).alias(counter))
    return found


def cohort_counts(events: DataFrame) -> DataFrame:
    """Eight counters per host and second of reception: outcomes are credited to when their packets came in."""
    return events.groupBy("host", _second(F.col("cohort_time")).alias("second")).agg(*_sums())


def retain_late(events: DataFrame, retention_s: int = RETENTION_S) -> DataFrame:
    """Events that still find their cohort: insert and spool outcomes that come more than a second before it or after
    the retention don't count; parse results always do."""
    late = F.unix_seconds("done_time") - F.unix_seconds("cohort_time")
    return events.where(~F.col("kind").isin(*LATE_KINDS) | ((late >= -1) & (late < retention_s)))


def sliding_indicator(cohorts: DataFrame, window_s: int = WINDOW_S, step_s: int = STEP_S) -> DataFrame:
    """Counters of the trailing window before each tick, ``[tick - window, tick)``."""
    w = F.window("second", f"{window_s} seconds", f"{step_s} seconds")
    summed = cohorts.groupBy("host", w.alias("w")).agg(*(F.sum(c).alias(c) for c in COUNTERS))
    return summed.select("host", F.col("w.end").alias("tick"), F.col("w.start").alias("window_start"), *COUNTERS)


def percentage(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator == 0, 0.0).otherwise(numerator * 100.0 / denominator)


def _valid(df: DataFrame, starts: DataFrame | None, least: Column) -> DataFrame:
    """``valid``: enough was counted, and the window begins after the host did (``host, start_time``)."""
    if starts is None:
        return df.withColumn("valid", least)
    return df.join(starts, "host").withColumn("valid", least & (F.col("window_start") >= F.col("start_time"))).drop("start_time")


def drop_rate(windows: DataFrame, min_packets: int = 1000, starts: DataFrame | None = None) -> DataFrame:
    total = F.col("received_packets") + F.col("kernel_drops")
    made = windows.select("host", "tick", "window_start", percentage(F.col("kernel_drops"), total).alias("indicator"), F.col("kernel_drops").alias("numerator"), total.alias("denominator"))
    return _valid(made, starts, F.col("denominator") >= min_packets)


def tick_spine(hosts: DataFrame, first_s: int, last_s: int, step_s: int = STEP_S) -> DataFrame:
    """Every tick of every host in [first, last]: silent hosts have windows too."""
    ticks = F.explode(F.sequence(F.lit(first_s), F.lit(last_s), F.lit(step_s)))
    return hosts.select("host", ticks.alias("s")).select("host", F.timestamp_seconds("s").alias("tick"))


def no_traffic(windows: DataFrame, spine: DataFrame, window_s: int = WINDOW_S, starts: DataFrame | None = None) -> DataFrame:
    """100 at ticks before which nothing was received, else 0; no least number."""
    seen = spine.join(windows.select("host", "tick", "received_packets"), ["host", "tick"], "left")
    silent = F.coalesce("received_packets", F.lit(0)) == 0
    begin = F.timestamp_seconds(F.unix_seconds("tick") - window_s)
    made = seen.select("host", "tick", begin.alias("window_start"), F.when(silent, 100.0).otherwise(0.0).alias("indicator"), silent.cast("bigint").alias("numerator"), F.lit(1).cast("bigint").alias("denominator"))
    return _valid(made, starts, F.lit(True))


def _sla(events: DataFrame, whole: tuple[str, str], done: tuple[str, str], sla_s: int, window_s: int, step_s: int, least: int, starts: DataFrame | None) -> DataFrame:
    """Windows that ended ``sla_s`` before their tick, as known at the tick. Events are summed to (cohort second, done
    second) first, so that windows multiply seconds and not events."""
    kept = events.where(F.col("kind").isin(whole[0], done[0]))
    seconds = kept.groupBy("host", "kind", _second(F.col("cohort_time")).alias("second"), _second(F.col("done_time")).alias("done")).agg(F.sum("packets").alias("packets"), F.sum("rows").alias("rows"))
    w = F.window("second", f"{window_s} seconds", f"{step_s} seconds")
    exploded = seconds.select("*", w.alias("w")).withColumn("tick", F.timestamp_seconds(F.unix_seconds("w.end") + sla_s))
    known = F.col("done") <= F.col("tick")
    total = lambda pair: F.sum(F.when((F.col("kind") == pair[0]) & known, F.col(pair[1])).otherwise(0))
    summed = exploded.groupBy("host", "tick", F.col("w.start").alias("window_start")).agg(total(whole).alias("denominator"), total(done).alias("good"))
    missing = F.greatest(F.col("denominator") - F.col("good"), F.lit(0))
    made = summed.select("host", "tick", "window_start", percentage(missing, F.col("denominator")).alias("indicator"), missing.alias("numerator"), "denominator")
    return _valid(made, starts, F.col("denominator") >= least)


def parse_sla(events: DataFrame, sla_s: int = SLA_S, window_s: int = WINDOW_S, step_s: int = STEP_S, min_packets: int = 1000, starts: DataFrame | None = None) -> DataFrame:
    """Share of received packets that weren't parsed in time."""
    return _sla(events, ("received", "packets"), ("parsed", "packets"), sla_s, window_s, step_s, min_packets, starts)


def insert_sla(events: DataFrame, sla_s: int = SLA_S, window_s: int = WINDOW_S, step_s: int = STEP_S, min_rows: int = 1000, starts: DataFrame | None = None) -> DataFrame:
    """Share of parsed rows that weren't inserted in time; spooled rows aren't inserted."""
    return _sla(events, ("parsed", "rows"), ("inserted", "rows"), sla_s, window_s, step_s, min_rows, starts)


def _cycles(cycles: DataFrame, window_s: int, step_s: int) -> DataFrame:
    """Cycle counters (``host, second, attempted, failed, quarantined``) over ``(tick - window, tick]``."""
    w = F.window("second", f"{window_s} seconds", f"{step_s} seconds", "1 second")
    summed = cycles.groupBy("host", w.alias("w")).agg(*(F.sum(c).alias(c) for c in ("attempted", "failed", "quarantined")))
    return summed.withColumn("tick", F.timestamp_seconds(F.unix_seconds("w.end") - 1))


def replay_failure_rate(cycles: DataFrame, window_s: int = WINDOW_S, step_s: int = STEP_S) -> DataFrame:
    made = _cycles(cycles, window_s, step_s)
    return made.select("host", "tick", percentage(F.col("failed"), F.col("attempted")).alias("indicator"), F.col("failed").alias("numerator"), F.col("attempted").alias("denominator"))


def replay_quarantine_rate(cycles: DataFrame, window_s: int = WINDOW_S, step_s: int = STEP_S) -> DataFrame:
    total = F.col("attempted") + F.col("quarantined")
    made = _cycles(cycles, window_s, step_s)
    return made.select("host", "tick", percentage(F.col("quarantined"), total).alias("indicator"), F.col("quarantined").alias("numerator"), total.alias("denominator"))


def replay_backlog(files: DataFrame, now_s: int, sla_s: int = 300, min_age_s: int = 60) -> DataFrame:
    """Share of the spooled files (``mtime_s``) older than the SLA among those old enough to count."""
    age = now_s - F.col("mtime_s")
    summed = files.agg(F.count_if(age >= min_age_s).alias("denominator"), F.count_if((age >= min_age_s) & (age >= sla_s)).alias("numerator"))
    return summed.select(percentage(F.col("numerator"), F.col("denominator")).alias("indicator"), "numerator", "denominator")
