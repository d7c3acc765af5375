"""Collector telemetry: metric lines, deltas, captures, queues, sockets and drop counters."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.operators.ordered import fold_in_order

# Counters of a metric line.
COUNTERS = [
    "total_received", "total_packet_processed", "total_parsed", "total_inserted", "total_udp_kernel_drops",
    "total_packet_queue_drops", "total_parse_errors", "total_event_marshal_errors", "total_insert_errors",
    "total_insert_dropped_rows", "total_failed_batch_spooled", "total_failed_rows_spooled", "total_failed_spool_errors",
    "total_live_insert_skipped_rows", "total_table_create_errors",
]
# Fields that a monitor shows, in order.
SHOWN = [
    "total_received", "total_udp_kernel_drops", "total_packet_processed", "total_parsed", "total_inserted",
    "total_packet_queue_drops", "total_insert_errors", "total_failed_batch_spooled", "total_failed_rows_spooled",
    "total_failed_spool_errors", "pps_received_10s", "pps_packet_processed_10s", "rps_parsed_10s", "rps_inserted_10s",
    "queue_packet", "queue_batch", "workers_packet", "workers_insert", "udp_read_batches_10s", "udp_average_batch_10s",
    "udp_full_batch_pct_10s", "udp_read_errors_10s", "udp_kernel_drops_10s", "udp_receiver_min_10s",
    "udp_receiver_max_10s", "alerts_enabled", "alerts_mode", "alerts_active", "total_alerts_opened",
    "total_alerts_cleared", "total_alerts_delivered", "total_alert_delivery_errors", "alert_outbox_pending",
    "total_parse_errors", "total_event_marshal_errors", "total_insert_dropped_rows", "total_table_create_errors",
    "total_live_insert_skipped_rows",
]
GAP_S = 30
SAMPLE, RESTART = "sample", "restart"
KEYS = ["host", "capture"]


def parse_metric_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The other columns of ``lines``, ``ts``, ``kind``, ``fields`` and the counters, for sample and restart lines.
    Samples without a time or without received packets are skipped. ``fields`` maps the k=v words of a line; of a
    repeated key the last counts, for which the session's policy for repeated map keys is set."""
    lines.sparkSession.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    line = F.col(value)
    # What marks a restart and a sample.
    kind = F.when(line.contains("collector_started"), RESTART).when(line.rlike("metrics .*live_batch_mode="), SAMPLE)
    rest = [c for c in lines.columns if c != value]
    made = lines.select(*rest, F.regexp_extract(line, r"^(\S+)", 1).try_cast("double").alias("ts"), kind.alias("kind"), F.str_to_map(line, F.lit(" "), F.lit("=")).alias("fields"))
    counted = line.rlike(r"^(?:.* )?total_received=[^ ]") & ~line.rlike(" total_received=(?: |$)")
    good = (F.col("kind") == RESTART) | ((F.coalesce("ts", F.lit(0.0)) != 0) & counted)
    return made.where(F.col("kind").isNotNull() & good).select("*", *(F.col("fields")[c].try_cast("bigint").alias(c) for c in COUNTERS))


def _samples(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("kind") == SAMPLE)


def metric_deltas(metrics: DataFrame) -> DataFrame:
    """Differences and rates of each sample to the one before; blank for the first."""
    w = Window.partitionBy(*KEYS).orderBy("ts")
    step = F.col("ts") - F.lag("ts").over(w)
    names = {"received": "total_received", "processed": "total_packet_processed", "parsed": "total_parsed", "inserted": "total_inserted"}
    made = _samples(metrics).select(*KEYS, "ts", step.alias("interval_s"), *((F.col(c) - F.lag(c).over(w)).alias(f"{k}_delta") for k, c in names.items()))
    rate = {"received": "received_pps", "parsed": "parsed_rps", "inserted": "inserted_rps"}
    return made.select("*", *(F.when(F.col("interval_s") > 0, F.col(f"{k}_delta") / F.col("interval_s")).alias(v) for k, v in rate.items()))


def capture_validity(metrics: DataFrame, captures: DataFrame) -> DataFrame:
    """Whether each capture (``host, capture, expected_first, capture_end``) can be used, and why not."""
    w = Window.partitionBy(*KEYS).orderBy("ts")
    samples = _samples(metrics)
    fell = F.lit(False)
    for c in COUNTERS:
        before = F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
        fell = fell | F.coalesce(F.col(c) < before, F.lit(False))
    step = F.col("ts") - F.lag("ts").over(w)
    marked = samples.select(*KEYS, "ts", fell.alias("fell"), (step <= 0).alias("stuck"), (step > GAP_S).alias("gap"))
    summed = marked.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("samples"), F.count_if("gap").alias("gaps"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.max("fell").alias("fell"), F.coalesce(F.max("stuck"), F.lit(False)).alias("stuck"),
    )
    restarts = metrics.where(F.col("kind") == RESTART).groupBy(*KEYS).agg(F.max("ts").alias("restart_ts"))
    joined = captures.join(summed, KEYS, "left").join(restarts, KEYS, "left")
    reason = (
        F.when(F.coalesce("samples", F.lit(0)) < 2, "samples")
        .when(F.col("fell") | F.col("stuck") | F.coalesce(F.col("restart_ts") > F.col("first_ts"), F.lit(False)), "restart")
        .when(F.abs(F.col("first_ts") - F.col("expected_first")) > 0.00001, "first")
        .when(F.col("capture_end") - F.col("last_ts") > GAP_S, "end")
    )
    return joined.select(*KEYS, F.coalesce("samples", F.lit(0)).alias("samples"), F.coalesce("gaps", F.lit(0)).alias("gaps"), reason.isNull().alias("valid"), reason.alias("reason"))


def _queue(name: str) -> Column:
    return F.substring_index(F.col("fields")[name], "/", 1).try_cast("bigint")


def capture_summary(metrics: DataFrame) -> DataFrame:
    """Per capture: last minus first of each counter (null if it is missing in a sample), first and last values, mean
    rates, error and drop percentages, and the fullest queues."""
    aggs = [F.count(F.lit(1)).alias("samples"), (F.max("ts") - F.min("ts")).alias("duration_s")]
    aggs += [F.max(_queue(q)).alias(f"max_{q}") for q in ("queue_packet", "queue_batch")]
    for c in COUNTERS:
        whole = F.count(c) == F.count(F.lit(1))
        aggs += [F.when(whole, F.min_by(c, "ts")).alias(f"first_{c}"), F.when(whole, F.max_by(c, "ts")).alias(f"last_{c}")]
    made = _samples(metrics).groupBy(*KEYS).agg(*aggs)
    made = made.select("*", *((F.col(f"last_{c}") - F.col(f"first_{c}")).alias(c) for c in COUNTERS))
    share = lambda a, b: F.when(b > 0, 100 * a / b)
    seconds = F.col("duration_s")
    return made.select(
        "*",
        *(F.when(seconds > 0, F.col(c) / seconds).alias(n) for c, n in (("total_received", "received_pps"), ("total_parsed", "parsed_rps"), ("total_inserted", "inserted_rps"))),
        share(F.col("total_parse_errors"), F.col("total_packet_processed")).alias("parse_error_pct"),
        share(F.col("total_udp_kernel_drops"), F.col("total_received") + F.col("total_udp_kernel_drops")).alias("drop_pct"),
    )


def pipeline_balance(summary: DataFrame) -> DataFrame:
    """Packets received but neither processed nor dropped, and rows parsed but neither inserted nor spooled: at the
    first and the last sample, and the change."""
    packets = lambda p: F.col(f"{p}total_received") - F.col(f"{p}total_packet_processed") - F.col(f"{p}total_packet_queue_drops")
    rows = lambda p: F.col(f"{p}total_parsed") - F.col(f"{p}total_inserted") - F.col(f"{p}total_failed_rows_spooled")
    return summary.select(
        *KEYS,
        packets("first_").alias("first_packets"), packets("last_").alias("last_packets"), packets("").alias("packets_change"),
        rows("first_").alias("first_rows"), rows("last_").alias("last_rows"), rows("").alias("rows_change"),
    )


def _in_rows(newest: DataFrame, keys: list[str], shown: list[str]) -> DataFrame:
    names = F.array(*map(F.lit, shown))
    rows = newest.select(*keys, "fields", F.posexplode(names).alias("place", "name"))
    return rows.select(*keys, (F.col("place") + 1).alias("place"), "name", F.col("fields")[F.col("name")].alias("value"))


def latest_metrics(metrics: DataFrame, shown: list[str] = SHOWN) -> DataFrame:
    """``host, place, name, value``: the newest sample of each host, a field a row."""
    newest = _samples(metrics).groupBy("host").agg(F.max_by("fields", "ts").alias("fields"))
    return _in_rows(newest, ["host"], shown)


#: How old the sample that a capture begins with may be.
FRESH_S = 60


def metrics_at(metrics: DataFrame, instants: DataFrame, within_s: int = FRESH_S) -> DataFrame:
    """``instants`` (``host``, ``at`` in seconds, and any key of their own) with ``ts`` and ``fields`` of the newest sample of the
    host in the ``within_s`` seconds up to the instant, or none. Of samples of one time that with the most received packets counts, which came last.

    An as-of join by order: samples and instants are dealt by host and stretch of time, each sample to its own and the
    next stretch, so that a host's long history is the work of many tasks, and the last sample before each instant is carried along. No
    pair of a sample and an instant is made but the one that is kept."""
    stretch = lambda c: F.floor(c / within_s).cast("bigint")
    own = [c for c in instants.columns if c != "host"]
    kept = F.struct("ts", "fields")
    samples = _samples(metrics).select("host", F.explode(F.array(stretch(F.col("ts")), stretch(F.col("ts")) + 1)).alias("stretch"), F.col("ts").alias("time"), F.lit(0).alias("kind"), F.col("total_received").alias("tie"), kept.alias("sample"))
    asked = instants.select("host", stretch(F.col("at")).alias("stretch"), F.col("at").cast("double").alias("time"), F.lit(1).alias("kind"), F.struct(*own).alias("instant"))
    both = samples.unionByName(asked, allowMissingColumns=True)
    order = Window.partitionBy("host", "stretch").orderBy("time", "kind", "tie").rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("found", F.last("sample", ignorenulls=True).over(order)).where("kind = 1")
    fresh = F.when(F.col("time") - F.col("found.ts") <= within_s, F.col("found"))
    return last.select("host", "instant.*", fresh.alias("found")).select("host", *own, "found.ts", "found.fields")


def latest_metrics_at(metrics: DataFrame, instants: DataFrame, within_s: int = FRESH_S, shown: list[str] = SHOWN) -> DataFrame:
    """The fields to show of the newest sample at each instant, a field a row; instants without a fresh sample have no rows."""
    found = metrics_at(metrics, instants, within_s).where("fields is not null")
    return _in_rows(found, ["host", *(c for c in instants.columns if c != "host")], shown)


def socket_distribution(metrics: DataFrame) -> DataFrame:
    """Per sample: packets over the sockets, and how full read batches were."""
    field = lambda c: F.col("fields")[c].try_cast("bigint")
    samples = _samples(metrics).select(*KEYS, "ts", F.col("fields")["udp_receiver_packets_10s"].alias("list"), field("udp_read_batches_10s").alias("batches"), field("udp_full_batches_10s").alias("full"))
    pair = F.split("part", ":")
    each = samples.select(*KEYS, "ts", "batches", "full", F.explode(F.split("list", ",")).alias("part")).select(*KEYS, "ts", "batches", "full", F.try_element_at(pair, F.lit(2)).try_cast("bigint").alias("n"))
    made = each.groupBy(*KEYS, "ts").agg(
        F.count("n").alias("sockets"), F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("packets"),
        F.first("batches").alias("batches"), F.first("full").alias("full"),
    )
    some = F.col("batches") > 0
    return made.select(*KEYS, "ts", "sockets", "least", "most", "packets", F.when(some, F.col("packets") / F.col("batches")).otherwise(0.0).alias("average_batch"), F.when(some, F.col("full") * 100 / F.col("batches")).otherwise(0.0).alias("full_batch_pct"))


def counter_increments(samples: DataFrame, keys: list[str], order: str = "seq", value: str = "value") -> DataFrame:
    """``keys, order, increment`` of a cumulative 32-bit counter. The first value counts whole; a wrap-around counts; a
    step of over half the range is an older value that came late: it counts nothing and isn't the base of the next.
    Each step needs the base that the one before left, so samples are folded in order; those without a value are left
    out."""
    kinds = {f.name: f.dataType.simpleString() for f in samples.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", `{order}` bigint, increment bigint"

    def fold(key: tuple, state: dict, frame: pd.DataFrame) -> pd.DataFrame:
        found, base = [], state.get("base")
        for v in frame[value].tolist():
            ahead = v if base is None else (v - base) % (1 << 32)
            stale = base is not None and ahead > 1 << 31
            found.append(0 if stale else ahead)
            base = base if stale else v
        state["base"] = base
        return frame[[*keys, order]].assign(increment=found)

    picked = samples.select(*keys, F.col(order).cast("bigint").alias(order), F.col(value).cast("bigint").alias(value)).where(F.col(value).isNotNull())
    return fold_in_order(picked, keys, [order, value], dict, fold, schema)
