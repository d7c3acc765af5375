"""The daily reports. All are grouped by day (of the session's end) and node besides their own keys; distinct counts of
one node are never added to another's. Distinct values are shuffled with their keys, so a hot address is spread."""

from __future__ import annotations

import datetime
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from natspark.functions.times import hour_utc, in_day
from natspark.operators import distinct
from natspark.sources.shared import stored

DAY = ["data_date", "node"]
SMTP_PORTS = (25,)
# Destination ports of well-known services.
SERVICE_PORTS = (
    3478, 443, 53, 25, 587, 465, 110, 995, 143, 993, 5228, 5229, 5230, 3479, 3480, 5060, 5061, 5222, 5223, 1935, 500,
    4500, 1194, 22, 3389, 3074, 25565, 8080, 8443, 18080, 18081,
)



def _dated(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("data_date", F.col("event_date"))


def _top(df: DataFrame, k: int, *order: Column, parts: int = 64) -> DataFrame:
    """The first ``k`` rows of each node and day. There are few nodes and the optimizer prunes only small ``k``, so each
    node's rows are ranked in parts first, of which none gives more than ``k`` to the last ranking."""
    rest = [c for c in df.columns if c not in DAY]
    made = df.withColumn("part", F.pmod(F.xxhash64(*rest), F.lit(parts)))
    for keys in ([*DAY, "part"], DAY):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        made = made.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    return made.drop("part")


def public_ip_pool(sessions: DataFrame) -> DataFrame:
    keys = [*DAY, "public_ip"]
    made = _dated(sessions)
    ports = distinct.counted(distinct.bitmaps(made, keys, "public_port"), keys, "ports_in_use", "translations")
    return distinct.side_by_side(keys, ports, distinct.grouped(made, keys, "private_ip", "subscribers"))


def subscribers_of_public_ip(sessions: DataFrame, ips: Iterable[int] | DataFrame) -> DataFrame:
    """Who was behind some addresses: a few given as numbers, or many as a DataFrame with ``public_ip``."""
    if isinstance(ips, DataFrame):
        chosen = sessions.join(ips.select("public_ip"), "public_ip", "left_semi")
    else:
        chosen = sessions.where(F.col("public_ip").isin(*ips))
    keys = [*DAY, "public_ip", "private_ip"]
    made = _dated(chosen)
    ports = distinct.grouped(made, keys, "destination_port", "destination_ports", sessions=F.lit(1), total_bytes=F.col("packet_size"))
    both = distinct.side_by_side(keys, ports, distinct.grouped(made, keys, "destination_ip", "destinations"))
    return both.select(*keys, "sessions", "destinations", "destination_ports", "total_bytes")


def hourly_nat_load(sessions: DataFrame) -> DataFrame:
    return _dated(sessions).groupBy(*DAY, hour_utc(F.col("start_time")).alias("hour"), "public_ip").agg(
        F.count(F.lit(1)).alias("sessions"), F.countDistinct("private_ip").alias("active_subscribers")
    )


def smtp_abuse(sessions: DataFrame, ports: Iterable[int] = SMTP_PORTS, k: int = 10_000) -> DataFrame:
    keys = ["private_ip", "public_ip", "destination_ip"]
    sent = _dated(sessions.where(F.col("destination_port").isin(*ports)))
    counted = sent.groupBy(*DAY, *keys).agg(F.count(F.lit(1)).alias("sessions"), F.sum("packet_size").alias("total_bytes"))
    return _top(counted, k, F.desc("sessions"), *map(F.asc, keys))


def top_service_ports(sessions: DataFrame, ports: Iterable[int] = SERVICE_PORTS) -> DataFrame:
    used = _dated(sessions.where(F.col("destination_port").isin(*ports)))
    return used.groupBy(*DAY, "public_ip", "destination_port").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("packet_size").alias("total_bytes"), F.countDistinct("private_ip").alias("subscribers")
    )


def _started_today(sessions: DataFrame, day: datetime.date | None) -> DataFrame:
    """Sessions that ended and started on the same day (``day``, or each its own)."""
    kept = sessions if day is None else sessions.where(F.col("event_date") == F.lit(day))
    return _dated(kept.where(in_day(F.col("start_time"), F.col("event_date") if day is None else day)))


def _distinct(column: Column, lg_k: int, exact: bool) -> Column:
    return F.countDistinct(column) if exact else F.hll_sketch_estimate(F.hll_sketch_agg(column, lg_k))


def router_hour_observations(sessions: DataFrame, day: datetime.date | None = None, lg_k: int = 17, exact: bool = False) -> DataFrame:
    """Distinct addresses of each router and hour. Exactly: private and public addresses come from pools and are told by
    bitmaps, destinations are grouped."""
    keys = [*DAY, "hour", "router_ip"]
    made = _started_today(sessions, day).withColumn("hour", hour_utc(F.col("start_time")))
    names = {"private_ip": "private_ips", "public_ip": "public_ips", "destination_ip": "destinations"}
    if exact:
        private, public = (distinct.counted(distinct.bitmaps(made, keys, c), keys, names[c]) for c in ("private_ip", "public_ip"))
        parts = [private, public.drop("records"), distinct.grouped(made, keys, "destination_ip", names["destination_ip"])]
        return distinct.side_by_side(keys, *parts).select(*keys, "records", *names.values())
    return made.groupBy(*keys).agg(F.count(F.lit(1)).alias("records"), *(F.hll_sketch_estimate(F.hll_sketch_agg(c, lg_k)).alias(f"{n}_approx") for c, n in names.items()))


def origin(router_ip: str = "router_ip", private_ip: str = "private_ip") -> Column:
    """Router and private address as one number."""
    return F.shiftleft(F.col(router_ip), 32).bitwiseOR(F.col(private_ip))


def public_ip_sharing_hour(sessions: DataFrame, day: datetime.date | None = None, k: int = 200, lg_k: int = 17, exact: bool = False) -> DataFrame:
    origins = "origins" if exact else "origins_approx"
    counted = _started_today(sessions, day).groupBy(*DAY, hour_utc(F.col("start_time")).alias("hour"), "public_ip").agg(
        _distinct(origin(), lg_k, exact).alias(origins), F.countDistinct("router_ip").alias("routers"), F.count(F.lit(1)).alias("records")
    )
    return _top(counted, k, F.desc(origins), F.asc("hour"), F.asc("public_ip"))


#: Standard errors of a sketch that an estimate may be off by; a normal error is beyond six once in 500 million.
SIGMAS = 6


def public_ip_sharing_hour_proven(sessions: DataFrame, day: datetime.date | None = None, k: int = 200, lg_k: int = 17) -> DataFrame:
    """The exact report, of which only those address-hours are counted exactly that the bounds of their sketches allow
    among the first ``k``: all whose upper bound reaches the ``k``-th lower bound of their day and node."""
    keys = [*DAY, "hour", "public_ip"]
    made = _started_today(sessions, day).withColumn("hour", hour_utc(F.col("start_time")))
    estimate = F.hll_sketch_estimate(F.hll_sketch_agg(origin(), lg_k))
    estimated = made.groupBy(*keys).agg(estimate.alias("estimate"))
    error = SIGMAS * 1.04 / 2 ** (lg_k / 2)
    # A sketch too rough to bound anything from above excludes nothing.
    high = F.col("estimate") / (1 - error) + 1 if error < 1 else F.lit(float("inf"))
    bounds = stored(estimated.select(*keys, (F.col("estimate") / (1 + error) - 1).alias("low"), high.alias("high")), "bounds")
    first = _top(bounds.drop("high"), k, F.desc("low")).groupBy(*DAY).agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("n"))
    # One row a day and node.
    chosen = stored(bounds.join(first, DAY).where((F.col("high") >= F.col("least")) | (F.col("n") < k)).select(*keys), "candidates")
    # Address-hours that can't be among the first go before anything is grouped.
    pairs = made.join(chosen, keys, "left_semi").groupBy(*keys, "router_ip", "private_ip").agg(F.count(F.lit(1)).alias("records"))
    routers = pairs.groupBy(*keys, "router_ip").agg(F.count("private_ip").alias("origins"), F.sum("records").alias("records"))
    counted = routers.groupBy(*keys).agg(F.sum("origins").alias("origins"), F.count("router_ip").alias("routers"), F.sum("records").alias("records"))
    return _top(counted, k, F.desc("origins"), F.asc("hour"), F.asc("public_ip"))


def reconcile(report: DataFrame, measure: str = "translations") -> DataFrame:
    """Rows of a report and the sum of a measure, by day and node."""
    return report.groupBy(*DAY).agg(F.count(F.lit(1)).alias("rows"), F.sum(measure).alias(measure))


def row_window_check(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count(F.lit(1)).alias("rows"), F.min("end_time").alias("first_end"), F.max("end_time").alias("last_end"))


def column_cardinality(df: DataFrame, columns: list[str], start: Column, end: Column, rsd: float = 0.01) -> DataFrame:
    """Rows that ended in [start, end), and the approximate number of values of each column, in one pass."""
    held = df.where((F.col("end_time") >= start) & (F.col("end_time") < end))
    return held.agg(F.count(F.lit(1)).alias("rows"), *(F.approx_count_distinct(c, rsd).alias(c) for c in columns))


def node_sketches(sessions: DataFrame, keys: list[str], value: str, lg_k: int = 17) -> DataFrame:
    """A sketch of the values of each day, node and key: kept, they are merged without another look at the sessions."""
    return _dated(sessions).groupBy(*DAY, *keys).agg(F.hll_sketch_agg(value, lg_k).alias("sketch"), F.count(F.lit(1)).alias("records"))


def node_bitmaps(sessions: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The same, exactly: bitmaps of the values, which are numbers that lie close together."""
    return distinct.bitmaps(_dated(sessions), [*DAY, *keys], value)


def global_uniques(source: DataFrame, keys: list[str], value: str = "private_ip") -> DataFrame:
    """Distinct values over all nodes: exactly from sessions or from what :func:`node_bitmaps` kept, or nearly from what
    :func:`node_sketches` kept."""
    if "bitmap" in source.columns:
        return distinct.counted(distinct.merged(source, ["data_date", *keys]), ["data_date", *keys], "uniques")
    if "sketch" in source.columns:
        merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
        return source.groupBy("data_date", *keys).agg(merged.alias("uniques_approx"), F.sum("records").alias("records"))
    return _dated(source).groupBy("data_date", *keys).agg(F.countDistinct(value).alias("uniques"), F.count(F.lit(1)).alias("records"))
