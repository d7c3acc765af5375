"""Inputs of the registered queries, derived from the given tables by one SQL text that Spark and DuckDB both run."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2026-08-01 00:00 at UTC-5.
S = 1785560400
NODES = [f"node-{k}" for k in range(1, 5)]
DAYS = ["2026-08-01", "2026-08-02", "2026-08-03"]

_NAT = f"""
SELECT *, CAST(floor((end_s - 18000) / 86400) AS BIGINT) AS event_day, CAST(floor((start_s - 18000) / 86400) AS BIGINT) AS start_day
FROM (SELECT *, start_s + lasts_s AS end_s FROM (
  SELECT 'node-' || CAST(l_suppkey % 4 + 1 AS STRING) AS node,
    {S} + (l_orderkey * 37 + l_linenumber * 4001 + l_partkey * 13) % 172800 AS start_s,
    CAST(floor(l_quantity) AS BIGINT) * 120 AS lasts_s,
    180879360 + l_suppkey % 16 AS router_ip, 9088 AS router_port, 0 AS protocol_id,
    167772160 + (l_partkey * 7 + l_suppkey) % 3000 AS private_ip, CAST(1024 + l_orderkey % 50000 AS INT) AS private_port,
    3355508736 + CASE WHEN l_linenumber <= 2 THEN 0 ELSE l_suppkey % 40 END AS public_ip,
    CAST(20000 + (l_orderkey * 7 + l_linenumber) % 40000 AS INT) AS public_port,
    134744072 + l_partkey % 50 AS destination_ip,
    CASE l_partkey % 6 WHEN 0 THEN 443 WHEN 1 THEN 25 WHEN 2 THEN 53 WHEN 3 THEN 8080 WHEN 4 THEN 12345 ELSE 22 END AS destination_port,
    16 + 64 * (l_linenumber % 8 + 1) AS packet_size, l_orderkey, l_linenumber
  FROM {{lineitem}}) a) b
"""


def _hex(value: str, width: int) -> str:
    return f"lpad(hex({value}), {width}, '0')"


_ADDRESSES = " || ".join(_hex(c, 8) for c in ("private_ip", "public_ip", "destination_ip"))
_PORTS = " || ".join(_hex(c, 4) for c in ("private_port", "public_port", "destination_port"))
#: By order number: 0 and 1 are too short, 2 to 5 legacy (5 with more bytes than needed), 6 and 7 lack times, the rest
#: have one to three records.
_PACKETS = f"""
SELECT l_orderkey * 8 + l_linenumber AS packet_id, start_s + 5 AS received_s, router_ip, router_port,
  CASE WHEN v = 0 THEN '000001' WHEN v = 1 THEN repeat('00', 41)
    WHEN v <= 5 THEN '00000000' || {_hex('start_s', 8)} || '00000006' || repeat('00', 8) || {_ADDRESSES} || repeat('00', 4)
      || {_PORTS} || CASE WHEN v = 5 THEN repeat('00', 37) ELSE '' END
    ELSE '00000000' || CASE WHEN v = 7 THEN '00000000' ELSE {_hex('start_s', 8)} END || repeat('00', 8)
      || repeat('00000000' || {_ADDRESSES} || '00000000' || {_PORTS} || '0000'
        || CASE WHEN v <= 7 THEN repeat('00', 8) ELSE {_hex('start_s', 8)} || {_hex('end_s', 8)} END || repeat('00', 28), n)
  END AS raw_hex, v, n, node
FROM (SELECT *, l_orderkey % 10 AS v, CAST(1 + l_linenumber % 3 AS INT) AS n FROM ({_NAT}) nat) x
"""

_EVENTS = f"""
SELECT 'host-' || CAST(user_id % 4 AS STRING) AS host, {S} + event_id % 3600 AS cohort_s,
  {S} + event_id % 3600 + CAST(floor(value) AS BIGINT) * 3 % 400 - CASE WHEN event_id % 97 = 0 THEN 5 ELSE 0 END AS done_s,
  CASE event_type WHEN 'view' THEN 'received' WHEN 'click' THEN 'parsed' WHEN 'purchase' THEN 'inserted' WHEN 'signup' THEN 'spooled' ELSE 'dropped' END AS kind,
  1 + event_id % 3 AS packets, 8 * (1 + event_id % 3) AS rows
FROM {{events}}
"""

#: Hosts grow with the users, so that a series stays short.
_TICKS = f"""
SELECT 'host-' || CAST(h AS STRING) AS host, 'drops' AS alert,
  CAST({S} AS BIGINT) + 10 * row_number() OVER (PARTITION BY h ORDER BY event_id) AS tick,
  value / 100 AS indicator, event_id % 11 <> 0 AS valid, event_id % 5 AS denominator
FROM (SELECT *, user_id % 20 + 20 * CAST(floor(user_id / 150) AS BIGINT) AS h FROM {{events}}) e
"""

_VERSIONS = f"""
SELECT 'incident-' || CAST(user_id AS STRING) AS id, 'host-' || CAST(user_id % 4 AS STRING) AS hostname,
  {S} + user_id * 600 AS start_s, value AS indicator, CASE WHEN event_id % 3 = 0 THEN 'CLEARED' ELSE 'ACTIVE' END AS state, event_id AS version
FROM {{events}}
"""

_CYCLES = f"""
SELECT 'host-' || CAST(user_id % 4 AS STRING) AS host, {S} + event_id % 3600 AS second_s,
  sum(1 + event_id % 3) AS attempted, sum(CASE WHEN value > 60 THEN 1 ELSE 0 END) AS failed, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS quarantined
FROM {{events}} GROUP BY user_id % 4, event_id % 3600
"""

#: Instant of the inventory.
NOW = S + 5000
_FILES = f"""
SELECT 'spool/batch_' || CAST(o_orderkey AS STRING) || CASE WHEN o_orderkey % 50 = 49 THEN '.tmp' ELSE '.rowbinary.done' END AS path,
  {S} + o_orderkey * 7 % 5000 AS mtime_s, 35 * (1 + o_orderkey % 40) AS length
FROM {{orders}}
"""
_SIDECARS = f"""
SELECT 'spool/batch_' || CAST(o_orderkey AS STRING) || '.rowbinary.done' AS path,
  {S} + o_orderkey * 7 % 5000 + o_custkey % 100 AS sidecar_mtime_s,
  CASE WHEN f = 1 THEN '{{{{"schema_version": 2, ' ELSE
    '{{{{"schema_version": ' || CASE WHEN f = 3 THEN '0' WHEN f = 4 THEN '3' ELSE '2' END
    || ', "created_time": "2026-08-01 00:00:00", "table_name": "' || CASE WHEN f = 5 THEN 'logs.9bad' ELSE 'logs.sessions' END
    || '", "rows": ' || CASE WHEN f = 6 THEN '0' ELSE CAST(1 + o_orderkey % 40 AS STRING) END
    || ', "bytes": ' || CAST(35 * (1 + o_orderkey % 40) + CASE WHEN f = 7 THEN 1 ELSE 0 END AS STRING)
    || ', "format": "' || CASE WHEN f = 2 THEN 'CSV' WHEN o_orderkey % 2 = 0 THEN 'RowBinary' ELSE 'rowbinary' END || '"}}}}'
  END AS sidecar
FROM (SELECT *, o_orderkey % 9 AS f FROM {{orders}}) o WHERE f <> 8
"""

#: Cumulative counters per host, a line every ten seconds, in captures of 500 lines; of every four hosts the second
#: restarts, the third loses a field now and then, the fourth falls back once, and each has a gap. Hosts grow with the
#: customers.
_LINES = f"""
SELECT host, capture, i, CASE WHEN o_custkey % 4 = 1 AND i % 1300 = 700 THEN CAST({S} + 10 * i AS STRING) || ' ' || host || ' collector: collector_started'
  WHEN i % 401 = 400 THEN 'x ' || host || ' collector: metrics live_batch_mode=true total_received=1'
  ELSE CAST({S} + 10 * i + CASE WHEN i % 500 > 300 THEN 40 ELSE 0 END AS STRING) || '.5 ' || host || ' collector: metrics live_batch_mode=true total_received=1 total_received=' || CAST(received AS STRING)
    || ' total_packet_processed=' || CAST(received - 3 AS STRING) || ' total_parsed=' || CAST(8 * received AS STRING)
    || ' total_inserted=' || CAST(8 * received - 16 - CASE WHEN o_custkey % 4 = 3 AND i % 700 = 650 THEN 500000 ELSE 0 END AS STRING)
    || CASE WHEN o_custkey % 4 = 2 AND i % 1000 > 900 THEN '' ELSE ' total_udp_kernel_drops=' || CAST(drops AS STRING) END
    || ' total_packet_queue_drops=2 total_parse_errors=' || CAST(drops * 2 AS STRING) || ' total_failed_rows_spooled=8'
    || ' queue_packet=' || CAST(o_orderkey % 90 AS STRING) || '/4096 queue_batch=' || CAST(o_orderkey % 7 AS STRING) || '/64 udp_read_batches_10s=' || CAST(o_orderkey % 5 AS STRING)
    || ' udp_full_batches_10s=' || CAST(o_orderkey % 3 AS STRING) || ' udp_receiver_packets_10s=1:' || CAST(o_orderkey % 11 AS STRING) || ',2:' || CAST(o_orderkey % 13 AS STRING) || ',3:7'
  END AS value
FROM (SELECT *, 'host-' || CAST(h AS STRING) AS host, CAST(floor(i / 500) AS BIGINT) AS capture FROM (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY o_orderkey) AS i,
    sum(1000 + o_orderkey % 50) OVER (PARTITION BY h ORDER BY o_orderkey) AS received,
    sum(o_orderkey % 3) OVER (PARTITION BY h ORDER BY o_orderkey) AS drops
  FROM (SELECT *, o_custkey % 4 + 4 * CAST(floor(o_custkey / 1500) AS BIGINT) AS h FROM {{orders}}) o) a) b
"""

#: A 32-bit counter per host, socket and day that wraps around, repeats, and at times comes late.
_DROPS = """
SELECT 'host-' || CAST(user_id % 4 AS STRING) AS host, user_id % 3 AS socket, CAST(floor(event_id / 2000) AS BIGINT) AS day, event_id AS seq,
  (4294000000 + event_id * 997 - CASE WHEN event_id % 53 = 0 THEN 200000 ELSE 0 END) % 4294967296 AS value
FROM {events}
"""

TEXTS = {
    "nat": _NAT, "packets": _PACKETS, "events": _EVENTS, "ticks": _TICKS, "versions": _VERSIONS, "cycles": _CYCLES, "files": _FILES,
    "sidecars": _SIDECARS, "lines": _LINES, "drops": _DROPS,
}


def duck(name: str) -> str:
    """The input as DuckDB SQL."""
    return TEXTS[name].format(lineitem="lineitem", events="events", orders="orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The input as Spark runs it."""
    used = set(re.findall(r"\{(lineitem|events|orders)\}", TEXTS[name]))
    return spark.sql(TEXTS[name], **{t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used})


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The NAT table with instants and its two partition columns."""
    made = table(spark, sf_dir, "nat")
    at = {"start_time": F.timestamp_seconds("start_s"), "end_time": F.timestamp_seconds("end_s"), "event_date": F.date_from_unix_date(F.col("event_day").cast("int"))}
    kinds = {"protocol_id": F.col("protocol_id").cast("smallint")}
    return made.withColumns(at | kinds)


def packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "packets")
    return made.select("packet_id", "received_s", "router_ip", "router_port", F.unhex("raw_hex").alias("payload"), "node")


def pipeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "events")
    return made.select("host", "kind", F.timestamp_seconds("cohort_s").alias("cohort_time"), F.timestamp_seconds("done_s").alias("done_time"), "packets", "rows")


#: DuckDB's date of a day number, as text.
DATE = "CAST(DATE '1970-01-01' + CAST({} AS INTEGER) AS VARCHAR)"
