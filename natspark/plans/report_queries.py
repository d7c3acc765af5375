"""Queries of sources, functions and reports, each beside its SQL."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.functions import ipv4, names, times
from natspark.operators import decode, reports, runner
from natspark.plans import inputs
from natspark.plans.inputs import DATE, DAYS, NODES, S, duck
from natspark.schema import SESSION_COLUMNS, SESSIONS
from natspark.sources import packets as packet_files
from natspark.sources import rowbinary
from natspark.sources.sessions import publish_partition, read_sessions, write_sessions
from natspark.sources.shared import new_path, stored
from natspark.streaming import ingest

# Rows of the top-k reports for each node and day.
SMTP_K, SHARING_K = 10_000, 200
DAY = datetime.date(2026, 8, 1)
ALL: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL over the CTE ``nat``."""

    def add(f):
        ALL[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH nat AS ({duck('nat')}), dated AS (SELECT *, {DATE.format('event_day')} AS data_date FROM nat)\n{sql}"
        return f

    return add


def _out(report: DataFrame) -> DataFrame:
    """Days as text and hours as seconds, so that both engines write them alike."""
    kinds = {"data_date": F.col("data_date").cast("string"), "hour": F.unix_seconds("hour") if "hour" in report.columns else None}
    return report.withColumns({c: k for c, k in kinds.items() if c in report.columns})


_HOUR = "CAST(floor(start_s / 3600) * 3600 AS BIGINT)"
_POOL = """SELECT data_date, node, public_ip, count(DISTINCT public_port) AS ports_in_use, count(*) AS translations,
  count(DISTINCT private_ip) AS subscribers FROM dated GROUP BY ALL"""
_TOP = "QUALIFY row_number() OVER (PARTITION BY data_date, node ORDER BY {}) <= {}"


@query(f"{_POOL}")
def public_ip_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.public_ip_pool(inputs.sessions(spark, sf_dir)))


_SUBSCRIBERS = """SELECT data_date, node, public_ip, private_ip, count(*) AS sessions, count(DISTINCT destination_ip) AS destinations,
  count(DISTINCT destination_port) AS destination_ports, CAST(sum(packet_size) AS BIGINT) AS total_bytes FROM dated WHERE {} GROUP BY ALL"""


@query(_SUBSCRIBERS.format("public_ip = 3355508736"))
def subscribers_of_public_ip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.subscribers_of_public_ip(inputs.sessions(spark, sf_dir), [3355508736]))


@query(_SUBSCRIBERS.format("public_ip IN (SELECT 3355508736 + s_suppkey % 40 FROM supplier WHERE s_suppkey % 3 = 1)"))
def subscribers_of_public_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").where("s_suppkey % 3 = 1")
    ips = suppliers.select((F.lit(3355508736) + F.col("s_suppkey") % 40).alias("public_ip"))
    return _out(reports.subscribers_of_public_ip(inputs.sessions(spark, sf_dir), ips))


@query(f"SELECT data_date, node, {_HOUR} AS hour, public_ip, count(*) AS sessions, count(DISTINCT private_ip) AS active_subscribers FROM dated GROUP BY ALL")
def hourly_nat_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.hourly_nat_load(inputs.sessions(spark, sf_dir)))


@query(
    f"""SELECT * FROM (SELECT data_date, node, private_ip, public_ip, destination_ip, count(*) AS sessions, CAST(sum(packet_size) AS BIGINT) AS total_bytes
  FROM dated WHERE destination_port = 25 GROUP BY ALL) t {_TOP.format('sessions DESC, private_ip, public_ip, destination_ip', SMTP_K)}"""
)
def smtp_abuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.smtp_abuse(inputs.sessions(spark, sf_dir), k=SMTP_K))


@query(
    f"""SELECT data_date, node, public_ip, destination_port, count(*) AS sessions, CAST(sum(packet_size) AS BIGINT) AS total_bytes,
  count(DISTINCT private_ip) AS subscribers FROM dated WHERE destination_port IN {reports.SERVICE_PORTS} GROUP BY ALL"""
)
def top_service_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.top_service_ports(inputs.sessions(spark, sf_dir)))


def _near(approx: str, exact: str, tolerance: float = 0.02) -> Column:
    return F.abs(F.col(approx) - F.col(exact)) <= tolerance * F.col(exact)


@query(f"SELECT data_date, node, {_HOUR} AS hour, router_ip, count(*) AS records, true AS near FROM dated WHERE start_day = event_day GROUP BY ALL")
def router_hour_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    keys = ["data_date", "node", "hour", "router_ip"]
    both = reports.router_hour_observations(made).join(reports.router_hour_observations(made, exact=True).drop("records"), keys)
    near = _near("private_ips_approx", "private_ips") & _near("public_ips_approx", "public_ips") & _near("destinations_approx", "destinations")
    return _out(both.select(*keys, "records", near.alias("near")))


@query(
    f"""SELECT data_date, node, {_HOUR} AS hour, router_ip, count(*) AS records, count(DISTINCT private_ip) AS private_ips,
  count(DISTINCT public_ip) AS public_ips, count(DISTINCT destination_ip) AS destinations FROM dated WHERE start_day = event_day GROUP BY ALL"""
)
def router_hour_observations_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.router_hour_observations(inputs.sessions(spark, sf_dir), exact=True))


_SHARING = f"""SELECT data_date, node, {_HOUR} AS hour, public_ip, count(DISTINCT router_ip * 4294967296 + private_ip) AS origins,
  count(DISTINCT router_ip) AS routers, count(*) AS records FROM dated WHERE start_day = event_day GROUP BY ALL"""


@query(f"SELECT data_date, node, least(count(*), {SHARING_K}) AS rows, true AS near, true AS among_the_first FROM ({_SHARING}) t GROUP BY ALL")
def public_ip_sharing_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's estimate against its exact count, and that count against the last one of the exact report."""
    made = inputs.sessions(spark, sf_dir)
    keys = ["data_date", "node", "hour", "public_ip"]
    exact = reports.public_ip_sharing_hour(made, k=1 << 30, exact=True)
    last = reports.public_ip_sharing_hour(made, k=SHARING_K, exact=True).groupBy("data_date", "node").agg(F.min("origins").alias("last"))
    both = reports.public_ip_sharing_hour(made, k=SHARING_K).join(exact.select(*keys, "origins"), keys).join(last, ["data_date", "node"])
    among = F.col("origins") >= 0.97 * F.col("last")
    return _out(both.groupBy("data_date", "node").agg(F.count(F.lit(1)).alias("rows"), F.every(_near("origins_approx", "origins")).alias("near"), F.every(among).alias("among_the_first")))


@query(f"SELECT * FROM ({_SHARING}) t {_TOP.format('origins DESC, hour, public_ip', SHARING_K)}")
def public_ip_sharing_hour_proven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.public_ip_sharing_hour_proven(inputs.sessions(spark, sf_dir), k=SHARING_K))


@query(f"SELECT * FROM ({_SHARING}) t {_TOP.format('origins DESC, hour, public_ip', SHARING_K)}")
def public_ip_sharing_hour_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.public_ip_sharing_hour(inputs.sessions(spark, sf_dir), k=SHARING_K, exact=True))


@query(f"SELECT data_date, node, count(*) AS rows, CAST(sum(translations) AS BIGINT) AS translations FROM ({_POOL}) t GROUP BY ALL")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.reconcile(reports.public_ip_pool(inputs.sessions(spark, sf_dir))))


_UNIQUES = "SELECT data_date, public_ip, count(DISTINCT private_ip) AS uniques, count(*) AS records FROM dated GROUP BY ALL"


@query(_UNIQUES)
def global_uniques(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _out(reports.global_uniques(inputs.sessions(spark, sf_dir), ["public_ip"]))


@query(f"SELECT data_date, public_ip, uniques, records, true AS near FROM ({_UNIQUES}) t")
def global_uniques_of_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    path = new_path(spark, "sketches")
    reports.node_sketches(made, ["public_ip"], "private_ip").write.partitionBy("node").parquet(path)
    merged = reports.global_uniques(spark.read.parquet(path), ["public_ip"])
    both = merged.join(reports.global_uniques(made, ["public_ip"]).drop("records"), ["data_date", "public_ip"])
    return _out(both.select("data_date", "public_ip", "uniques", "records", _near("uniques_approx", "uniques").alias("near")))


@query(_UNIQUES)
def global_uniques_of_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "bitmaps")
    reports.node_bitmaps(inputs.sessions(spark, sf_dir), ["public_ip"], "private_ip").write.partitionBy("node").parquet(path)
    return _out(reports.global_uniques(spark.read.parquet(path), ["public_ip"]))


@query("SELECT count(*) AS rows, min(end_s) AS first_end, max(end_s) AS last_end FROM nat")
def row_window_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = reports.row_window_check(inputs.sessions(spark, sf_dir))
    return made.select("rows", F.unix_seconds("first_end").alias("first_end"), F.unix_seconds("last_end").alias("last_end"))


@query(f"SELECT count(*) AS rows, true AS near FROM nat WHERE end_s >= {S + 36000} AND end_s < {S + 72000}")
def column_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    start, end = F.timestamp_seconds(F.lit(S + 36000)), F.timestamp_seconds(F.lit(S + 72000))
    columns = ["private_ip", "public_port", "destination_ip"]
    approx = reports.column_cardinality(made, columns, start, end)
    held = made.where((F.col("end_time") >= start) & (F.col("end_time") < end))
    exact = held.agg(*(F.countDistinct(c).alias(f"{c}_exact") for c in columns))
    near = _near(columns[0], f"{columns[0]}_exact", 0.05)
    for c in columns[1:]:
        near = near & _near(c, f"{c}_exact", 0.05)
    return approx.join(F.broadcast(exact)).select("rows", near.alias("near"))


_BEHIND = [3355508736, 3355508737, 3355508799]
_COUNTS = " UNION ALL ".join(
    f"SELECT '{case}' AS report, {sql} AS rows"
    for case, sql in {
        "public_ip_pool": "(SELECT count(*) FROM (SELECT DISTINCT node, public_ip FROM d))",
        "subscribers_of_public_ip": f"(SELECT count(*) FROM (SELECT DISTINCT node, public_ip, private_ip FROM d WHERE public_ip IN {tuple(_BEHIND)}))",
        "hourly_nat_load": f"(SELECT count(*) FROM (SELECT DISTINCT node, public_ip, {_HOUR} FROM d))",
        "smtp_abuse": "(SELECT sum(least(n, 10000)) FROM (SELECT node, count(DISTINCT (private_ip, public_ip, destination_ip)) AS n FROM d WHERE destination_port = 25 GROUP BY node))",
        "top_service_ports": f"(SELECT count(*) FROM (SELECT DISTINCT node, public_ip, destination_port FROM d WHERE destination_port IN {reports.SERVICE_PORTS}))",
        "router_hour_observations": f"(SELECT count(*) FROM (SELECT DISTINCT node, router_ip, {_HOUR} FROM d WHERE start_day = event_day))",
        "public_ip_sharing_hour": f"(SELECT sum(least(n, {SHARING_K})) FROM (SELECT node, count(DISTINCT (public_ip, {_HOUR})) AS n FROM d WHERE start_day = event_day GROUP BY node))",
        "no_such_case": "NULL",
    }.items()
)


@query(f"@, d AS (SELECT * FROM dated WHERE data_date = '{DAYS[0]}') SELECT report, CAST(coalesce(rows, -1) AS BIGINT) AS rows, rows IS NULL AS failed FROM ({_COUNTS}) t")
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven reports, and one that there isn't."""
    path, out = new_path(spark, "sessions"), new_path(spark, "reports")
    write_sessions(inputs.sessions(spark, sf_dir).select(*SESSION_COLUMNS, "node"), path)
    status = runner.run_reports(spark, path, DAY, [*runner.CASES, "no_such_case"], out, NODES, ips=_BEHIND)
    return status.select(F.col("case").alias("report"), F.coalesce("rows", F.lit(-1)).alias("rows"), F.col("error").isNotNull().alias("failed"))


@query(f"SELECT data_date, node, count(*) AS rows, CAST(sum(packet_size) AS BIGINT) AS total_bytes, min(end_s) AS first_end FROM dated WHERE data_date = '{DAYS[0]}' AND node <> 'node-4' GROUP BY ALL")
def read_sessions_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sessions")
    write_sessions(inputs.sessions(spark, sf_dir).select(*SESSION_COLUMNS, "node"), path)
    read = read_sessions(spark, path, DAY, NODES[:3])
    summed = read.groupBy(F.col("event_date").cast("string").alias("data_date"), "node")
    return summed.agg(F.count(F.lit(1)).alias("rows"), F.sum("packet_size").alias("total_bytes"), F.unix_seconds(F.min("end_time")).alias("first_end"))


@query("SELECT data_date, node, count(*) AS rows, CAST(sum(private_port) AS BIGINT) AS ports FROM dated GROUP BY ALL")
def write_sessions_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sessions")
    write_sessions(inputs.sessions(spark, sf_dir).select(*SESSION_COLUMNS, "node"), path)
    read = spark.read.parquet(path)
    return read.groupBy(F.col("event_date").cast("string").alias("data_date"), "node").agg(F.count(F.lit(1)).alias("rows"), F.sum("private_port").alias("ports"))


@query(f"SELECT * FROM ({_POOL}) t WHERE data_date <> '{DAYS[2]}'")
def publish_partition_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day is published twice, the second time over the first, and the third day then emptied."""
    path = new_path(spark, "pool")
    report = reports.public_ip_pool(inputs.sessions(spark, sf_dir))
    for day in DAYS:
        one = report.where(F.col("data_date") == F.lit(day).cast("date"))
        publish_partition(one.where("node = 'node-1'"), path, data_date=day)
        publish_partition(one if day != DAYS[2] else one.limit(0), path, data_date=day)
    return _out(spark.read.schema(report.schema).parquet(path)).select(report.columns)


_FIELDS = "private_ip, public_ip, destination_ip, private_port, public_port, destination_port"
_DECODED = f""", p AS (SELECT *, l_orderkey % 10 AS v, CAST(1 + l_linenumber % 3 AS INT) AS n, l_orderkey * 8 + l_linenumber AS packet_id FROM nat)
SELECT packet_id, CAST(r AS INT) AS record, CASE WHEN v = 7 THEN start_s + 5 ELSE start_s END AS start_s,
  CASE WHEN v = 7 THEN start_s + 5 WHEN v <= 6 THEN start_s ELSE end_s END AS end_s, router_ip, router_port,
  CASE WHEN v <= 5 THEN 6 ELSE 0 END AS protocol_id, {_FIELDS}, CASE WHEN v = 5 THEN 79 WHEN v <= 4 THEN 42 ELSE 16 + 64 * n END AS packet_size
FROM p, range(3) AS g(r) WHERE v >= 2 AND r < CASE WHEN v <= 5 THEN 1 ELSE n END"""


def _seconds(df: DataFrame) -> DataFrame:
    at = [F.unix_seconds(f"{k}_time").alias(f"{k}_s") for k in ("start", "end")]
    return df.select(*(c for c in ("packet_id", "record") if c in df.columns), *at, *(F.col(c).cast("int") if c == "protocol_id" else F.col(c) for c in SESSION_COLUMNS[2:]))


@query("@" + _DECODED)
def decode_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(decode.decode_packets(inputs.packets(spark, sf_dir)))


@query(
    """SELECT l_orderkey * 8 + l_linenumber AS packet_id, CASE l_orderkey % 10 WHEN 0 THEN 3 ELSE 41 END AS packet_size,
  CASE l_orderkey % 10 WHEN 0 THEN 'packet_too_short_for_header' ELSE 'legacy_packet_too_short' END AS reason FROM nat WHERE l_orderkey % 10 < 2"""
)
def packet_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode.packet_errors(inputs.packets(spark, sf_dir)).select("packet_id", "packet_size", "reason")


_PACKET_ROWS = f"SELECT received_s, router_ip, router_port, raw_hex FROM ({duck('packets')}) p"


def _packet_rows(packets: DataFrame) -> DataFrame:
    return packets.select("received_s", "router_ip", "router_port", F.hex("payload").alias("raw_hex"))


@query(_PACKET_ROWS)
def read_packets_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "packets-json")
    packet_files.write_packets_json(inputs.packets(spark, sf_dir), path)
    return _packet_rows(packet_files.read_packets_jsonl(spark, path))


def _captures(spark: SparkSession, sf_dir: str) -> str:
    """A folder of captures of all packets, with the beginning of one more frame at the end of each."""
    folder = new_path(spark, "captures")
    packet_files.write_captures(inputs.packets(spark, sf_dir), folder, more=CUT)
    return folder


CUT = b"\0\0\0\x30cut off"


@query(_PACKET_ROWS)
def read_packets_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In ranges far smaller than the files."""
    return _packet_rows(packet_files.read_packets_raw(spark, _captures(spark, sf_dir), 100_000)[0])


@query(f"SELECT count(*) AS packets, true AS each_cut_is_told FROM ({duck('packets')}) p")
def capture_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _captures(spark, sf_dir)
    packets, errors = packet_files.read_packets_raw(spark, folder, 100_000)
    files = spark.read.format("binaryFile").load(folder).agg(F.count(F.lit(1)).alias("files"))
    cut = errors.agg(F.count(F.lit(1)).alias("cuts"), F.countDistinct("path").alias("paths"), F.coalesce(F.every((F.col("stop") - F.col("start") == len(CUT)) & F.col("error").startswith("the last frame is cut off")), F.lit(True)).alias("alike"))
    told = (F.col("cuts") == F.col("files")) & (F.col("paths") == F.col("files")) & F.col("alike")
    return packets.agg(F.count(F.lit(1)).alias("packets")).crossJoin(files.crossJoin(cut).select(told.alias("each_cut_is_told")))


_ROWS = f"SELECT start_s, end_s, router_ip, router_port, protocol_id, {_FIELDS}, packet_size FROM nat"


@query(_ROWS)
def rowbinary_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    blobs = rowbinary.write_rowbinary(inputs.sessions(spark, sf_dir), 5000)
    return _seconds(rowbinary.decode_rowbinary(blobs.select(F.col("blob").alias("content"))))


@query(_ROWS)
def rowbinary_v1_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    old = made.select(
        F.col("end_time").alias("event_time"), "*", F.sha1(F.col("start_s").cast("string")).alias("event_id"), F.lit("nat").alias("event_type"),
        F.repeat(F.lit("h"), 200).alias("header"), names.protocol_name(F.col("protocol_id")).alias("protocol"),
    )
    blobs = rowbinary.write_rowbinary(old, 3000, version=1)
    read = rowbinary.decode_rowbinary(blobs.select(F.col("blob").alias("content")), version=1)
    return _seconds(read.where("header = repeat('h', 200) and protocol = 'unknown' and event_time = end_time and length(event_id) = 40"))


def _batch_folder(spark: SparkSession, sf_dir: str, rows_per_batch: int) -> str:
    rowbinary.register(spark)
    folder = new_path(spark, "batches")
    made = inputs.sessions(spark, sf_dir).select(*SESSION_COLUMNS)
    made.write.format("rowbinary").option("rowsPerBatch", rows_per_batch).mode("append").save(folder)
    return folder


@query(_ROWS)
def write_rowbinary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by the format's writer, read back by its reader in ranges smaller than a file."""
    folder = _batch_folder(spark, sf_dir, 50_000)
    return _seconds(spark.read.format("rowbinary").option("rangeBytes", 500_000).load(folder))


@query(_ROWS)
def stream_rowbinary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same folder as a stream."""
    folder, out = _batch_folder(spark, sf_dir, 2_000), new_path(spark, "streamed")
    stream = spark.readStream.format("rowbinary").load(folder)
    ingest.finish(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "streamed-state")))
    return _seconds(spark.read.schema(SESSIONS).parquet(out))


@query(_ROWS)
def rowbinary_v1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of schema 1, read in ranges that one pass found."""
    folder = new_path(spark, "batches-v1")
    old = inputs.sessions(spark, sf_dir).withColumns({"event_time": F.col("end_time"), "event_id": F.lit("e"), "event_type": F.lit("nat"), "header": F.repeat(F.lit("h"), 150), "protocol": F.lit("")})
    rowbinary.write_batch_files(old, folder, "b", 5000, version=1)
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    return _seconds(rowbinary.decode_ranges(stored(rowbinary.ranges_of(files, 1, range_bytes=100_000), "ranges"), 1))


@query(f"{_ROWS} WHERE end_s >= {S} AND end_s < {S + 86400}")
def migrate_v1_to_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = inputs.sessions(spark, sf_dir).withColumns({"event_time": F.col("end_time"), "header": F.lit(""), "protocol": F.lit("unknown")})
    return _seconds(decode.migrate_v1_to_v2(old, *times.day_bounds(DAY)))


@query(
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey % 3 + 100 WHEN l_linenumber % 2 <> 0 THEN l_linenumber + 200 ELSE start_s END AS seconds,
  data_date, replace(data_date, '-', '_') AS suffix, {_HOUR} AS hour_utc, {_HOUR} AS hour_lima, {S} + 86400 * (event_day - 20666) AS day_start, start_day = event_day AS in_day FROM dated""".replace(
        "20666", str((S - 18000) // 86400)
    )
)
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    a = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey") % 3 + 100).otherwise(0)
    b = F.when(F.col("l_linenumber") % 2 != 0, F.col("l_linenumber") + 200).otherwise(0)
    day = times.event_date(F.col("end_time"))
    return made.select(
        "l_orderkey", "l_linenumber", times.timestamp_fallback(a, b, F.col("start_s")).alias("seconds"), day.cast("string").alias("data_date"),
        times.day_suffix(day).alias("suffix"), F.unix_seconds(times.hour_utc(F.col("start_time"))).alias("hour_utc"),
        F.unix_seconds(times.hour_lima(F.col("start_time"))).alias("hour_lima"), F.unix_seconds(times.day_bounds(day)[0]).alias("day_start"),
        times.in_day(F.col("start_time"), day).alias("in_day"),
    )


_TEXT = "CASE WHEN l_linenumber = 1 THEN '300.1.2.' ELSE '' END || ((public_ip >> 24) & 255) || '.' || ((public_ip >> 16) & 255) || '.' || ((public_ip >> 8) & 255) || '.' || (public_ip & 255)"


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN 0 ELSE public_ip END AS number, {_TEXT} AS dotted FROM nat")
def address_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = inputs.sessions(spark, sf_dir)
    prefix = F.when(F.col("l_linenumber") == 1, "300.1.2.").otherwise("")
    dotted = F.concat(prefix, ipv4.long_to_ip(F.col("public_ip")))
    return made.select("l_orderkey", "l_linenumber", ipv4.ip_to_long(dotted).alias("number"), dotted.alias("dotted"))


@query(
    r"""SELECT o_orderkey, CASE o_orderkey % 20 WHEN 0 THEN 'unknown' WHEN 1 THEN 'icmp' WHEN 6 THEN 'tcp' WHEN 17 THEN 'udp' ELSE CAST(o_orderkey % 20 AS VARCHAR) END AS protocol,
  regexp_full_match(n, '[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?') AS valid, 'batch-' || substr(sha256(n), 1, 24) AS batch_id
FROM (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'logs.t' WHEN 1 THEN 't_' WHEN 2 THEN '9t' WHEN 3 THEN 'a.b.c' ELSE 'a-b' END || o_orderkey AS n FROM orders) t"""
)
def name_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    name = F.concat(F.element_at(F.array(*map(F.lit, ("logs.t", "t_", "9t", "a.b.c", "a-b"))), (key % 5 + 1).cast("int")), key.cast("string"))
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select("o_orderkey", names.protocol_name(key % 20).alias("protocol"), names.valid_table_name(name).alias("valid"), names.batch_id(name).alias("batch_id"))


def _tidy() -> None:
    """SQL that brings CTEs of its own goes on with the list of those before it."""
    for name, sql in SQL.items():
        head, _, tail = sql.partition("\n@,")
        SQL[name] = f"{head},{tail}" if tail else sql


_tidy()
