"""Queries of replay, telemetry, health, incidents and streams, each beside its SQL."""

from __future__ import annotations

import time

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.functions.times import event_date
from natspark.operators import health, incidents, replay, telemetry
from natspark.plans import inputs
from natspark.plans.inputs import DATE, NOW, S, duck
from natspark.schema import SESSION_COLUMNS
from natspark.sources import alerts as alert_files
from natspark.sources import packets as packet_files
from natspark.sources import rowbinary
from natspark.sources.files import listed, write_files
from natspark.sources.runs import RunTable
from natspark.sources.shared import new_path, stored
from natspark.sources.spool import list_spool
from natspark.streaming import incidents as live
from natspark.streaming import indicators, ingest

ALL: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *tables: str):
    """Register a query under its function's name, with its SQL over CTEs of the named inputs."""

    def add(f):
        ALL[f.__name__] = f
        if sql:
            ctes = ", ".join(f"{t} AS ({duck(t)})" for t in tables)
            SQL[f.__name__] = f"WITH {ctes}{', ' if ctes and sql.startswith('@') else ' '}{sql.removeprefix('@')}"
        return f

    return add


# Replay.

_JSON = """@read AS (
  SELECT f.path, f.mtime_s, f.length, s.sidecar_mtime_s, s.sidecar, s.path IS NOT NULL AS paired,
    CASE WHEN json_valid(s.sidecar) THEN s.sidecar ELSE '{}' END AS j
  FROM files f LEFT JOIN sidecars s USING (path) WHERE f.path LIKE '%.rowbinary.done'
), fields AS (
  SELECT *, CAST(coalesce(json_extract_string(j, '$.schema_version'), '0') AS INT) AS v0, coalesce(json_extract_string(j, '$.format'), '') AS fmt,
    json_extract_string(j, '$.table_name') AS table_name, CAST(coalesce(json_extract_string(j, '$.rows'), '0') AS BIGINT) AS rows,
    CAST(coalesce(json_extract_string(j, '$.bytes'), '0') AS BIGINT) AS bytes FROM read
), checked AS (
  SELECT *, CASE WHEN v0 = 0 THEN 1 ELSE v0 END AS version, CASE WHEN NOT paired OR NOT json_valid(sidecar) THEN 'json' WHEN lower(fmt) <> 'rowbinary' THEN 'format'
    WHEN v0 NOT IN (0, 1, 2) THEN 'schema_version' WHEN NOT regexp_full_match(table_name, '[A-Za-z_][A-Za-z0-9_]*([.][A-Za-z_][A-Za-z0-9_]*)?') THEN 'table_name'
    WHEN rows <= 0 THEN 'rows' WHEN bytes <= 0 THEN 'bytes' WHEN bytes <> length THEN 'size' END AS why FROM fields
), inventory AS (
  SELECT *, CASE WHEN {now} - mtime_s < 60 THEN 'too_recent' WHEN NOT paired THEN 'incomplete_pair' WHEN {now} - sidecar_mtime_s < 60 THEN 'too_recent'
    WHEN why IS NOT NULL THEN 'invalid' ELSE 'candidate' END AS class FROM checked
)
""".replace("{now}", str(NOW))


def _inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.spool_inventory(inputs.table(spark, sf_dir, "files"), inputs.table(spark, sf_dir, "sidecars"), NOW)


@query(_JSON + "SELECT path, mtime_s, class, CASE WHEN class = 'invalid' THEN why END AS reason FROM inventory", "files", "sidecars")
def spool_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inventory(spark, sf_dir).select("path", "mtime_s", "class", "reason")


@query(_JSON + "SELECT path, version, rows, why AS reason FROM checked WHERE paired", "files", "sidecars")
def validate_sidecar(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.table(spark, sf_dir, "files").join(inputs.table(spark, sf_dir, "sidecars"), "path")
    return replay.validate_sidecar(files).select("path", "version", "rows", "reason")


@query(_JSON + "SELECT path, mtime_s, rows FROM inventory WHERE class = 'candidate' ORDER BY mtime_s, path LIMIT 100", "files", "sidecars")
def select_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.select_candidates(_inventory(spark, sf_dir), 100).select("path", "mtime_s", "rows")


@query(_JSON + "SELECT why AS reason, count(*) AS files, CAST(sum(length) AS BIGINT) AS bytes FROM inventory WHERE class = 'invalid' GROUP BY ALL", "files", "sidecars")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "quarantine")
    replay.quarantine(_inventory(spark, sf_dir)).write.partitionBy("reason").parquet(path)
    return spark.read.parquet(path).groupBy("reason").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


@query(
    _JSON + """SELECT least(count(*) FILTER (class = 'candidate'), 1000) AS discovered, CAST(0 AS BIGINT) AS processed, CAST(0 AS BIGINT) AS inserted_rows, CAST(0 AS BIGINT) AS failed,
  CAST(0 AS BIGINT) AS quarantined, count(*) FILTER (class = 'incomplete_pair') AS incomplete, count(*) FILTER (class = 'too_recent') AS too_recent FROM inventory""",
    "files", "sidecars",
)
def replay_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.replay_summary(_inventory(spark, sf_dir), limit=1000)


@query(_JSON + "SELECT path, rows, length // 35 AS decoded_rows, length = rows * 35 AS agrees FROM inventory WHERE class = 'candidate' AND version = 2", "files", "sidecars")
def fixed_width_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replay.fixed_width_rows(_inventory(spark, sf_dir))


def _batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Batches of all sessions of the NAT table, as many as its parts fill: files with their content, and candidates for
    them. Batches may have equal rows, so a file is named by its number and not by its content."""
    blobs = rowbinary.write_rowbinary(inputs.sessions(spark, sf_dir), 500)
    path = new_path(spark, "spool")
    number = F.monotonically_increasing_id().cast("string")
    blobs.withColumn("path", F.concat(F.lit("spool/"), number, F.lit(".rowbinary.done"))).write.parquet(path)
    files = spark.read.parquet(path)
    candidates = files.select("path", F.col("rows"), F.lit(replay.REDUCED).alias("version"))
    return candidates, files.select("path", F.col("blob").alias("content"))


#: Files of the spool folder beside the whole batches: name, bytes, and the sidecar's text.
def _planted() -> list[tuple[str, bytes, str | None]]:
    meta = lambda n, size, version=2, kind="RowBinary": f'{{"schema_version": {version}, "table_name": "logs.sessions", "rows": {n}, "bytes": {size}, "format": "{kind}"}}'
    return [
        ("cut", bytes(36), meta(1, 36)), ("fewer", bytes(70), meta(3, 70)), ("broken", b"\1" * 57, meta(1, 57, 1)),
        ("other", bytes(35), meta(1, 35, kind="CSV")), ("short", bytes(35), meta(1, 70)), ("unread", bytes(35), "{"), ("alone", bytes(35), None),
    ]


WHOLE_BATCHES = 8


def _spool(spark: SparkSession, sf_dir: str, legacy: bool = False) -> str:
    """A spool folder: all sessions as ``WHOLE_BATCHES`` batch files with sidecars (``legacy``: some of them in schema 1),
    and files that can't be replayed."""
    rowbinary.register(spark)
    folder = new_path(spark, "spool")
    made = inputs.sessions(spark, sf_dir).select(*SESSION_COLUMNS, "l_linenumber")
    new = made.where("l_linenumber <> 1") if legacy else made
    new.select(*SESSION_COLUMNS).repartition(WHOLE_BATCHES).write.format("rowbinary").option("rowsPerBatch", 10**9).mode("append").save(folder)
    if legacy:
        old = _legacy(made.where("l_linenumber = 1"))
        rowbinary.write_batch_files(old, folder, "legacy_", 3000, version=1, sidecar={"table_name": "logs.sessions", "format": "rowbinary"})
    files = [(f"{n}{replay.DATA_SUFFIX}", bytearray(content)) for n, content, _ in _planted()]
    files += [(f"{n}{replay.DATA_SUFFIX}.json", bytearray(text.encode())) for n, _, text in _planted() if text]
    write_files(spark.createDataFrame(files, "name string, content binary"), folder)
    return folder


def _legacy(sessions: DataFrame) -> DataFrame:
    more = {"event_time": F.col("end_time"), "event_id": F.lit("e" * 40), "event_type": F.lit("nat"), "header": F.lit("h" * 130), "protocol": F.lit("tcp")}
    return sessions.withColumns(more)


def _later() -> int:
    """An instant at which no file of the spool is too young."""
    return int(time.time()) + 3600


def _replays(spark: SparkSession, sf_dir: str, legacy: bool = False, range_bytes: int = 200_000) -> tuple[replay.RunTable, str, str, list[DataFrame]]:
    """A replay that is killed after its rows are written and before they count, and two cycles after it. With ``legacy``, whose
    batches grow in number with the table, as many cycles follow as it takes to insert them all."""
    folder, aside, now = _spool(spark, sf_dir, legacy), new_path(spark, "aside"), _later()
    table = replay.RunTable(spark, new_path(spark, "replayed"))
    candidates = replay.select_candidates(replay.spool_inventory(*list_spool(spark, folder), now))
    replay.stage_replay(candidates, table, table.new_run(), range_bytes)
    summaries = [stored(replay.replay_cycle(spark, folder, table, aside, now), "summary") for _ in range(2)]
    if legacy:
        replay.replay_all(spark, folder, table, aside, now)
    table.sweep()
    return table, folder, aside, summaries


@query(
    f"""SELECT {DATE.format('event_day')} AS event_date, count(*) AS rows, CAST(sum(private_port) AS BIGINT) AS ports FROM nat GROUP BY ALL""", "nat"
)
def replay_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, *_ = _replays(spark, sf_dir, legacy=True)
    summed = replay.replayed(table).groupBy(F.col("event_date").cast("string").alias("event_date"))
    return summed.agg(F.count(F.lit(1)).alias("rows"), F.sum("private_port").alias("ports"))


#: Of the planted files three fail each time, three are invalid and one lacks its sidecar.
_CYCLES_SQL = f"""SELECT * FROM (VALUES (1, {WHOLE_BATCHES} + 3, {WHOLE_BATCHES} + 3, 1, 3, 3, 1), (2, 3, 3, 0, 3, 0, 1)) t(cycle, discovered, processed, inserts, failed, quarantined, incomplete)"""


@query(
    f"""SELECT CAST(cycle AS BIGINT) AS cycle, CAST(discovered AS BIGINT) AS discovered, CAST(processed AS BIGINT) AS processed, inserts * (SELECT count(*) FROM nat) AS inserted_rows,
  CAST(failed AS BIGINT) AS failed, CAST(quarantined AS BIGINT) AS quarantined, CAST(incomplete AS BIGINT) AS incomplete, CAST(0 AS BIGINT) AS too_recent FROM ({_CYCLES_SQL}) c""",
    "nat",
)
def replay_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, _, (first, second) = _replays(spark, sf_dir)
    number = lambda n: F.lit(n).cast("bigint").alias("cycle")
    return first.select(number(1), "*").unionByName(second.select(number(2), "*"))


@query(
    f"""SELECT class, reason, CAST(files AS BIGINT) AS files, CAST(whole * (SELECT count(*) FROM nat) + rows AS BIGINT) AS rows
  FROM (VALUES ('candidate', NULL, {WHOLE_BATCHES} + 3, 1, 5), ('invalid', 'format', 1, 0, 1), ('invalid', 'size', 1, 0, 1), ('invalid', 'json', 1, 0, 0), ('incomplete_pair', NULL, 1, 0, 0)) t(class, reason, files, whole, rows)""",
    "nat",
)
def spool_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    inventory = replay.spool_inventory(*list_spool(spark, _spool(spark, sf_dir)), _later())
    return inventory.groupBy("class", "reason").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))


@query(
    f"""SELECT place, CAST(files AS BIGINT) AS files, CAST(whole * 35 * (SELECT count(*) FROM nat) + bytes AS BIGINT) AS bytes
  FROM (VALUES ('spool', 4, 0, 36 + 70 + 57 + 35), ('done', {WHOLE_BATCHES}, 1, 0), ('format', 1, 0, 35), ('size', 1, 0, 35), ('json', 1, 0, 35)) t(place, files, whole, bytes)""",
    "nat",
)
def quarantine_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies where after two cycles."""
    _, folder, aside, _ = _replays(spark, sf_dir)
    found = None
    for place in ("spool", "done", "format", "size", "json"):
        data, _ = list_spool(spark, folder if place == "spool" else f"{aside}/{place}")
        one = data.agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")).select(F.lit(place).alias("place"), "files", "bytes")
        found = one if found is None else found.unionByName(one)
    return found


@query("SELECT count(*) AS rows, true AS all_agree FROM nat", "nat")
def verify_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded, checked = _verified(spark, sf_dir)
    agree = checked.agg(F.every("agrees").alias("all_agree"))
    return decoded.agg(F.count(F.lit(1)).alias("rows")).crossJoin(agree)


def _verified(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The decoded rows of all batches, and each batch's account."""
    candidates, contents = _batches(spark, sf_dir)
    files = replay.with_batch_id(candidates).select("path", "batch_id").join(contents, "path")
    decoded = stored(rowbinary.decode_rowbinary(files, 2, ("batch_id",)).select("batch_id", "private_port"), "decoded")
    return decoded, replay.verify_batch_rows(decoded, candidates)


# Telemetry.

_FIELD = "CAST(nullif(regexp_extract(value, '.*(?:^| ){}=([^ ]*)', 1), '') AS BIGINT)"
_SOME = ["total_received", "total_packet_processed", "total_parsed", "total_inserted", "total_udp_kernel_drops", "total_packet_queue_drops", "total_parse_errors", "total_failed_rows_spooled"]
_SAMPLES = f"""@samples AS (
  SELECT *, CAST(split_part(value, ' ', 1) AS DOUBLE) AS ts, {', '.join(f"{_FIELD.format(c)} AS {c}" for c in _SOME)} FROM lines
  WHERE value LIKE '%live_batch_mode=%' AND value NOT LIKE 'x %'
), restarts AS (SELECT host, capture, CAST(split_part(value, ' ', 1) AS DOUBLE) AS ts FROM lines WHERE value LIKE '%collector_started%')
"""


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of lines that are written first, as a log is: else each use of a line would build its text again."""
    return telemetry.parse_metric_lines(stored(inputs.table(spark, sf_dir, "lines").select("host", "capture", "value"), "lines"))


@query(
    _SAMPLES + f"SELECT host, capture, ts, 'sample' AS kind, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _SOME)} FROM samples UNION ALL SELECT host, capture, ts, 'restart', {', '.join('NULL' for _ in _SOME)} FROM restarts",
    "lines",
)
def parse_metric_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(_metrics(spark, sf_dir).select("host", "capture", "ts", "kind", *_SOME), *_SOME)


_DELTA = "CAST({0} - lag({0}) OVER w AS DOUBLE) AS {1}_delta"


def _doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Counters that may be missing, as doubles: readers of both engines take them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def _cast(columns: list[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)



@query(
    _SAMPLES + f"""SELECT *, CASE WHEN interval_s > 0 THEN received_delta / interval_s END AS received_pps, CASE WHEN interval_s > 0 THEN parsed_delta / interval_s END AS parsed_rps,
  CASE WHEN interval_s > 0 THEN inserted_delta / interval_s END AS inserted_rps FROM (SELECT host, capture, ts, ts - lag(ts) OVER w AS interval_s,
  {_DELTA.format('total_received', 'received')}, {_DELTA.format('total_packet_processed', 'processed')}, {_DELTA.format('total_parsed', 'parsed')}, {_DELTA.format('total_inserted', 'inserted')}
  FROM samples WINDOW w AS (PARTITION BY host, capture ORDER BY ts)) t""",
    "lines",
)
def metric_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(telemetry.metric_deltas(_metrics(spark, sf_dir)), *(f"{c}_delta" for c in ("received", "processed", "parsed", "inserted")))


_CAPTURES = f"""SELECT host, capture, CAST(min(s) AS DOUBLE) + CASE WHEN capture = 1 AND host = 'host-0' THEN 10 ELSE 0 END + 0.5 AS expected_first,
  CAST(max(s) AS DOUBLE) + CASE WHEN capture = 2 AND host = 'host-0' THEN 100 ELSE 0 END + 10 AS capture_end
FROM (SELECT host, capture, {S} + 10 * i + CASE WHEN i % 500 > 300 THEN 40 ELSE 0 END AS s, i FROM {{lines}}) t GROUP BY host, capture"""


@query(
    _SAMPLES + f""", captures AS ({_CAPTURES.format(lines='lines')}), marked AS (
  SELECT host, capture, ts, ts - lag(ts) OVER w AS step, {' OR '.join(f'coalesce({c} < last_value({c} IGNORE NULLS) OVER p, false)' for c in _SOME)} AS fell
  FROM samples WINDOW w AS (PARTITION BY host, capture ORDER BY ts), p AS (PARTITION BY host, capture ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), summed AS (
  SELECT host, capture, count(*) AS samples, count(*) FILTER (step > 30) AS gaps, min(ts) AS first_ts, max(ts) AS last_ts, bool_or(fell) AS fell, coalesce(bool_or(step <= 0), false) AS stuck
  FROM marked GROUP BY ALL
), restarted AS (SELECT host, capture, max(ts) AS restart_ts FROM restarts GROUP BY ALL)
SELECT host, capture, samples, gaps, reason IS NULL AS valid, reason FROM (
  SELECT host, capture, coalesce(samples, 0) AS samples, coalesce(gaps, 0) AS gaps, CASE WHEN coalesce(samples, 0) < 2 THEN 'samples'
    WHEN fell OR stuck OR coalesce(restart_ts > first_ts, false) THEN 'restart' WHEN abs(first_ts - expected_first) > 0.00001 THEN 'first' WHEN capture_end - last_ts > 30 THEN 'end' END AS reason
  FROM captures LEFT JOIN summed USING (host, capture) LEFT JOIN restarted USING (host, capture)) t""".replace(_SAMPLES + ", ", _SAMPLES),
    "lines",
)
def capture_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = spark.sql(_CAPTURES.format(lines="{lines}"), lines=inputs.table(spark, sf_dir, "lines"))
    return telemetry.capture_validity(_metrics(spark, sf_dir), captures)


_SUMMARY = f"""summary AS (
  SELECT host, capture, count(*) AS samples, max(ts) - min(ts) AS duration_s, CAST(max(CAST(regexp_extract(value, 'queue_packet=([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS max_queue_packet,
    {', '.join(f'CASE WHEN count({c}) = count(*) THEN arg_min({c}, ts) END AS first_{c}, CASE WHEN count({c}) = count(*) THEN arg_max({c}, ts) END AS last_{c}' for c in _SOME)}
  FROM samples GROUP BY host, capture
), deltas AS (SELECT *, {', '.join(f'last_{c} - first_{c} AS {c}' for c in _SOME)} FROM summary)
"""


@query(
    _SAMPLES + ", " + _SUMMARY + f"""SELECT host, capture, samples, duration_s, max_queue_packet, {_cast(_SOME)}, CASE WHEN duration_s > 0 THEN total_received / duration_s END AS received_pps,
  CASE WHEN total_packet_processed > 0 THEN 100 * total_parse_errors / total_packet_processed END AS parse_error_pct,
  CASE WHEN total_received + total_udp_kernel_drops > 0 THEN 100 * total_udp_kernel_drops / (total_received + total_udp_kernel_drops) END AS drop_pct FROM deltas""",
    "lines",
)
def capture_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(telemetry.capture_summary(_metrics(spark, sf_dir)), *_SOME).select("host", "capture", "samples", "duration_s", "max_queue_packet", *_SOME, "received_pps", "parse_error_pct", "drop_pct")


_BALANCES = [(p, k, n) for k, kind in enumerate(("packets", "rows")) for p, n in (("first_", f"first_{kind}"), ("last_", f"last_{kind}"), ("", f"{kind}_change"))]


def _balance(prefix: str) -> tuple[str, str]:
    return (
        f"{prefix}total_received - {prefix}total_packet_processed - {prefix}total_packet_queue_drops",
        f"{prefix}total_parsed - {prefix}total_inserted - {prefix}total_failed_rows_spooled",
    )


@query(
    _SAMPLES + ", " + _SUMMARY + f"""SELECT host, capture, {', '.join(f"CAST({_balance(p)[k]} AS DOUBLE) AS {n}" for p, k, n in _BALANCES)} FROM deltas""",
    "lines",
)
def pipeline_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubles(telemetry.pipeline_balance(telemetry.capture_summary(_metrics(spark, sf_dir))), *(n for _, _, n in _BALANCES))


@query(
    _SAMPLES + f""", newest AS (SELECT host, arg_max(value, ts) AS value FROM samples GROUP BY host), shown AS (SELECT * FROM (VALUES {', '.join(f"({i + 1}, '{n}')" for i, n in enumerate(telemetry.SHOWN))}) t(place, name))
SELECT host, place, name, CASE WHEN contains(value, ' ' || name || '=') THEN regexp_extract(value, '.* ' || name || '=([^ ]*)', 1) END AS value FROM newest, shown""",
    "lines",
)
def latest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.latest_metrics(_metrics(spark, sf_dir))


#: An instant after every line; some come over a minute after the last sample of their host.
_ASKED = f"SELECT host, i, CAST({S} + 10 * i + (i % 9) * 15 AS DOUBLE) + 0.25 AS at FROM {{lines}}"


@query(
    _SAMPLES + f""", asked AS ({_ASKED.format(lines='lines')}), one AS (SELECT host, ts, max(total_received) AS received, arg_max(total_parsed, total_received) AS parsed FROM samples GROUP BY host, ts)
SELECT a.host, a.i, coalesce(CASE WHEN a.at - o.ts <= 60 THEN o.ts END, -1) AS ts, CAST(coalesce(CASE WHEN a.at - o.ts <= 60 THEN o.received END, -1) AS BIGINT) AS received,
  CAST(coalesce(CASE WHEN a.at - o.ts <= 60 THEN o.parsed END, -1) AS BIGINT) AS parsed FROM asked a ASOF LEFT JOIN one o ON a.host = o.host AND a.at >= o.ts""".replace(_SAMPLES + ", ", _SAMPLES),
    "lines",
)
def metrics_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = spark.sql(_ASKED.format(lines="{lines}"), lines=inputs.table(spark, sf_dir, "lines"))
    found = telemetry.metrics_at(_metrics(spark, sf_dir), asked)
    field = lambda c: F.coalesce(F.col("fields")[c].cast("bigint"), F.lit(-1).cast("bigint"))
    return found.select("host", "i", F.coalesce("ts", F.lit(-1.0)).alias("ts"), field("total_received").alias("received"), field("total_parsed").alias("parsed"))


@query(
    _SAMPLES + """SELECT host, capture, ts, count(n) AS sockets, min(n) AS least, max(n) AS most, CAST(sum(n) AS BIGINT) AS packets,
  CASE WHEN any_value(b) > 0 THEN sum(n) / any_value(b) ELSE 0 END AS average_batch, CASE WHEN any_value(b) > 0 THEN any_value(f) * 100 / any_value(b) ELSE 0 END AS full_batch_pct FROM (
  SELECT host, capture, ts, CAST(regexp_extract(value, 'udp_read_batches_10s=([0-9]+)', 1) AS BIGINT) AS b, CAST(regexp_extract(value, 'udp_full_batches_10s=([0-9]+)', 1) AS BIGINT) AS f,
    CAST(split_part(unnest(string_split(regexp_extract(value, 'udp_receiver_packets_10s=([^ ]*)', 1), ',')), ':', 2) AS BIGINT) AS n FROM samples) t GROUP BY host, capture, ts""",
    "lines",
)
def socket_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.socket_distribution(_metrics(spark, sf_dir))


@query(
    """@RECURSIVE_ordered AS (SELECT *, row_number() OVER (PARTITION BY host, socket, day ORDER BY seq) AS rn FROM drops), folded AS (
  SELECT host, socket, day, seq, rn, value AS base, value AS increment FROM ordered WHERE rn = 1
  UNION ALL SELECT o.host, o.socket, o.day, o.seq, o.rn, CASE WHEN (o.value - f.base + 4294967296) % 4294967296 > 2147483648 THEN f.base ELSE o.value END,
    CASE WHEN (o.value - f.base + 4294967296) % 4294967296 > 2147483648 THEN 0 ELSE (o.value - f.base + 4294967296) % 4294967296 END
  FROM folded f JOIN ordered o ON o.host = f.host AND o.socket = f.socket AND o.day = f.day AND o.rn = f.rn + 1
) SELECT host, socket, day, seq, increment FROM folded""".replace("@RECURSIVE_", "@"),
    "drops",
)
def counter_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry.counter_increments(inputs.table(spark, sf_dir, "drops"), ["host", "socket", "day"])


SQL["counter_increments"] = SQL["counter_increments"].replace("WITH ", "WITH RECURSIVE ", 1)


# Health. Events are few here, so the least numbers are 1.

_PACKETS = {k: p for k, (p, _) in health.KINDS.items() if p} | {}
_COUNTS = ", ".join(
    f"CAST(sum(CASE WHEN kind = '{kind}' THEN {value} ELSE 0 END) AS BIGINT) AS {counter}"
    for kind, pair in health.KINDS.items() for counter, value in zip(pair, ("packets", "rows")) if counter
)
_COHORTS = f"cohorts AS (SELECT host, cohort_s AS second, {_COUNTS} FROM ev GROUP BY ALL)"
#: Ticks of windows that hold a second: the six multiples of ten that follow it.
_WINDOWS = f"""windows AS (SELECT host, (CAST(floor(second / 10) AS BIGINT) + k) * 10 AS tick, {', '.join(f'CAST(sum({c}) AS BIGINT) AS {c}' for c in health.COUNTERS)}
  FROM cohorts, range(1, 7) AS r(k) GROUP BY ALL)"""
_EV = f"@ev AS ({duck('events')}), "


def _seconds(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.sliding_indicator(health.cohort_counts(inputs.pipeline_events(spark, sf_dir)))


@query(_EV + _COHORTS + " SELECT * FROM cohorts")
def cohort_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.cohort_counts(inputs.pipeline_events(spark, sf_dir)), "second")


@query(_EV + "x AS (SELECT 1) SELECT host, kind, count(*) AS events, CAST(sum(rows) AS BIGINT) AS rows FROM ev WHERE kind NOT IN ('inserted', 'spooled', 'spool_failed') OR (done_s - cohort_s >= -1 AND done_s - cohort_s < 300) GROUP BY ALL")
def retain_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = health.retain_late(inputs.pipeline_events(spark, sf_dir), health.retention())
    return kept.groupBy("host", "kind").agg(F.count(F.lit(1)).alias("events"), F.sum("rows").alias("rows"))


@query(_EV + _COHORTS + ", " + _WINDOWS + " SELECT *, tick - 60 AS window_start FROM windows")
def sliding_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(_windows(spark, sf_dir), "tick", "window_start")


def _starts(spark: SparkSession) -> DataFrame:
    return spark.range(4).select(F.concat(F.lit("host-"), F.col("id").cast("string")).alias("host"), F.timestamp_seconds(F.lit(S) + 100 * F.col("id")).alias("start_time"))


_START = f"tick - 60 >= {S} + 100 * CAST(substr(host, 6) AS BIGINT)"
_PCT = "CASE WHEN {d} = 0 THEN 0.0 ELSE {n} * CAST(100 AS DOUBLE) / {d} END"


@query(
    _EV + _COHORTS + ", " + _WINDOWS + f""" SELECT host, tick, tick - 60 AS window_start, {_PCT.format(n='kernel_drops', d='(received_packets + kernel_drops)')} AS indicator,
  kernel_drops AS numerator, received_packets + kernel_drops AS denominator, received_packets + kernel_drops >= 30 AND {_START} AS valid FROM windows"""
)
def drop_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.drop_rate(_windows(spark, sf_dir), 30, _starts(spark)), "tick", "window_start")


@query(
    _EV + _COHORTS + ", " + _WINDOWS + f""" SELECT h.host, t.tick, t.tick - 60 AS window_start, CASE WHEN coalesce(received_packets, 0) = 0 THEN 100.0 ELSE 0.0 END AS indicator,
  CAST(CASE WHEN coalesce(received_packets, 0) = 0 THEN 1 ELSE 0 END AS BIGINT) AS numerator, CAST(1 AS BIGINT) AS denominator, t.tick - 60 >= {S} + 100 * CAST(substr(h.host, 6) AS BIGINT) AS valid
  FROM (SELECT DISTINCT host FROM ev) h CROSS JOIN (SELECT {S} + 10 * i AS tick FROM range(501) AS r(i)) t LEFT JOIN windows w ON w.host = h.host AND w.tick = t.tick"""
)
def no_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    windows = _windows(spark, sf_dir)
    hosts = inputs.pipeline_events(spark, sf_dir).select("host").distinct()
    made = health.no_traffic(windows, health.tick_spine(hosts, S, S + 5000), starts=_starts(spark))
    return _seconds(made, "tick", "window_start")


def _sla_sql(whole: tuple[str, str], done: tuple[str, str]) -> str:
    total = lambda kind, value: f"CAST(sum(CASE WHEN kind = '{kind}' AND done_s <= tick THEN {value} ELSE 0 END) AS BIGINT)"
    return _EV + f"""known AS (SELECT host, tick, {total(*whole)} AS denominator, {total(*done)} AS good FROM (
    SELECT *, (CAST(floor(cohort_s / 10) AS BIGINT) + k) * 10 + 60 AS tick FROM ev, range(1, 7) AS r(k) WHERE kind IN ('{whole[0]}', '{done[0]}')) t GROUP BY ALL)
  SELECT host, tick, tick - 120 AS window_start, {_PCT.format(n='greatest(denominator - good, 0)', d='denominator')} AS indicator, greatest(denominator - good, 0) AS numerator, denominator, denominator >= 10 AS valid FROM known"""


@query(_sla_sql(("received", "packets"), ("parsed", "packets")))
def parse_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.parse_sla(inputs.pipeline_events(spark, sf_dir), min_packets=10), "tick", "window_start")


@query(_sla_sql(("parsed", "rows"), ("inserted", "rows")))
def insert_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.insert_sla(inputs.pipeline_events(spark, sf_dir), min_rows=10), "tick", "window_start")


_CYCLES = """w AS (SELECT host, CAST(ceil(second_s / 10) AS BIGINT) * 10 + 10 * k AS tick, CAST(sum(attempted) AS BIGINT) AS attempted, CAST(sum(failed) AS BIGINT) AS failed, CAST(sum(quarantined) AS BIGINT) AS quarantined
  FROM cycles, range(6) AS r(k) GROUP BY ALL)"""


@query(f"@{_CYCLES} SELECT host, tick, {_PCT.format(n='failed', d='attempted')} AS indicator, failed AS numerator, attempted AS denominator FROM w", "cycles")
def replay_failure_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.replay_failure_rate(_cycles(spark, sf_dir)), "tick")


@query(f"@{_CYCLES} SELECT host, tick, {_PCT.format(n='quarantined', d='(attempted + quarantined)')} AS indicator, quarantined AS numerator, attempted + quarantined AS denominator FROM w", "cycles")
def replay_quarantine_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(health.replay_quarantine_rate(_cycles(spark, sf_dir)), "tick")


def _cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.table(spark, sf_dir, "cycles").withColumn("second", F.timestamp_seconds("second_s"))


@query(
    f"""SELECT {_PCT.format(n='numerator', d='denominator')} AS indicator, numerator, denominator FROM (SELECT count(*) FILTER ({NOW} - mtime_s >= 60) AS denominator,
  count(*) FILTER ({NOW} - mtime_s >= 300) AS numerator FROM files WHERE path LIKE '%.rowbinary.done') t""",
    "files",
)
def replay_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.table(spark, sf_dir, "files")
    return health.replay_backlog(files.where(F.col("path").endswith(replay.DATA_SUFFIX)), NOW)


# Incidents.


def _incident_sql(rows: str, breach: str, clear: str, trigger: int, clear_n: int) -> str:
    run = lambda hit: f"rn - coalesce(max(CASE WHEN NOT ({hit}) THEN rn END) OVER p, 0)"
    p = "WINDOW p AS (PARTITION BY host, alert ORDER BY tick ROWS UNBOUNDED PRECEDING)"
    return f"""@n AS (SELECT *, row_number() OVER (PARTITION BY host, alert ORDER BY tick) AS rn FROM ticks WHERE {rows}),
r AS (SELECT *, {run(breach)} AS rb, {run(clear)} AS rc FROM n {p}),
m AS (SELECT *, coalesce(max(CASE WHEN rb >= {trigger} THEN rn END) OVER p, 0) > coalesce(max(CASE WHEN rb < {trigger} AND rc >= {clear_n} THEN rn END) OVER p, 0) AS open FROM r {p}),
b AS (SELECT *, coalesce(lag(open) OVER (PARTITION BY host, alert ORDER BY tick), false) AS was FROM m),
i AS (SELECT *, sum(CASE WHEN open AND NOT was THEN 1 ELSE 0 END) OVER p AS incident FROM b {p})
SELECT host, alert, CAST(incident AS BIGINT) AS incident, min(tick) AS start_tick, max(CASE WHEN NOT open THEN tick END) AS end_tick, max(indicator) AS peak FROM i WHERE open OR was GROUP BY ALL"""


_INCIDENTS = _incident_sql("valid", "indicator >= 1", "indicator < 0.2", 2, 2)


def _ended(df: DataFrame) -> DataFrame:
    """Open incidents end at -1, so that the column stays whole-numbered for every reader."""
    return df.withColumn("end_tick", F.coalesce("end_tick", F.lit(-1)))


def _ended_sql(sql: str) -> str:
    return sql.replace("max(CASE WHEN NOT open THEN tick END) AS end_tick", "coalesce(max(CASE WHEN NOT open THEN tick END), -1) AS end_tick")


@query(_ended_sql(_INCIDENTS), "ticks")
def incidents_with_hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ended(incidents.incidents(inputs.table(spark, sf_dir, "ticks"), 1.0, 0.2, 2, 2))


@query(_ended_sql(_incident_sql("true", "indicator >= 1 AND denominator >= 1", "indicator < 0.2", 1, 3)), "ticks")
def replay_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ended(incidents.replay_incidents(inputs.table(spark, sf_dir, "ticks"), 1.0, 0.2))


def _folded_sql(rows: str, trigger: int, clear_n: int, update_s: int, min_batches: int) -> str:
    """The fold tick by tick: ``emits`` and ``ends`` tell whether a version is due at this tick, and the last one."""
    return f"""@n AS (SELECT *, row_number() OVER (PARTITION BY host, alert ORDER BY tick) AS rn FROM ticks WHERE {rows}),
folded AS (
  SELECT DISTINCT host, alert, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS tick, false AS active, 0 AS breaches, 0 AS clears, CAST(0 AS BIGINT) AS incident,
    CAST(0 AS BIGINT) AS start, CAST(0 AS DOUBLE) AS peak, CAST(0 AS BIGINT) AS emitted, false AS dirty, CAST(0 AS BIGINT) AS version, false AS emits, false AS ends FROM n
  UNION ALL
  SELECT host, alert, rn, tick, opens OR (active AND NOT ends), CASE WHEN opens THEN 0 ELSE breaches END, CASE WHEN opens THEN 0 ELSE clears END,
    incident + CAST(opens AS BIGINT), CASE WHEN opens THEN tick ELSE start END, CASE WHEN opens OR rises THEN indicator ELSE peak END,
    CASE WHEN emits THEN tick ELSE emitted END, dirty AND NOT emits, version + CAST(emits AS BIGINT), emits, ends
  FROM (SELECT *, opens OR ends OR (seen AND active AND dirty AND tick - emitted >= {update_s}) AS emits
    FROM (SELECT *, seen AND NOT active AND breaches >= {trigger} AS opens, seen AND active AND clears >= {clear_n} AS ends
      FROM (SELECT host, alert, n.rn, n.tick, n.indicator, active, incident, start, peak, emitted, version, n.denominator >= {min_batches} OR active AS seen,
          seen AND active AND n.indicator > peak AS rises, dirty OR rises AS dirty,
          CASE WHEN active OR NOT seen THEN breaches WHEN n.indicator >= 1 THEN breaches + 1 ELSE 0 END AS breaches,
          CASE WHEN NOT active THEN clears WHEN n.indicator < 0.2 THEN clears + 1 ELSE 0 END AS clears
        FROM folded f JOIN n USING (host, alert) WHERE n.rn = f.rn + 1) a) b) c
)"""


@query(
    _folded_sql("true", 2, 3, 0, 1)
    + " SELECT host, alert, incident, max(start) AS start_tick, max(CASE WHEN ends THEN tick ELSE -1 END) AS end_tick, max(peak) AS peak FROM folded WHERE active OR ends GROUP BY ALL",
    "ticks",
)
def replay_incidents_of_two_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ended(incidents.replay_incidents(inputs.table(spark, sf_dir, "ticks"), 1.0, 0.2, trigger=2))


@query(
    _folded_sql("valid", 2, 2, 60, 0)
    + """ SELECT host, alert, incident, version, tick AS emitted_tick, start AS start_tick, CASE WHEN ends THEN tick ELSE -1 END AS end_tick, peak,
  CASE WHEN ends THEN 'CLEARED' ELSE 'ACTIVE' END AS state FROM folded WHERE emits""",
    "ticks",
)
def incident_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ended(incidents.incident_versions(inputs.table(spark, sf_dir, "ticks"), 1.0, 0.2, 2, 2))


for _name in ("replay_incidents_of_two_ticks", "incident_versions"):
    SQL[_name] = SQL[_name].replace("WITH ", "WITH RECURSIVE ", 1)


@query("SELECT * FROM (SELECT * FROM versions QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1) t ORDER BY start_s DESC, id LIMIT 100", "versions")
def latest_incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incidents.latest_incident(inputs.table(spark, sf_dir, "versions"), newest="start_s")


@query("SELECT id, count(*) AS versions, max(version) AS newest, max(start_s) AS start_s FROM versions GROUP BY id", "versions")
def write_alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "alerts")
    none = F.lit(None)
    records = inputs.table(spark, sf_dir, "versions").select(
        "id", "hostname", none.cast("string").alias("ip"), F.timestamp_seconds("start_s").alias("start_time"), none.cast("timestamp").alias("end_time"),
        F.lit("drops").alias("name"), F.lit(1.0).alias("threshold"), "indicator", "state", F.timestamp_seconds("start_s").alias("sent_at"), "version",
    )
    for part in (0, 1):
        alert_files.write_alert_records(records.where(F.col("version") % 2 == part), path, "json")
    read = alert_files.read_alert_records(spark, path, "json")
    return read.groupBy("id").agg(F.count(F.lit(1)).alias("versions"), F.max("version").alias("newest"), F.unix_seconds(F.max("start_time")).alias("start_s"))


# Streams, run until all that is there is read.


@query(
    f"""SELECT {DATE.format('day')} AS event_date, count(*) AS rows, CAST(sum(private_port) AS BIGINT) AS ports FROM (
  SELECT CASE WHEN v = 7 THEN CAST(floor((start_s + 5 - 18000) / 86400) AS BIGINT) WHEN v <= 6 THEN start_day ELSE event_day END AS day, private_port, CASE WHEN v <= 5 THEN 1 ELSE n END AS k
  FROM (SELECT *, l_orderkey % 10 AS v, 1 + l_linenumber % 3 AS n FROM nat) a WHERE v >= 2) t, range(3) AS g(r) WHERE r < k GROUP BY ALL""",
    "nat",
)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, out = new_path(spark, "captures"), new_path(spark, "ingested")
    packet_files.write_packets_json(inputs.packets(spark, sf_dir), source)
    stream = packet_files.stream_packets_jsonl(spark, source)
    ingest.stream_ingest(stream, out, new_path(spark, "ingest-state"), "node-1", once=True).awaitTermination()
    read = spark.read.parquet(out)
    return read.groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count(F.lit(1)).alias("rows"), F.sum("private_port").alias("ports"))


@query()
def stream_ingest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Micro-batches bounded by bytes, whose files are merged between two runs of the stream and after them."""
    source, out, state = new_path(spark, "captures"), new_path(spark, "ingested"), new_path(spark, "ingest-state")
    packets = inputs.packets(spark, sf_dir)
    part = F.pmod(F.xxhash64("payload", "received_s"), F.lit(2))
    for k in (0, 1):
        packet_files.write_packets_json(packets.where(part == k), source)
        # Some four micro-batches a run, and more of what is larger than 1 GB.
        written = sum(f.size for f in listed(source)) // (k + 1)
        stream = packet_files.stream_packets_jsonl(spark, source, bytes_per_trigger=min(max(1, written // 4), 256 << 20))
        ingest.finish(ingest.SessionSink(out, "captures", "node-1").writer(stream, state))
        ingest.compact(spark, out)
    table = RunTable(spark, out)
    days = ingest.ingested(spark, out).groupBy(F.col("event_date").cast("string").alias("event_date")).agg(F.count(F.lit(1)).alias("rows"), F.sum("private_port").alias("ports"))
    days = stored(days, "days")
    # A file a day is all that is left, and more only of days that fill several.
    return days.withColumn("bounded", F.lit(table.is_compact("sessions", days.count())))


SQL["stream_ingest_compacted"] = f"SELECT *, true AS bounded FROM ({SQL['stream_ingest']}) ingested"


def _run(stream: DataFrame, out: str, state: str) -> DataFrame:
    """The rows that a stream has appended when its source is read."""
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
    writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


@query("SELECT received_s, count(*) AS packets FROM (SELECT DISTINCT received_s, router_ip, raw_hex FROM packets) t GROUP BY ALL", "packets")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every packet arrives twice, out of order: by two streams over one folder, so that its copies come from tasks of their own."""
    source = new_path(spark, "packets")
    packets = inputs.packets(spark, sf_dir)
    packets.write.option("compression", "zstd").option("maxRecordsPerFile", 500_000).parquet(source)
    one, other = (spark.readStream.schema(packets.schema).parquet(source) for _ in range(2))
    stream = one.unionByName(other).withColumn("received_time", F.timestamp_seconds("received_s"))
    # Seconds are all that is counted: payloads go into the hash, and not through the exchange and the sink.
    once = ingest.stream_dedup(stream, "4 days").select(F.unix_seconds("received_time").alias("received_s"))
    return _run(once, new_path(spark, "deduped"), new_path(spark, "deduped-state")).groupBy("received_s").agg(F.count(F.lit(1)).alias("packets"))


@query(_ended_sql(_INCIDENTS), "ticks")
def stream_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks from many files in no order; a last one far ahead, of a series of its own, lets the watermark pass them all."""
    source, out, state = new_path(spark, "ticks"), new_path(spark, "incidents"), new_path(spark, "incidents-state")
    ticks = inputs.table(spark, sf_dir, "ticks")
    ticks.repartition(spark.sparkContext.defaultParallelism).write.parquet(source)
    newest = ticks.agg((F.max("tick") + 1_000_000).alias("tick"))
    fields = {"host": "none", "alert": "none", "indicator": 0, "valid": False, "denominator": 0}
    last = newest.select("tick", *(F.lit(v).cast(ticks.schema[k].dataType).alias(k) for k, v in fields.items()))
    stream = spark.readStream.schema(ticks.schema).parquet(source)
    _run(live.stream_incidents(stream, 1.0, 0.2, 2, 2, update_s=0), out, state)
    last.write.mode("append").parquet(source)
    versions = _run(live.stream_incidents(stream, 1.0, 0.2, 2, 2, update_s=0), out, state)
    last = versions.groupBy("host", "alert", "incident").agg(F.max_by(F.struct("start_tick", "end_tick", "peak"), "version").alias("x"))
    return _ended(last.select("host", "alert", "incident", "x.*"))


@query(_EV + _COHORTS + " SELECT second, CAST(sum(received_packets) AS BIGINT) AS received FROM cohorts GROUP BY ALL")
def stream_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-second cohorts of a stream, closed by its watermark; a last event far ahead closes them all."""
    source, out, state = new_path(spark, "events"), new_path(spark, "cohorts"), new_path(spark, "cohorts-state")
    events = inputs.pipeline_events(spark, sf_dir)
    events.write.parquet(source)
    late = events.limit(1).select("host", F.lit("none").alias("kind"), F.timestamp_seconds(F.lit(S + 1_000_000)).alias("cohort_time"), F.timestamp_seconds(F.lit(S + 1_000_000)).alias("done_time"), "packets", "rows")
    stream = live.watermarked(spark.readStream.schema(events.schema).parquet(source))
    counted = stream.groupBy("host", F.window("cohort_time", "1 second").alias("w")).agg(F.sum(F.when(F.col("kind") == "received", F.col("packets")).otherwise(0)).alias("received"))
    _run(counted, out, state)
    late.write.mode("append").parquet(source)
    return _run(counted, out, state).groupBy(F.unix_seconds("w.start").alias("second")).agg(F.sum("received").alias("received"))


#: Until where ticks of the live indicators run: the flushing event less the delay.
_LAST, _DELAY = S + 8000, 2000
_LIVE = _EV + f"""spine AS (SELECT host, CAST(unnest(range(first, {_LAST} + 1, 10)) AS BIGINT) AS tick FROM (SELECT host, CAST(ceil(min(done_s) / 10) AS BIGINT) * 10 AS first
    FROM ev WHERE kind IN ('received', 'parsed', 'inserted', 'dropped') GROUP BY host) f),
near AS (SELECT host, tick, sum(CASE WHEN kind = 'received' THEN packets ELSE 0 END) AS received, sum(CASE WHEN kind = 'dropped' THEN packets ELSE 0 END) AS dropped
  FROM (SELECT *, (CAST(floor(cohort_s / 10) AS BIGINT) + k) * 10 AS tick FROM ev, range(1, 7) AS r(k)) t WHERE done_s <= tick GROUP BY ALL),
late AS (SELECT host, tick, sum(CASE WHEN kind = 'received' THEN packets ELSE 0 END) AS received, sum(CASE WHEN kind = 'parsed' THEN packets ELSE 0 END) AS parsed,
  sum(CASE WHEN kind = 'parsed' THEN rows ELSE 0 END) AS expected, sum(CASE WHEN kind = 'inserted' THEN rows ELSE 0 END) AS inserted
  FROM (SELECT *, (CAST(floor(cohort_s / 10) AS BIGINT) + k) * 10 + 60 AS tick FROM ev, range(1, 7) AS r(k)) t WHERE done_s <= tick GROUP BY ALL),
counted AS (
  SELECT host, 'no_traffic' AS alert, tick, tick - 60 AS window_start, CASE WHEN coalesce(received, 0) = 0 THEN 1 ELSE 0 END AS n, 1 AS d, 1 AS least FROM spine LEFT JOIN near USING (host, tick)
  UNION ALL SELECT host, 'drop_rate', tick, tick - 60, coalesce(dropped, 0), coalesce(received + dropped, 0), 30 FROM spine LEFT JOIN near USING (host, tick)
  UNION ALL SELECT host, 'parse_sla', tick, tick - 120, greatest(coalesce(received - parsed, 0), 0), coalesce(received, 0), 30 FROM spine LEFT JOIN late USING (host, tick)
  UNION ALL SELECT host, 'insert_sla', tick, tick - 120, greatest(coalesce(expected - inserted, 0), 0), coalesce(expected, 0), 100 FROM spine LEFT JOIN late USING (host, tick))
SELECT host, alert, tick, window_start, {_PCT.format(n='n', d='d')} AS indicator, CAST(n AS BIGINT) AS numerator, CAST(d AS BIGINT) AS denominator, d >= least AS valid FROM counted WHERE """


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four indicators from events in no order within the delay, read over a restart of the stream; a last event, of a
    host without indicators, lets the watermark pass the last tick."""
    source, out, state = new_path(spark, "events"), new_path(spark, "indicators"), new_path(spark, "indicators-state")
    # Written first, so that every part is cut from the same rows.
    events = stored(inputs.pipeline_events(spark, sf_dir), "all-events")
    at = lambda s: F.timestamp_seconds(F.lit(s))
    last = events.limit(1).select(F.lit("none").alias("host"), F.lit("none").alias("kind"), at(_LAST + _DELAY).alias("cohort_time"), at(_LAST + _DELAY).alias("done_time"), "packets", "rows")
    done = F.unix_seconds("done_time") - S
    early = (done < 1500) | ((done < 2500) & (done % 2 == 0))
    for some in (events.where(early), events.where(~early), last):
        # Each run is one micro-batch, over all its files: they are in no order, and later micro-batches of a run would be late.
        some.write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        found = _run(indicators.stream_indicators(stream, min_packets=30, min_rows=100, delay_s=_DELAY), out, state)
    return _seconds(found, "tick", "window_start")


@query(_LIVE + "alert IN ('no_traffic', 'drop_rate')")
def stream_no_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir).where("alert in ('no_traffic', 'drop_rate')")


@query(_LIVE + "alert IN ('parse_sla', 'insert_sla')")
def stream_parse_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _live(spark, sf_dir).where("alert in ('parse_sla', 'insert_sla')")


class _KilledOnce(alert_files.VersionSink):
    """A sink that is killed after its first batch with rows is merged, before the batch is recorded."""

    killed = False

    def __call__(self, versions: DataFrame, batch: int) -> None:
        if not self.killed and not versions.isEmpty():
            alert_files.merge_versions(stored(versions, "versions"), self.path)
            self.killed = True
            raise RuntimeError("killed")
        super().__call__(versions, batch)


@query()
def incident_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a stream, merged by a sink that is killed once, in month partitions."""
    source, out, state = new_path(spark, "ticks"), new_path(spark, "versions"), new_path(spark, "versions-state")
    ticks = inputs.table(spark, sf_dir, "ticks")
    ticks.repartition(spark.sparkContext.defaultParallelism).write.parquet(source)
    fields = {"host": "none", "alert": "none", "indicator": 0, "valid": False, "denominator": 0}
    last = ticks.agg((F.max("tick") + 1_000_000).alias("tick")).select("tick", *(F.lit(v).cast(ticks.schema[k].dataType).alias(k) for k, v in fields.items()))
    stream, sink = spark.readStream.schema(ticks.schema).parquet(source), _KilledOnce(out, "incidents")
    for more in (None, last, None):
        if more is not None:
            more.write.mode("append").parquet(source)
        try:
            ingest.finish(sink.writer(live.stream_incidents(stream, 1.0, 0.2, 2, 2), state))
        except StreamingQueryException:
            ingest.finish(sink.writer(live.stream_incidents(stream, 1.0, 0.2, 2, 2), state))
    return _ended(alert_files.read_versions(spark, out, incidents.VERSIONS).drop("month"))


SQL["incident_sink"] = SQL["incident_versions"]
