import datetime
import random

import pytest
from pyspark.sql import functions as F

from natspark.operators import health, incidents, replay, telemetry
from natspark.streaming import incidents as live

T0 = 1792126800


def at(second):
    return datetime.datetime.fromtimestamp(T0 + second, datetime.UTC).replace(tzinfo=None)


def lines(spark, values, capture=1):
    return telemetry.parse_metric_lines(spark.createDataFrame([("h", capture, v) for v in values], "host string, capture int, value string"))


def line(ts, received, **more):
    fields = {c: 0 for c in telemetry.COUNTERS} | {"total_received": received, "queue_packet": "3/8", "queue_batch": "1/8"} | more
    return f"{ts} h collector: metrics live_batch_mode=true " + " ".join(f"{k}={v}" for k, v in fields.items() if v is not None)


def captures(spark, first, end):
    return spark.createDataFrame([("h", 1, float(first), float(end))], "host string, capture int, expected_first double, capture_end double")


@pytest.mark.parametrize(
    "values, reason",
    [
        ([line(10, 5), line(20, 9)], None),
        ([line(10, 5)], "samples"),
        ([], "samples"),
        ([line(10, 5), line(20, 4)], "restart"),
        ([line(10, 5), line(20, None), line(30, 4)], "restart"),
        ([line(10, 5), "15 h collector: collector_started", line(20, 9)], "restart"),
        (["5 h collector: collector_started", line(10, 5), line(20, 9)], None),
        ([line(12, 5), line(20, 9)], "first"),
        ([line(10, 2**40), line(20, 2**41)], None),
    ],
)
def test_capture_validity(spark, values, reason):
    row = telemetry.capture_validity(lines(spark, values), captures(spark, 10, 40)).first()
    assert (row.valid, row.reason) == (reason is None, reason)


def test_a_late_end_and_gaps(spark):
    values = [line(10, 1), line(50, 2), line(60, 3)]
    assert telemetry.capture_validity(lines(spark, values), captures(spark, 10, 91)).first().reason == "end"
    assert telemetry.capture_validity(lines(spark, values), captures(spark, 10, 90)).first().gaps == 1


def test_summary_flags_missing_fields(spark):
    values = [line(10, 100, total_packet_processed=100, total_parse_errors=1), line(20, 300, total_packet_processed=290, total_parse_errors=3, total_udp_kernel_drops=None, queue_packet="7/8")]
    summary = telemetry.capture_summary(lines(spark, values))
    row = summary.first()
    assert (row.total_received, row.received_pps, row.total_udp_kernel_drops, row.drop_pct, row.max_queue_packet) == (200, 20.0, None, None, 7)
    assert row.parse_error_pct == pytest.approx(100 * 2 / 190)
    assert telemetry.pipeline_balance(summary).first().packets_change == 10


def test_the_last_of_equal_keys_counts(spark):
    row = lines(spark, ["1.5 h x metrics live_batch_mode=a total_received=1 total_received=2 a=b=c"]).first()
    assert (row.ts, row.total_received, row.fields["a"]) == (1.5, 2, "b=c")


@pytest.mark.parametrize(
    "values, want",
    [
        ([5, 5, 7], [5, 0, 2]),
        ([0, 3], [0, 3]),
        ([2**32 - 2, 3], [2**32 - 2, 5]),
        ([100, 90, 95, 110], [100, 0, 0, 10]),
        ([0, 2**31], [0, 2**31]),
        ([0, 2**31 + 1, 1], [0, 0, 1]),
    ],
)
def test_counter_increments(spark, values, want):
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, seq long, value long")
    assert [r.increment for r in telemetry.counter_increments(df, ["k"]).orderBy("seq").collect()] == want


EVENTS = "host string, kind string, cohort_time timestamp, done_time timestamp, packets long, rows long"


def test_counters_are_credited_to_reception(spark):
    rows = [("h", kind, at(0), at(d), p, r) for kind, d, p, r in [("received", 0, 10, 0), ("parsed", 1, 9, 72), ("parse_failed", 1, 1, 0), ("inserted", 30, 0, 70), ("spooled", 40, 0, 2), ("dropped", 0, 3, 0)]]
    row = health.cohort_counts(spark.createDataFrame(rows, EVENTS)).first()
    assert (row.received_packets, row.parsed_packets, row.parse_failed_packets, row.expected_rows, row.inserted_rows, row.spooled_rows, row.kernel_drops) == (10, 9, 1, 72, 70, 2, 3)


def test_delayed_windows(spark):
    rows = [("h", kind, at(s), at(s + 1), p, r) for s in (0, 1) for kind, p, r in [("received", 100, 0), ("parsed", 99, 99 * 8), ("inserted", 0, 784)]]
    events = spark.createDataFrame(rows, EVENTS)
    tick = F.col("tick") == F.lit(at(120))
    assert health.parse_sla(events, min_packets=100).where(tick).first().indicator == pytest.approx(1.0)
    assert health.insert_sla(events, min_rows=100).where(tick).first().indicator == pytest.approx(1600 / 1584)
    late = events.withColumn("done_time", F.when(F.col("kind") == "inserted", F.lit(at(121))).otherwise(F.col("done_time")))
    assert health.insert_sla(late, min_rows=100).where(tick).first().indicator == pytest.approx(100.0)


def test_silence_is_an_indicator(spark):
    events = spark.createDataFrame([("h", "received", at(5), at(5), 1, 0)], EVENTS)
    windows = health.sliding_indicator(health.cohort_counts(events))
    spine = health.tick_spine(spark.createDataFrame([("h",), ("silent",)], "host string"), T0, T0 + 70)
    got = {(r.host, int(r.tick.replace(tzinfo=datetime.UTC).timestamp()) - T0): r.indicator for r in health.no_traffic(windows, spine).collect()}
    assert got[("h", 0)] == 100 and all(got[("h", t)] == 0 for t in range(10, 61, 10)) and got[("h", 70)] == 100
    assert all(got[("silent", t)] == 100 for t in range(0, 71, 10))


def test_retention():
    assert health.retention() == 300 and health.retention(300, 60) == 480


def test_replay_rates(spark):
    cycles = spark.createDataFrame([("h", at(60), 4, 1, 1), ("h", at(0), 100, 100, 100)], "host string, second timestamp, attempted long, failed long, quarantined long")
    tick = F.col("tick") == F.lit(at(60))
    assert health.replay_failure_rate(cycles).where(tick).first().indicator == 25
    assert health.replay_quarantine_rate(cycles).where(tick).first().indicator == 20
    files = spark.createDataFrame([(0,), (540,), (590,)], "mtime_s long")
    assert health.replay_backlog(files, 600).first().indicator == 50


TICKS = "host string, alert string, tick long, indicator double, valid boolean, denominator long"


def ticks(spark, series):
    return spark.createDataFrame([("h", "a", 10 * k, float(i), v, d) for k, (i, v, d) in enumerate(series)], TICKS)


def test_an_incident_opens_and_ends(spark):
    got = incidents.incidents(ticks(spark, [(1.5, True, 1), (0, True, 1), (9, False, 1), (0, True, 1)]), 1, 0.2, 1, 2).collect()
    assert [(r.incident, r.start_tick, r.end_tick, r.peak) for r in got] == [(1, 0, 30, 1.5)]


@pytest.mark.parametrize("trigger, clear_n", [(1, 1), (1, 3), (2, 2), (3, 1)])
def test_marks_equal_the_fold(spark, trigger, clear_n):
    rng = random.Random(trigger * 10 + clear_n)
    rows = [(f"h{h}", "a", 10 * k, rng.choice([0.0, 0.1, 0.5, 1.0, 2.0]), rng.random() > 0.2, rng.randrange(3)) for h in range(40) for k in range(60)]
    df = spark.createDataFrame(rows, TICKS)

    def folded(min_batches, valid):
        out = set()
        for h in range(40):
            series = [(r[2], r[3], r[4] or not valid, r[5]) for r in rows if r[0] == f"h{h}"]
            last = {}
            for v in incidents.fold(incidents.State(), series, incidents.Rule(1, 0.2, trigger, clear_n, min_batches), None):
                last[v[0]] = v
            out |= {(f"h{h}", v[0], v[3], v[4]) for v in last.values()}
        return out

    keys = lambda d: {(r.host, r.incident, r.start_tick, r.end_tick) for r in d.collect()}
    assert keys(incidents.incidents(df, 1, 0.2, trigger, clear_n)) == folded(0, True)
    assert keys(incidents.replay_incidents(df.drop("valid"), 1, 0.2, trigger, clear_n)) == folded(1, False)


def test_an_open_incident_can_end_without_data(spark):
    got = incidents.replay_incidents(ticks(spark, [(50, True, 4), (0, True, 0), (0, True, 0), (0, True, 0), (60, True, 0)]), 5, 1)
    assert [(r.start_tick, r.end_tick) for r in got.collect()] == [(0, 30)]


def test_versions_wait_for_the_update_interval(spark):
    series = [(1, True, 1), (2, True, 1), (3, True, 1), (3, True, 1), (2, True, 1), (2, True, 1), (2, True, 1), (0, True, 1)]
    got = incidents.incident_versions(ticks(spark, series), 1, 0.5, clear_n=1).orderBy("version").collect()
    assert [(r.emitted_tick, r.peak, r.end_tick, r.state) for r in got] == [(0, 1.0, None, "ACTIVE"), (60, 3.0, None, "ACTIVE"), (70, 3.0, 70, "CLEARED")]


def test_ticks_out_of_order_over_restarts(spark, tmp_path):
    """Each part is a file and a run of its own; the last but one lets the watermark pass, the last comes too late."""
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for part in ([(5010, 6.0)], [(5020, 0.0), (5000, 5.0)], [(6000, 0.0)], [(5005, 9.0), (None, 9.0)]):
        frame = spark.createDataFrame([("h", "a", t, v, True, 1) for t, v in part], TICKS)
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(TICKS).parquet(source)
        writer = live.stream_incidents(stream, 1, 0.2, clear_n=1, update_s=0).writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", f"file://{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.schema(incidents.VERSIONS).parquet(out).orderBy("version").collect()
    assert [(r.incident, r.version, r.emitted_tick, r.state, r.peak) for r in got] == [(1, 1, 5000, "ACTIVE", 5.0), (1, 2, 5010, "ACTIVE", 6.0), (1, 3, 5020, "CLEARED", 6.0)]


def test_ticks_of_many_files_give_the_versions_of_the_whole_series(spark, tmp_path):
    rng = random.Random(8)
    rows = [(f"h{h}", "a", 5000 + 10 * k, rng.choice([0.0, 0.1, 0.5, 1.0, 2.0]), rng.random() > 0.2, 1) for h in range(3) for k in range(60)]
    source, out = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    mixed = sorted(rows, key=lambda r: r[2] + rng.randrange(250))
    for k in range(0, len(mixed), 45):
        spark.createDataFrame(mixed[k : k + 45], TICKS).coalesce(1).write.mode("append").parquet(source)
    spark.createDataFrame([("z", "a", 10_000, 0.0, False, 1)], TICKS).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(source)
    writer = live.stream_incidents(stream, 1, 0.2, 2, 2).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"file://{tmp_path}/state")
    writer.trigger(availableNow=True).start().awaitTermination()
    want = incidents.incident_versions(spark.createDataFrame(rows, TICKS), 1, 0.2, 2, 2)
    assert sorted(spark.read.schema(incidents.VERSIONS).parquet(out).collect()) == sorted(want.collect())


SIDECAR = '{"schema_version": %s, "table_name": "%s", "rows": %s, "bytes": %s, "format": "%s"}'


@pytest.mark.parametrize(
    "text, version, reason",
    [
        (SIDECAR % (2, "a.b", 2, 70, "RowBinary"), 2, None),
        (SIDECAR % (0, "a.b", 2, 70, "ROWBINARY"), 1, None),
        (SIDECAR % (3, "a.b", 2, 70, "RowBinary"), 3, "schema_version"),
        (SIDECAR % (2, "a.b.c", 2, 70, "RowBinary"), 2, "table_name"),
        (SIDECAR % (2, "a", 0, 70, "RowBinary"), 2, "rows"),
        (SIDECAR % (2, "a", 2, 0, "RowBinary"), 2, "bytes"),
        (SIDECAR % (2, "a", 2, 71, "RowBinary"), 2, "size"),
        (SIDECAR % (2, "a", 2, 70, "CSV"), 2, "format"),
        (SIDECAR % (2, "a", '"x"', 70, "RowBinary"), 2, "json"),
        ("{", 1, "json"),
        ("{}", 1, "format"),
    ],
)
def test_sidecars(spark, text, version, reason):
    row = replay.validate_sidecar(spark.createDataFrame([("p", 70, text)], "path string, length long, sidecar string")).first()
    assert row.reason == reason and (reason == "json" or row.version == version)


def test_inventory_classes(spark):
    good = SIDECAR % (2, "a.b", 2, 70, "RowBinary")
    files = spark.createDataFrame([(f"{n}.rowbinary.done", m, 70) for n, m in (("old", 0), ("new", 950), ("alone", 0), ("young", 0), ("bad", 0))] + [("x.tmp", 0, 70)], "path string, mtime_s long, length long")
    sidecars = spark.createDataFrame([("old.rowbinary.done", 0, good), ("new.rowbinary.done", 0, good), ("young.rowbinary.done", 990, good), ("bad.rowbinary.done", 0, "{")], "path string, sidecar_mtime_s long, sidecar string")
    found = {r.path.split(".")[0]: (r["class"], r.reason) for r in replay.spool_inventory(files, sidecars, 1000).collect()}
    assert found == {"old": ("candidate", None), "new": ("too_recent", None), "alone": ("incomplete_pair", None), "young": ("too_recent", None), "bad": ("invalid", "json")}


@pytest.mark.parametrize("trigger, clear_n, least", [(1, 1, 0), (2, 3, 1), (3, 2, 2), (2, 1, 5)])
def test_a_series_in_many_stretches_equals_its_fold(spark, trigger, clear_n, least):
    """Stretches of a few ticks, so that incidents begin, go on and end in different ones."""
    rng, rule, rows, want = random.Random(trigger * 10 + clear_n), incidents.Rule(1.0, 0.2, trigger, clear_n, least), [], set()
    for host in ("a", "b", "c"):
        ticks_of = [(10 * k, rng.choice((0.0, 0.1, 0.5, 1.0, 2.0, round(rng.random() * 3, 3))), True, rng.randrange(4)) for k in range(400)]
        rows += [(host, "x", t, i, n) for t, i, _, n in ticks_of]
        last = {v[0]: (v[3], v[4], v[5]) for v in incidents.fold(incidents.State(), ticks_of, rule, 0)}
        want |= {(host, k, *v) for k, v in last.items()}
    frame = spark.createDataFrame(rows, "host string, alert string, tick long, indicator double, denominator long").repartition(4)
    got = incidents.scanned(frame, rule, stretch_s=70)
    assert {(r.host, r.incident, r.start_tick, r.end_tick, r.peak) for r in got.collect()} == want and len(want) > (3 if least < 5 else -1)
