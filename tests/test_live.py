"""Live indicators and the incident sink: order, restarts and kills don't change what comes out."""

import datetime
import random
from collections import defaultdict

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from natspark.operators import incidents, telemetry
from natspark.plans import health_queries, inputs
from natspark.sources.alerts import VersionSink, merge_versions, read_versions
from natspark.streaming import indicators, ingest

T0 = 1_800_000_000
EVENTS = "host string, kind string, cohort_time timestamp, done_time timestamp, packets long, rows long"


def some_events(seed, n=400):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        second = T0 + rng.randrange(300) if rng.random() < 0.8 else T0 + 7
        kind = rng.choice(("received", "received", "parsed", "inserted", "spooled", "dropped"))
        out.append((f"h{rng.randrange(2)}", kind, second, second + rng.choice((0, 0, 1, 30, 90)), rng.randrange(1, 5), rng.randrange(9)))
    return out


def plain(events, last, window=60, step=10, sla=60):
    """The indicators by their definition."""
    found, first = {}, defaultdict(lambda: 1 << 60)
    for host, kind, _, done, *_ in events:
        if kind in indicators.KINDS:
            first[host] = min(first[host], -(-done // step) * step)
    for host, begin in first.items():
        for tick in range(begin, last + 1, step):
            def total(kind, place, start):
                return sum(e[place] for e in events if e[0] == host and e[1] == kind and e[3] <= tick and start <= e[2] < start + window)

            a, b = tick - window, tick - window - sla
            received, dropped = total("received", 4, a), total("dropped", 4, a)
            late, expected = total("received", 4, b), total("parsed", 5, b)
            for alert, start, n, d in (
                ("no_traffic", a, int(received == 0), 1), ("drop_rate", a, dropped, received + dropped),
                ("parse_sla", b, max(late - total("parsed", 4, b), 0), late), ("insert_sla", b, max(expected - total("inserted", 5, b), 0), expected),
            ):
                found[host, alert, tick] = (start, n, d, n * 100 / d if d else 0.0)
    return found


def at(s):
    return datetime.datetime.fromtimestamp(s, datetime.timezone.utc)


def put(spark, events, source):
    rows = [(h, k, at(c), at(d), p, r) for h, k, c, d, p, r in events]
    spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(source)


def run(spark, source, out, state, delay):
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(source)
    ingest.finish(indicators.stream_indicators(stream, min_packets=5, min_rows=5, delay_s=delay).writeStream.format("parquet").option("path", out).option("checkpointLocation", state))


@pytest.mark.parametrize("parts", [1, 4])
def test_indicators_over_restarts(spark, tmp_path, parts):
    """Events in any order within the delay, in one run or several; the second host falls silent."""
    events = [e for e in some_events(5) if e[0] == "h0" or e[3] < T0 + 120]
    last, delay = T0 + 600, 450
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    shuffled = random.Random(parts).sample(events, len(events))
    for k in range(parts):
        put(spark, shuffled[k::parts], source)
        run(spark, source, out, state, delay)
    put(spark, [("none", "none", last + delay, last + delay, 0, 0)], source)
    run(spark, source, out, state, delay)
    got = spark.read.schema(indicators.INDICATORS).parquet(out).withColumns({c: F.unix_seconds(c) for c in ("tick", "window_start")}).collect()
    assert len(got) == len({(r.host, r.alert, r.tick) for r in got})
    want = plain(events, last)
    assert {(r.host, r.alert, r.tick): (r.window_start, r.numerator, r.denominator, r.indicator) for r in got} == want
    assert all(r.valid == (r.denominator >= (1 if r.alert == "no_traffic" else 5)) for r in got)
    assert sum(r.numerator for r in got if (r.host, r.alert) == ("h1", "no_traffic")) > 20


def versions(spark, rows):
    return spark.createDataFrame([("h", "a", i, v, T0 + v, T0 + 40 * 86_400 * i, None, 1.0, "ACTIVE") for i, v in rows], incidents.VERSIONS)


def test_a_merge_adds_each_version_once(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    assert merge_versions(versions(spark, [(1, 1), (1, 2), (2, 3)]), path) == 2
    merge_versions(versions(spark, [(1, 2), (2, 3), (2, 4), (2, 4)]), path)
    got = read_versions(spark, path, incidents.VERSIONS).collect()
    assert sorted((r.incident, r.version) for r in got) == [(1, 1), (1, 2), (2, 3), (2, 4)] and len({r.month for r in got}) == 2


def test_a_batch_is_applied_once(spark, tmp_path):
    """A kill before the record: the same batch again adds nothing twice; a recorded batch is passed over."""
    path, source = f"file://{tmp_path}/v", f"file://{tmp_path}/in"

    class Killed(VersionSink):
        left = 1

        def _record(self, spark, batch):
            if self.left and self.seen:
                self.left -= 1
                raise RuntimeError("killed")
            self.seen = True
            return super()._record(spark, batch)

        seen = False

    versions(spark, [(1, 1), (2, 2)]).write.parquet(source)
    sink = Killed(path, "q")
    stream = spark.readStream.schema(incidents.VERSIONS).parquet(source)
    with pytest.raises(StreamingQueryException, match="killed"):
        ingest.finish(sink.writer(stream, f"file://{tmp_path}/state"))
    ingest.finish(sink.writer(stream, f"file://{tmp_path}/state"))
    assert sorted(r.version for r in read_versions(spark, path, incidents.VERSIONS).collect()) == [1, 2]
    sink(versions(spark, [(9, 9)]), 0)
    assert read_versions(spark, path, incidents.VERSIONS).count() == 2
    sink(versions(spark, [(9, 9)]), 7)
    assert read_versions(spark, path, incidents.VERSIONS).count() == 3


def test_the_newest_line_of_a_minute(spark):
    line = lambda t, n: (f"{t} h collector: metrics live_batch_mode=true total_received={n}", "h", 0)
    lines = spark.createDataFrame([line(1000.5, 1), line(1030.0, 2), line(1030.0, 3), line(1200.0, 4)], "value string, host string, capture int")
    asked = spark.createDataFrame([("h", t) for t in (1000.0, 1000.5, 1029.9, 1030.0, 1090.0, 1090.1, 1199.0, 1260.0, 1261.0)] + [("other", 1030.0)], "host string, at double")
    metrics = telemetry.parse_metric_lines(lines)
    got = {(r.host, r["at"]): r.ts and (r.ts, r.fields["total_received"]) for r in telemetry.metrics_at(metrics, asked).collect()}
    assert got == {
        ("h", 1000.0): None, ("h", 1000.5): (1000.5, "1"), ("h", 1029.9): (1000.5, "1"), ("h", 1030.0): (1030.0, "3"), ("h", 1090.0): (1030.0, "3"),
        ("h", 1090.1): None, ("h", 1199.0): None, ("h", 1260.0): (1200.0, "4"), ("h", 1261.0): None, ("other", 1030.0): None,
    }
    shown = telemetry.latest_metrics_at(metrics, asked, shown=["total_received", "queue_packet"]).collect()
    assert len(shown) == 2 * 5 and {r.value for r in shown if r.name == "queue_packet"} == {None}


class _State(dict):
    """A map and a value of state that count what is asked of them."""

    calls = 0

    def containsKey(self, k):
        self.calls += 1
        return k in self

    def getValue(self, k):
        self.calls += 1
        return self[k]

    def updateValue(self, k, v):
        self.calls += 1
        self[k] = v


def test_a_micro_batch_touches_each_place_of_the_state_once():
    """However many frames its events come in; sums stay exact when many are summed on the way."""
    import numpy as np
    import pandas as pd

    seconds, clock, rng = _State(), [], np.random.default_rng(1)
    p = indicators.Indicators(60, 10, 60, 5, 5)
    p.seconds = seconds
    p.clock = type("Clock", (), {"exists": lambda self: False, "update": lambda self, v: clock.append(v)})()
    p.handle = type("Handle", (), {"registerTimer": lambda self, at: None})()
    n = 50_000
    frames = [pd.DataFrame({"kind": rng.choice(["received", "parsed"], n), "second": T0 + rng.integers(0, 600, n), "done": T0 + rng.integers(600, 700, n), "packets": 1, "rows": 2}) for _ in range(24)]
    list(p.handleInputRows(("h",), iter(frames), None))
    assert len(seconds) == 60 and seconds.calls <= 3 * 60
    cells = np.concatenate([np.frombuffer(v[0], indicators.CELL) for v in seconds.values()])
    assert cells["packets"].sum() == 24 * n and cells["rows"].sum() == 48 * n and len(cells) <= 60 * 2 * 100
    every = pd.concat(frames)
    for second, kind in ((T0 + 20, 0), (T0 + 590, 1)):
        held = np.frombuffer(seconds[(second,)][0], indicators.CELL)
        assert held["packets"][held["kind"] == kind].sum() == ((every["second"] // 10 * 10 == second) & (every["kind"] == indicators.KINDS[kind])).sum()


def test_dedup_keeps_little_on_disk(spark, tmp_path, monkeypatch):
    """Packets that arrive twice are on disk once, with a short key in the state and what is counted."""
    monkeypatch.setattr(health_queries, "new_path", lambda spark, name: f"file://{tmp_path}/{name}")
    sf_dir = "/root/testdata/sf0.01"
    got = health_queries.stream_dedup(spark, sf_dir).collect()
    packets = inputs.packets(spark, sf_dir)
    distinct = packets.select("received_s", "router_ip", "payload").distinct()
    assert {tuple(r) for r in got} == {tuple(r) for r in distinct.groupBy("received_s").count().collect()}
    held = sum(f.stat().st_size for f in tmp_path.rglob("*") if f.is_file())
    assert held < 150 * packets.count()
