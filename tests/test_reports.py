"""Exact distinct counts by bitmaps and grouping, and the proven first rows, against plain counting."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from natspark.operators import distinct, reports
from natspark.schema import SESSION_COLUMNS, SESSIONS

DAY = datetime.date(2027, 3, 9)
NOON = datetime.datetime(2027, 3, 9, 17)


def rows_of(n, seed, addresses=6, hot=0.4):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        public = 100 if rng.random() < hot else 100 + rng.randrange(addresses)
        hour = NOON + datetime.timedelta(hours=rng.randrange(4))
        out.append((hour, hour, 1 + rng.randrange(3), 9, 0, 10 + rng.randrange(40), 7, public, rng.choice((0, 1, 32_768, 32_769, 65_535, rng.randrange(65_536))), rng.randrange(1 << 32), rng.choice((25, 53)), 80))
    return out


@pytest.fixture(scope="module")
def made(spark):
    frame = spark.createDataFrame(rows_of(4000, 1), SESSIONS).withColumns({"node": F.when(F.col("private_ip") % 3 == 0, "node-2").otherwise("node-1"), "event_date": F.lit(DAY)})
    return frame.repartition(4)


def plain(made, keys, **columns):
    """Distinct values of columns, by Python sets."""
    found = {}
    for r in made.collect():
        of = found.setdefault(tuple(r[k] for k in keys), {n: set() for n in columns} | {"rows": 0})
        of["rows"] += 1
        for n, c in columns.items():
            of[n].add(r[c])
    return {k: (v["rows"], *(len(v[n]) for n in columns)) for k, v in found.items()}


def plan(df):
    return df._jdf.queryExecution().toString()


def test_pool(made):
    got = reports.public_ip_pool(made)
    assert "Expand" not in plan(got)
    assert {(r.node, r.public_ip): (r.translations, r.ports_in_use, r.subscribers) for r in got.collect()} == plain(made, ["node", "public_ip"], p="public_port", s="private_ip")


def test_subscribers(spark, made):
    got = reports.subscribers_of_public_ip(made, [100, 101])
    assert "Expand" not in plan(got)
    want = plain(made.where("public_ip in (100, 101)"), ["node", "public_ip", "private_ip"], d="destination_ip", p="destination_port")
    assert {(r.node, r.public_ip, r.private_ip): (r.sessions, r.destinations, r.destination_ports) for r in got.collect()} == want
    assert all(r.total_bytes == 80 * r.sessions for r in got.collect())


def test_router_hours(made):
    got = reports.router_hour_observations(made, DAY, exact=True)
    assert "Expand" not in plan(got)
    want = plain(made, ["node", "start_time", "router_ip"], a="private_ip", b="public_ip", c="destination_ip")
    assert {(r.node, r.hour, r.router_ip): (r.records, r.private_ips, r.public_ips, r.destinations) for r in got.collect()} == want


def test_bitmaps_of_nodes_merge(made):
    merged = reports.global_uniques(reports.node_bitmaps(made, ["public_ip"], "private_ip"), ["public_ip"])
    assert {(r.public_ip,): (r.records, r.uniques) for r in merged.collect()} == plain(made, ["public_ip"], s="private_ip")


def test_values_that_are_null_or_large(spark):
    rows = [(1, 0), (1, None), (1, 4_294_967_295), (1, 4_294_967_295), (2, None)]
    frame = spark.createDataFrame(rows, "k int, v long")
    for got in (distinct.counted(distinct.bitmaps(frame, ["k"], "v"), ["k"], "n"), distinct.grouped(frame, ["k"], "v", "n", records=F.lit(1))):
        assert sorted((r.k, r.n, r.records) for r in got.collect()) == [(1, 2, 4), (2, 0, 1)]


@pytest.mark.parametrize("k, lg_k", [(3, 17), (5, 4), (1000, 8)])
def test_the_first_rows_are_proven(spark, k, lg_k):
    """Skewed data with ties; with rough sketches too, whose bounds then let more through."""
    rng = random.Random(k)
    rows = []
    for public in range(60):
        n = 40 if public < 7 else 1 + rng.randrange(39)  # seven alike
        for private in range(n):
            at = NOON + datetime.timedelta(hours=public % 3)
            rows += [(at, at, 1 + private % 2, 9, 0, private, 7, public, 1, 5, 25, 80)] * (1 + (private == 0) * rng.randrange(30))
    made = spark.createDataFrame(rows, SESSIONS).withColumns({"node": F.when(F.col("public_ip") % 2 == 0, "node-1").otherwise("node-2"), "event_date": F.lit(DAY)}).repartition(3)
    got = reports.public_ip_sharing_hour_proven(made, DAY, k, lg_k)
    want = reports.public_ip_sharing_hour(made, DAY, k, exact=True)
    key = lambda df: sorted((r.node, str(r.hour), r.public_ip, r.origins, r.routers, r.records) for r in df.collect())
    assert key(got) == key(want) and len(SESSION_COLUMNS) == 12
