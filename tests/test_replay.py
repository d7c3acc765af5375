"""Replay exactly once, failures apart, and its queries against their SQL."""

import os
import time

import pytest


from natspark.operators import replay
from natspark.plans import health_queries, inputs
from natspark.sources import rowbinary
from natspark.sources.files import write_files
from natspark.sources.runs import Conflict, RunTable
from natspark.sources.spool import list_spool

from .test_sources import session, sessions

DATA = "/root/testdata/sf0.001"
LATER = int(time.time()) + 10_000


def spool(spark, folder, batches):
    """Batch files (name, rows declared, content) with sidecars of schema 2."""
    meta = lambda n, content: f'{{"schema_version": 2, "table_name": "t", "rows": {n}, "bytes": {len(content)}, "format": "RowBinary"}}'
    files = [(f"{name}.rowbinary.done", bytearray(content)) for name, _, content in batches]
    files += [(f"{name}.rowbinary.done.json", bytearray(meta(n, content).encode())) for name, n, content in batches]
    write_files(spark.createDataFrame(files, "name string, content binary"), folder)
    return folder


def batch(spark, *ks):
    return bytes(rowbinary.write_rowbinary(sessions(spark, [session(k) for k in ks]).coalesce(1), 1000).first().blob)


def candidates(spark, folder):
    return replay.select_candidates(replay.spool_inventory(*list_spool(spark, folder), LATER))


def inserted(table):
    return sorted(r.private_ip - 6 for r in replay.replayed(table).collect())


def test_a_kill_at_any_point_inserts_each_row_once(spark, tmp_path):
    folder, aside = f"file://{tmp_path}/spool", f"file://{tmp_path}/aside"
    table = RunTable(spark, f"file://{tmp_path}/t")
    spool(spark, folder, [("a", 3, batch(spark, 1, 2, 3)), ("b", 2, batch(spark, 4, 5))])
    # Killed after the rows were written, before they count.
    replay.stage_replay(candidates(spark, folder), table, table.new_run())
    assert inserted(table) == []
    # Killed after they count, before the batches leave the spool.
    outcome = replay.replay_batches(candidates(spark, folder), table)
    assert {(r.status, r.found_rows) for r in outcome.collect()} == {("ok", 3), ("ok", 2)} and inserted(table) == [1, 2, 3, 4, 5]
    spool(spark, folder, [("c", 1, batch(spark, 6))])
    summary = replay.replay_cycle(spark, folder, table, aside, LATER).first()
    assert (summary.discovered, summary.processed, summary.inserted_rows, summary.failed) == (3, 1, 1, 0)
    assert inserted(table) == [1, 2, 3, 4, 5, 6] and list_spool(spark, folder)[0].count() == 0
    assert table.sweep() > 0 and table.sweep() == 0 and inserted(table) == [1, 2, 3, 4, 5, 6]
    assert replay.replay_cycle(spark, folder, table, aside, LATER).first().discovered == 0


def test_one_bad_batch_of_three(spark, tmp_path):
    folder = spool(spark, f"file://{tmp_path}/spool", [("good", 2, batch(spark, 1, 2)), ("cut", 1, bytes(36)), ("fewer", 9, batch(spark, 3))])
    table = RunTable(spark, f"file://{tmp_path}/t")
    for k in range(2):
        summary = replay.replay_cycle(spark, folder, table, f"file://{tmp_path}/aside", LATER).first()
        assert (summary.processed, summary.inserted_rows, summary.failed, summary.quarantined) == ((3, 2, 2, 0), (2, 0, 2, 0))[k]
    outcome = {r.path.split("/")[-1].split(".")[0]: r.problem for r in replay.replay_batches(candidates(spark, folder), table).collect()}
    assert outcome == {"cut": "the last row is cut off, after byte 35", "fewer": "9 rows declared, 1 found"} and inserted(table) == [1, 2]


def test_of_two_runs_at_a_time_one_is_refused(spark, tmp_path):
    folder = spool(spark, f"file://{tmp_path}/spool", [("a", 1, batch(spark, 1))])
    table = RunTable(spark, f"file://{tmp_path}/t")
    first, second = table.new_run(), table.new_run()
    for run in (first, second):
        replay.stage_replay(candidates(spark, folder), table, run)
    table.commit(first, 0)
    with pytest.raises(Conflict):
        table.commit(second, 0)
    assert inserted(table) == [1] and table.committed() == [first]


def test_the_limit_takes_the_oldest(spark):
    rows = [(f"{k}.rowbinary.done", 100 - k, 35, 0, '{"schema_version": 2, "table_name": "t", "rows": 1, "bytes": 35, "format": "rowbinary"}') for k in range(5)]
    frame = spark.createDataFrame(rows, "path string, mtime_s long, length long, sidecar_mtime_s long, sidecar string")
    inventory = replay.spool_inventory(frame.select("path", "mtime_s", "length"), frame.select("path", "sidecar_mtime_s", "sidecar"), 1000)
    assert [r.path[0] for r in replay.select_candidates(inventory, 2).collect()] == ["4", "3"]
    assert replay.replay_summary(inventory, limit=2).first().discovered == 2 and replay.replay_summary(inventory).first().discovered == 5


needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@needs_data
def test_all_batches_are_verified(spark):
    decoded, checked = health_queries._verified(spark, DATA)
    accounts = checked.collect()
    n = inputs.sessions(spark, DATA).count()
    assert decoded.count() == sum(r.declared_rows for r in accounts) == sum(r.decoded_rows for r in accounts) == n
    assert all(r.agrees for r in accounts) and len(accounts) >= n / 500


@needs_data
@pytest.mark.parametrize("name", ["replay_batches", "replay_summary", "quarantine_folders", "spool_folder", "verify_batch_rows"])
def test_equal_to_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"create view lineitem as select * from '{DATA}/lineitem.parquet'")
    got = health_queries.ALL[name](spark, DATA)
    want = con.execute(f"select {', '.join(got.columns)} from ({health_queries.SQL[name]}) t").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_cycles_until_all_is_inserted(spark, tmp_path):
    """More batches than two cycles take, behind some that fail each time."""
    bad = [(f"a{k}", 9, batch(spark, 90)) for k in range(2)]
    folder = spool(spark, f"file://{tmp_path}/spool", bad + [(f"b{k}", 1, batch(spark, k)) for k in range(5)])
    os.utime(tmp_path / "spool" / "a0.rowbinary.done", (1, 1))
    os.utime(tmp_path / "spool" / "a1.rowbinary.done", (1, 1))
    table = RunTable(spark, f"file://{tmp_path}/t")
    assert replay.replay_all(spark, folder, table, f"file://{tmp_path}/aside", LATER, limit=3) >= 6
    assert inserted(table) == list(range(5))
    other = RunTable(spark, f"file://{tmp_path}/u")
    spool(spark, folder, [("c", 1, batch(spark, 7))])
    replay.replay_all(spark, folder, other, f"file://{tmp_path}/aside", LATER, limit=2)
    assert inserted(other) == [7]
