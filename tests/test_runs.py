"""Tables of runs: commits, conflicts, replacement and compaction."""

import datetime

import pytest
from pyspark.sql import functions as F

from natspark.sources import packets
from natspark.sources.runs import Conflict, RunTable
from natspark.streaming import ingest

SCHEMA = "v long, day int"


@pytest.fixture
def table(spark, tmp_path):
    return RunTable(spark, f"file://{tmp_path}/t")


def put(table, *values, day=1, files=1):
    run = table.new_run()
    rows = table.spark.createDataFrame([(v, day) for v in values], SCHEMA)
    rows.repartition(files).write.partitionBy("day").parquet(table.folder(run, "rows"))
    return run


def rows(table):
    return sorted(r.v for r in table.read("rows", SCHEMA).collect())


def test_runs_count_when_committed(table):
    first, second = put(table, 1, 2), put(table, 3)
    assert rows(table) == []
    table.append(first)
    assert rows(table) == [1, 2]
    with pytest.raises(Conflict):
        table.commit(second, 0)
    table.append(second)
    assert rows(table) == [1, 2, 3] and table.committed() == [first, second] and table.seen() == 2


def test_a_run_replaces_others_at_once(table):
    first, second, both = put(table, 1), put(table, 2), put(table, 1, 2)
    for run in (first, second):
        table.append(run)
    reader = table.read("rows", SCHEMA)
    table.append(both, [first, second])
    # One who began before the change reads the old folders, which are still there.
    assert rows(table) == [1, 2] and sorted(r.v for r in reader.collect()) == [1, 2] and table.committed() == [both]
    # What was replaced can't be replaced again, and the run that tries is dropped.
    with pytest.raises(Conflict):
        again = put(table, 1)
        table.commit(put(table, 9), table.seen())
        table.commit(again, 0, [first])
    assert table.sweep() > 0 and rows(table) == [1, 2, 9]


def test_compaction_bounds_files(table):
    for k in range(6):
        table.append(put(table, *range(10 * k, 10 * k + 10), day=k % 2, files=4))
    before = sum(table.files(run, "rows")[0] for run in table.committed())
    late = put(table, 100)
    assert table.compact("rows", SCHEMA, ["day"]) == 6
    table.append(late)
    assert before >= 20 and sum(table.files(run, "rows")[0] for run in table.committed()) == 3
    assert rows(table) == [*range(60), 100]
    assert table.compact("rows", SCHEMA, ["day"]) == 2 and table.compact("rows", SCHEMA, ["day"]) == 0
    assert table.sweep() > 0 and rows(table) == [*range(60), 100]
    assert {(r.day, r.n) for r in table.read("rows", SCHEMA).groupBy("day").agg(F.count("v").alias("n")).collect()} == {(0, 30), (1, 31)}


def test_large_files_are_left_alone(table):
    for k in range(3):
        table.append(put(table, k))
    assert table.compact("rows", SCHEMA, ["day"], target_bytes=10) == 0


def test_ingest_of_bounded_batches(spark, tmp_path):
    """Each file is a micro-batch; a batch that is applied again adds nothing, and merging leaves one file a day."""
    source, out, state = (f"file://{tmp_path}/{n}" for n in ("in", "out", "state"))
    at = int(datetime.datetime(2027, 3, 9, 17, tzinfo=datetime.timezone.utc).timestamp())
    head = lambda k: bytes(4) + (at + k).to_bytes(4, "big") + b"\0\0\0\6" + bytes(30)
    made = spark.createDataFrame([(k, at, 9, 9088, bytearray(head(k))) for k in range(12)], "packet_id long, received_s long, router_ip long, router_port int, payload binary")
    packets.packets_to_json(made).repartition(4).write.json(source)
    sink = ingest.SessionSink(out, "q", "node-1", files=2)
    ingest.finish(sink.writer(packets.stream_packets_jsonl(spark, source, bytes_per_trigger=1), state))
    table = RunTable(spark, out)
    assert table.committed() == [f"q-{k}" for k in range(4)]
    sink(made, 2)
    assert ingest.ingested(spark, out).count() == 12 and table.seen() == 4
    assert ingest.compact(spark, out) == 4
    sink(made, 3)
    got = ingest.ingested(spark, out)
    assert got.count() == 12 and {(str(r.event_date), r.node) for r in got.collect()} == {("2027-03-09", "node-1")}
    assert sum(table.files(run, "sessions")[0] for run in table.committed()) == 1


def test_compaction_of_more_than_a_file(spark, table):
    """A partition gets files by its own size, and a small one no more than one."""
    for k in range(4):
        run = table.new_run()
        rows_of = spark.range(k * 20_000, k * 20_000 + 20_000).select(F.col("id").alias("v"), F.when(F.col("id") % 1000 == 0, 2).otherwise(1).alias("day"))
        rows_of.repartition(8).write.partitionBy("day").parquet(table.folder(run, "rows"))
        table.append(run)
    assert not table.is_compact("rows", 2, 100_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert table.compact("rows", SCHEMA, ["day"], target_bytes=100_000) == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    run = table.committed()[0]
    files, size = table.files(run, "rows")
    names = spark.read.parquet(table.folder(run, "rows")).select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count().collect()
    of_day = {r.day: r["count"] for r in names}
    assert of_day[2] == 1 and 1 < of_day[1] <= size // 50_000 + 1 and files == sum(of_day.values())
    assert table.is_compact("rows", 2, 100_000) and rows(table) == list(range(80_000))
