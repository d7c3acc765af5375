import datetime
import struct
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from natspark import job
from natspark.operators import decode, replay, reports, runner
from natspark.schema import SESSION_COLUMNS, SESSIONS, SESSIONS_V1
from natspark.sources import packets, rowbinary
from natspark.sources.sessions import MissingNode, publish_partition, read_sessions, write_sessions
from natspark.sources.spool import list_spool, set_aside

DAY = datetime.date(2026, 10, 16)
T0 = datetime.datetime(2026, 10, 16, 12)


def session(k=0, end=T0, **more):
    row = dict(start_time=end, end_time=end, router_ip=3, router_port=4, protocol_id=5, private_ip=6 + k, private_port=7, public_ip=8, public_port=9, destination_ip=10, destination_port=25, packet_size=13)
    return row | more


def sessions(spark, rows, node="node-1"):
    made = spark.createDataFrame([tuple(r[c] for c in SESSION_COLUMNS) for r in rows], SESSIONS)
    return made.withColumn("node", F.lit(node))


def test_a_row_has_35_bytes(spark):
    blob, rows = rowbinary.write_rowbinary(sessions(spark, [session()])).first()
    assert (len(blob), rows) == (35, 1)
    assert bytes(blob[8:15]) == struct.pack("<IHB", 3, 4, 5)
    back = rowbinary.decode_rowbinary(spark.createDataFrame([(blob,)], "content binary")).first()
    assert back.asDict() == session()


def test_files_of_both_versions(spark, tmp_path):
    made = sessions(spark, [session(k) for k in range(5)])
    old = made.withColumns({"event_time": F.col("end_time"), "event_id": F.lit("e" * 40), "event_type": F.lit("é" * 100), "header": F.lit("h" * 300), "protocol": F.lit("")})
    for version, frame in ((2, made), (1, old)):
        (tmp_path / str(version)).mkdir()
        for k, row in enumerate(rowbinary.write_rowbinary(frame, 2, version).collect()):
            (tmp_path / str(version) / f"{k}.rowbinary.done").write_bytes(row.blob)
            (tmp_path / str(version) / f"{k}.rowbinary.done.json").write_text("{}")
        read = rowbinary.read_rowbinary(spark, f"file://{tmp_path}/{version}", version)
        assert read.columns == [c.split()[0] for c in (SESSIONS if version == 2 else SESSIONS_V1).split(", ")]
        assert {r.private_ip for r in read.collect()} == set(range(6, 11))
    assert {(r.event_type, r.header) for r in read.collect()} == {("é" * 100, "h" * 300)}


def test_a_cut_batch_is_an_error():
    with pytest.raises(ValueError):
        rowbinary.rows_v2(b"x" * 36)


def packet_rows(spark, payloads):
    return spark.createDataFrame([(k, 1792126800, 9, 9088, bytearray(p)) for k, p in enumerate(payloads)], "packet_id long, received_s long, router_ip long, router_port int, payload binary")


@pytest.mark.parametrize("size, rows", [(0, 0), (3, 0), (4, 0), (41, 0), (42, 1), (79, 1), (80, 1), (81, 1), (144, 2), (16 + 64 * 20, 20), (143, 1)])
def test_packet_sizes(spark, size, rows):
    made = packet_rows(spark, [bytes(size)])
    got = decode.decode_packets(made).collect()
    assert len(got) == rows and {r.packet_size for r in got} <= {size}
    assert {r.start_time for r in got} <= {datetime.datetime(2026, 10, 16, 5)}
    assert [r.reason for r in decode.packet_errors(made).collect()] == ([] if rows else [decode.TOO_SHORT if size < 4 else decode.LEGACY_TOO_SHORT])


def test_one_parsed_and_one_error(spark):
    made = packet_rows(spark, [b"\1\2\3\4" + bytes(38), b"\1\2\3"])
    assert (decode.decode_packets(made).count(), decode.packet_errors(made).count()) == (1, 1)


def test_raw_captures(spark, tmp_path):
    body = packets.frame(1_500_000_000_123_456_789, "10.0.0.1", 9088, b"abc") + packets.frame(2, "x", 1, b"")
    (tmp_path / "a.raw").write_bytes(packets.MAGIC + body + b"\0\0\0\x20cut off")
    (tmp_path / "b.raw").write_bytes(b"other")
    (tmp_path / "c.raw").write_bytes(b"")
    (tmp_path / "d.raw").write_bytes(packets.MAGIC + body + b"\xff" * 40)
    got, errors = packets.read_packets_raw(spark, f"file://{tmp_path}", 30)
    rows = got.orderBy("received_ns").collect()
    want = [(0, 0, 1, b""), (1_500_000_000, 167772161, 9088, b"abc")]
    assert [(r.received_s, r.router_ip, r.router_port, bytes(r.payload)) for r in rows] == [w for w in want for _ in "ad"]
    told = {r.path[-5:]: (r.stop - r.start, r.error) for r in errors.collect()}
    end = len(packets.MAGIC) + len(body)
    assert told["a.raw"] == (11, f"the last frame is cut off, after byte {end}") and told["b.raw"][1] == told["c.raw"][1] == "not a raw packet capture"
    assert told["d.raw"][0] == 40 and "a frame of" in told["d.raw"][1] and set(told) == {"a.raw", "b.raw", "c.raw", "d.raw"}


def test_a_capture_is_cut_at_frames(spark, tmp_path):
    """Pieces smaller than a frame and ranges of a few frames give the frames of the whole."""
    frames = [packets.frame(k, f"10.0.0.{k % 250}", k, bytes([k % 256]) * (k % 90)) for k in range(300)]
    (tmp_path / "x").write_bytes(packets.MAGIC + b"".join(frames))
    files = spark.createDataFrame([(f"file:{tmp_path}/x",)], "path string")
    ranges = packets.capture_ranges(files, 500).collect()
    assert len(ranges) > 20 and sum(r.frames for r in ranges) == 300 and not any(r.error for r in ranges)
    assert [r.stop for r in ranges[:-1]] == [r.start for r in ranges[1:]] and ranges[0].start == len(packets.MAGIC) and ranges[-1].stop == (tmp_path / "x").stat().st_size
    got = packets.packets_of_ranges(packets.capture_ranges(files, 500)).collect()
    assert sorted((r.received_ns, r.router_port, bytes(r.payload)) for r in got) == [(k, k, bytes([k % 256]) * (k % 90)) for k in range(300)]


def test_a_file_of_over_two_gigabytes(spark, tmp_path):
    """A sparse file: its ranges come from its length, and any of them is read alone."""
    size = 35 * 70_000_000
    with open(tmp_path / "big.rowbinary.done", "wb") as file:
        file.truncate(size)
    files = spark.createDataFrame([(f"file:{tmp_path}/big.rowbinary.done", size)], "path string, length long")
    ranges = rowbinary.ranges_of(files, 2)
    assert ranges.agg(F.sum("rows")).first()[0] == 70_000_000 and ranges.count() == -(-size // (rowbinary.RANGE_BYTES // 35 * 35))
    assert rowbinary.decode_ranges(ranges.where(F.col("stop") == size), 2).groupBy("router_ip").count().count() == 1


def test_cut_rows_are_errors_of_their_file(spark, tmp_path):
    made = sessions(spark, [session(k) for k in range(7)])
    old = made.withColumns({"event_time": F.col("end_time"), "event_id": F.lit("e"), "event_type": F.lit("é" * 200), "header": F.lit(""), "protocol": F.lit("x")})
    for version, frame in ((2, made), (1, old)):
        blob = bytes(rowbinary.write_rowbinary(frame.coalesce(1), 7, version).first().blob)
        for name, content in (("whole", blob), ("cut", blob[:-3]), ("empty", b""), ("bad", blob + b"\xff" * 60)):
            (tmp_path / f"{version}{name}").write_bytes(content)
        files = spark.createDataFrame([(f"file://{tmp_path}/{version}{n}", (tmp_path / f"{version}{n}").stat().st_size) for n in ("whole", "cut", "empty", "bad")], "path string, length long")
        ranges = rowbinary.ranges_of(files, version, range_bytes=100)
        found = {r.path.rsplit("/", 1)[-1][1:]: (r.rows, r.errors) for r in ranges.groupBy("path").agg(F.sum("rows").alias("rows"), F.count("error").alias("errors")).collect()}
        assert found["whole"] == (7, 0) and found["cut"] == (6, 1) and "empty" not in found
        assert found["bad"][1] == 1
        read = rowbinary.decode_ranges(ranges.where("error is null and path like '%whole'"), version)
        assert {r.private_ip for r in read.collect()} == set(range(6, 13))


def written(folder):
    return sorted(p.name for p in folder.iterdir() if not p.name.startswith("."))


def test_the_format_writes_pairs_or_nothing(spark, tmp_path):
    rowbinary.register(spark)
    made, path = sessions(spark, [session(k) for k in range(50)]).select(*SESSION_COLUMNS), f"file://{tmp_path}/b"
    made.repartition(3).write.format("rowbinary").option("rowsPerBatch", 8).option("tableName", "logs.t").mode("append").save(path)
    names = written(tmp_path / "b")
    data = [n for n in names if n.endswith(".done")]
    assert len(data) >= 7 and names == sorted([*data, *(f"{n}.json" for n in data)])
    inventory = replay.spool_inventory(*list_spool(spark, path), int(time.time()) + 100)
    assert {(r["class"], r.table_name, r.version) for r in inventory.collect()} == {("candidate", "logs.t", 2)}
    assert inventory.agg(F.sum("rows")).first()[0] == 50
    read = spark.read.format("rowbinary").option("rangeBytes", 70).load(path)
    assert sorted(map(str, read.collect())) == sorted(map(str, made.collect()))
    # A task that fails after others have written leaves nothing of the job.
    broken = made.withColumn("router_port", F.when(F.col("private_ip") == 50, F.raise_error(F.lit("no"))).otherwise(F.col("router_port")).cast("int"))
    with pytest.raises(Exception, match="no"):
        broken.repartition(3).write.format("rowbinary").option("rowsPerBatch", 2).mode("append").save(path)
    assert written(tmp_path / "b") == names


def test_set_aside_twice(spark, tmp_path):
    folder = tmp_path / "s"
    folder.mkdir()
    for n in ("a", "b", "c"):
        (folder / f"{n}.rowbinary.done").write_bytes(n.encode())
    for n in ("a", "b"):
        (folder / f"{n}.rowbinary.done.json").write_text("{}")
    pairs = spark.createDataFrame([(f"file:{folder}/{n}.rowbinary.done", f"file://{tmp_path}/{to}") for n, to in (("a", "x"), ("b", "y"), ("c", "y"), ("gone", "y"))], "path string, to string")
    outcome = lambda: {r.path.rsplit("/", 1)[-1].split(".")[0]: r.outcome for r in set_aside(pairs).collect()}
    assert outcome() == {"a": "moved", "b": "moved", "c": "moved", "gone": "failed"}
    # A kill between the two moves of a pair: the sidecar is still in the spool.
    (tmp_path / "y" / "b.rowbinary.done.json").rename(folder / "b.rowbinary.done.json")
    assert outcome() == {"a": "already", "b": "moved", "c": "already", "gone": "failed"}
    assert written(folder) == [] and written(tmp_path / "x") == ["a.rowbinary.done", "a.rowbinary.done.json"] and len(written(tmp_path / "y")) == 3


def test_sessions_go_to_the_day_they_end(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    late = datetime.datetime(2026, 10, 17, 4, 59, 59)
    write_sessions(sessions(spark, [session(), session(1, end=late), session(2, end=late + datetime.timedelta(seconds=1))]), path)
    assert read_sessions(spark, path, DAY, ["node-1"]).count() == 2
    with pytest.raises(MissingNode):
        read_sessions(spark, path, DAY, ["node-1", "node-2"])


def report(spark, n):
    return spark.range(n).select(F.col("id").alias("v"), F.lit(DAY).alias("data_date"))


def test_publication_replaces_one_partition(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    rows = lambda: sorted((str(r.data_date), r.v) for r in spark.read.schema("v long, data_date date").parquet(path).collect())
    assert publish_partition(report(spark, 3), path, data_date=DAY) == 3
    other = DAY + datetime.timedelta(days=1)
    publish_partition(report(spark, 1).withColumn("data_date", F.lit(other)), path, data_date=other)
    assert publish_partition(report(spark, 2), path, data_date=DAY) == 2
    assert rows() == [("2026-10-16", 0), ("2026-10-16", 1), ("2026-10-17", 0)]
    broken = report(spark, 5).withColumn("v", F.when(F.col("v") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("v")).cast("long"))
    with pytest.raises(Exception, match="no"):
        publish_partition(broken, path, data_date=DAY)
    assert len(rows()) == 3
    assert publish_partition(report(spark, 0), path, data_date=DAY) == 0
    assert rows() == [("2026-10-17", 0)]
    assert not [p for p in (tmp_path / "r").iterdir() if p.name.startswith("_")]


def test_a_failing_case_leaves_the_others_alone(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    for node in ("node-1", "node-2"):
        write_sessions(sessions(spark, [session(k) for k in range(3)], node), path)
    status = runner.run_reports(spark, path, DAY, ["smtp_abuse", "nothing", "public_ip_pool"], f"file://{tmp_path}/out", ["node-1", "node-2"])
    found = {r.case: (r.rows, bool(r.error)) for r in status.collect()}
    assert found == {"smtp_abuse": (6, False), "nothing": (None, True), "public_ip_pool": (2, False)}
    absent = runner.run_reports(spark, path, DAY, ["public_ip_pool"], f"file://{tmp_path}/out", ["node-1", "node-9"]).first()
    assert absent.rows is None and "MissingNode" in absent.error
    assert spark.read.parquet(f"file://{tmp_path}/out/public_ip_pool").count() == 2


def test_subscribers_of_each_address_are_published_apart(spark, tmp_path):
    path, out = f"file://{tmp_path}/s", f"file://{tmp_path}/out"
    write_sessions(sessions(spark, [session(k) for k in range(3)]), path)
    found = sorted({r.public_ip for r in read_sessions(spark, path, DAY, ["node-1"]).collect()})
    case = runner.BY_ADDRESS
    for ip in (*found, 12345):
        assert not runner.run_reports(spark, path, DAY, [case], out, ["node-1"], [ip]).first().error
    got = spark.read.parquet(f"{out}/{case}").collect()
    assert sorted({r.public_ip for r in got}) == found and all(r.loaded_at is not None for r in got)


def test_a_killed_publication_is_swept(spark, tmp_path):
    path = f"file://{tmp_path}/r"
    publish_partition(report(spark, 2), path, data_date=DAY)
    publish_partition(report(spark, 1), path, data_date=DAY + datetime.timedelta(days=1))
    table = tmp_path / "r"
    (table / "_old-x").mkdir()
    (table / f"data_date={DAY}").rename(table / "_old-x" / f"data_date={DAY}")
    (table / "_staging-x" / f"data_date={DAY}").mkdir(parents=True)
    broken = report(spark, 1).withColumn("v", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        publish_partition(broken, path, data_date=DAY)
    assert spark.read.parquet(path).where(F.col("data_date") == F.lit(DAY)).count() == 2
    assert sorted(p.name for p in table.iterdir()) == [f"data_date={DAY}", f"data_date={DAY + datetime.timedelta(days=1)}"]


def test_job(spark, tmp_path, capsys):
    path, out = f"file://{tmp_path}/s", f"file://{tmp_path}/out"
    write_sessions(sessions(spark, [session(k) for k in range(3)]), path)
    args = ["--sessions", path, "--out", out, "--date", str(DAY), "--cases", "smtp_abuse", "--nodes", "node-1"]
    assert job.main([*args, "--dry-run"], spark) == 0 and not (tmp_path / "out").exists()
    assert job.main(args, spark) == 0 and spark.read.parquet(f"{out}/smtp_abuse").count() == 3
    assert job.main([*args, "node-2"], spark) == 1 and "MissingNode" in capsys.readouterr().out
    assert job.yesterday(datetime.datetime(2026, 9, 10, 0, 30, tzinfo=datetime.timezone.utc).timestamp()) == datetime.date(2026, 9, 8)
    assert job.address("200.1.2.3") == 0xC8010203


def test_windowed_reports_drop_sessions_of_the_day_before(spark):
    early = session(start_time=T0 - datetime.timedelta(days=1))
    made = sessions(spark, [session(), session(1), early]).withColumn("event_date", F.lit(DAY))
    assert reports.router_hour_observations(made, DAY).first().records == 2
    assert reports.hourly_nat_load(made).count() == 2


def test_top_k_is_per_node_and_ties_go_to_lower_addresses(spark):
    rows = sessions(spark, [session(k) for k in (3, 1, 2)]).unionByName(sessions(spark, [session(9)], "node-2")).withColumn("event_date", F.lit(DAY))
    got = reports.smtp_abuse(rows, k=2).orderBy("node", "private_ip").collect()
    assert [(r.node, r.private_ip) for r in got] == [("node-1", 7), ("node-1", 8), ("node-2", 15)]


def test_reports_prune_columns_and_rank_in_parts(spark, tmp_path):
    path = f"file://{tmp_path}/p"
    write_sessions(sessions(spark, [session(k) for k in range(3)]), path)
    plan = reports.smtp_abuse(read_sessions(spark, path, DAY, ["node-1"]))._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("Window [row_number()") == 2 and "PushedFilters: [IsNotNull(destination_port), EqualTo(destination_port,25)]" in plan
    assert "private_port" not in plan.split("ReadSchema")[1].splitlines()[0] and "PartitionFilters: [isnotnull(event_date" in plan


def test_batch_files_are_written_by_their_tasks(spark, tmp_path):
    """Files of schema 1 with their sidecars; texts that aren't UTF-8, and several rows of each length, come back."""
    made = sessions(spark, [session(k) for k in range(90)]).coalesce(1)
    old = made.withColumns({"event_time": F.col("end_time"), "event_id": F.lit("e"), "event_type": F.lit("nat"), "header": F.expr("repeat('h', int(private_ip) * 5)"), "protocol": F.lit("")})
    folder = f"file://{tmp_path}/b"
    assert rowbinary.write_batch_files(old, folder, "x", 20, version=1, sidecar={"table_name": "t", "format": "rowbinary"}) == 10
    inventory = replay.spool_inventory(*list_spool(spark, folder), int(time.time()) + 100)
    assert sorted(r["rows"] for r in inventory.where("class = 'candidate' and version = 1").collect()) == [10, 20, 20, 20, 20]
    read = rowbinary.read_rowbinary(spark, folder, 1)
    assert {(r.private_ip, r.header, r.event_id, r.packet_size) for r in read.collect()} == {(r.private_ip, r.header, "e", r.packet_size) for r in old.collect()}
    blob = bytes(rowbinary.write_rowbinary(old.limit(1), 1, 1).first().blob).replace(b"nat", b"n\xfft")
    assert rowbinary.decode_rowbinary(spark.createDataFrame([(bytearray(blob),)], "content binary"), 1).first().event_type == "n\ufffdt"


def test_files_are_walked_by_many_tasks(spark, tmp_path):
    """Adaptive execution leaves files apart, however short their paths are together."""
    made = sessions(spark, [session(k) for k in range(32)]).coalesce(1)
    old = made.withColumns({"event_time": F.col("end_time"), "event_id": F.lit("e"), "event_type": F.lit("nat"), "header": F.lit(""), "protocol": F.lit("")})
    rowbinary.write_batch_files(old, f"file://{tmp_path}/b", "b", 1, version=1)
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/b").select("path", "length")
    for ranges in (rowbinary.ranges_of(files, 1), packets.capture_ranges(files)):
        assert ranges.select(F.spark_partition_id().alias("task")).distinct().count() > 4


def test_tasks_of_a_stream_follow_bytes_and_not_files():
    tasks = rowbinary._cut([(f"f{k}", 350) for k in range(1000)] + [("large", 35_000)], 7_000)
    assert len(tasks) == 50 + 5 and sum(stop - start for t in tasks for _, start, stop in t.parts) == 385_000
    assert all(sum(stop - start for _, start, stop in t.parts) <= 7_000 for t in tasks)


def test_the_writer_holds_a_batch_of_rows(tmp_path):
    """A file of many batches is written as they come."""
    import resource

    n = 100_000
    zero = pa.array(np.zeros(n, np.int64))
    batch = pa.RecordBatch.from_arrays([zero.cast(pa.timestamp("us", "UTC")) if c in ("start_time", "end_time") else zero for c in SESSION_COLUMNS], names=SESSION_COLUMNS)
    writer = rowbinary._Writer({"path": f"file://{tmp_path}/b", "rowsPerBatch": 10**9})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    writer.commit([writer.write(batch for _ in range(120))])
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 120_000  # KB; the file has 420 MB
    assert sorted(p.stat().st_size for p in (tmp_path / "b").iterdir() if p.name.endswith(".done")) == [120 * n * 35]


def test_packets_are_written_in_small_files(spark, tmp_path):
    """A file of JSON lines has so many packets at most, however few tasks write."""
    made = packet_rows(spark, [bytes([k]) * 50 for k in range(95)]).coalesce(1)
    packets.write_packets_json(made, f"file://{tmp_path}/j", packets_per_file=10)
    files = spark.read.text(f"file://{tmp_path}/j").groupBy(F.input_file_name()).count().collect()
    assert len(files) == 10 and max(r["count"] for r in files) == 10
    assert {bytes(r.payload) for r in packets.read_packets_jsonl(spark, f"file://{tmp_path}/j").collect()} == {bytes([k]) * 50 for k in range(95)}
