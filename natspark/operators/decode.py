"""Packets to sessions, with built-in functions only: no packet leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from natspark.functions.times import timestamp_fallback
from natspark.schema import SESSION_COLUMNS

HEADER, RECORD, LEGACY, SHORTEST = 16, 64, 42, 4
TOO_SHORT, LEGACY_TOO_SHORT = "packet_too_short_for_header", "legacy_packet_too_short"
#: Offsets of big-endian fields, (offset, bytes); of a record, and of a legacy packet.
RECORD_FIELDS = {
    "private_ip": (4, 4), "public_ip": (8, 4), "destination_ip": (12, 4), "private_port": (20, 2),
    "public_port": (22, 2), "destination_port": (24, 2), "start_s": (28, 4), "end_s": (32, 4),
}
LEGACY_FIELDS = {
    "packet_s": (4, 4), "protocol_id": (11, 1), "private_ip": (20, 4), "public_ip": (24, 4), "destination_ip": (28, 4),
    "private_port": (36, 2), "public_port": (38, 2), "destination_port": (40, 2),
}


def unsigned(payload: Column, offset: Column | int, size: int) -> Column:
    """The big-endian number of ``size`` bytes at ``offset``."""
    at = (F.lit(offset) if isinstance(offset, int) else offset) + 1
    return F.conv(F.hex(F.substring(payload, at, F.lit(size))), 16, 10).cast("bigint")


def _form(size: Column) -> Column:
    """The kind of a packet by its size alone; many-record sizes win over legacy ones."""
    many = (size >= HEADER + RECORD) & ((size - HEADER) % RECORD == 0)
    return F.when(size < SHORTEST, TOO_SHORT).when(many, "many").when(size >= LEGACY, "legacy").otherwise(LEGACY_TOO_SHORT)


def decode_packets(packets: DataFrame) -> DataFrame:
    """``packet_id`` and a session for each record of each whole packet. Many-record packets carry no protocol; the
    size of the whole packet stands on each of its records."""
    size = F.length("payload")
    formed = packets.select("*", size.alias("size"), _form(size).alias("form")).where(F.col("form").isin("many", "legacy"))
    n = F.when(F.col("form") == "many", ((F.col("size") - HEADER) / RECORD).cast("int")).otherwise(1)
    each = formed.select("*", F.explode(F.sequence(F.lit(0), n - 1)).alias("record"))
    many = F.col("form") == "many"
    base = HEADER + RECORD * F.col("record")

    def field(name: str) -> Column:
        inside, alone = RECORD_FIELDS.get(name), LEGACY_FIELDS.get(name)
        a = unsigned(F.col("payload"), base + inside[0], inside[1]) if inside else F.lit(0)
        b = unsigned(F.col("payload"), *alone) if alone else F.lit(0)
        return F.when(many, a).otherwise(b)

    # Numbers first, each read once, and then what uses them several times.
    numbers = {c: field(c) for c in RECORD_FIELDS} | {"protocol_id": field("protocol_id"), "packet_s": unsigned(F.col("payload"), *LEGACY_FIELDS["packet_s"])}
    read = each.select("packet_id", "record", "received_s", "router_ip", "router_port", F.col("size").alias("packet_size"), *(v.alias(c) for c, v in numbers.items()))
    at = {f"{k}_time": F.timestamp_seconds(timestamp_fallback(F.col(f"{k}_s"), F.col("packet_s"), F.col("received_s"))) for k in ("start", "end")}
    columns = at | {"protocol_id": F.col("protocol_id").cast("smallint"), "router_ip": F.col("router_ip"), "router_port": F.col("router_port"), "packet_size": F.col("packet_size")}
    columns |= {c: F.col(c).cast("int" if c.endswith("port") else "bigint") for c in SESSION_COLUMNS if c not in columns}
    return read.select("packet_id", "record", *(columns[c].alias(c) for c in SESSION_COLUMNS))


def packet_errors(packets: DataFrame) -> DataFrame:
    """Packets that can't be decoded, with the reason."""
    size = F.length("payload")
    return packets.select("*", size.alias("packet_size"), _form(size).alias("reason")).where(F.col("reason").isin(TOO_SHORT, LEGACY_TOO_SHORT))


def migrate_v1_to_v2(sessions: DataFrame, start: Column, end: Column) -> DataFrame:
    """The columns of schema 2 of sessions that ended in [start, end)."""
    return sessions.where((F.col("end_time") >= start) & (F.col("end_time") < end)).select(*SESSION_COLUMNS)
