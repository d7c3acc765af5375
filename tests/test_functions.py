import datetime

import pytest
from pyspark.sql import functions as F

from natspark.functions import ipv4, names, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("text, number", [("0.0.0.0", 0), ("10.0.0.1", 167772161), ("255.255.255.255", 4294967295), ("256.1.1.1", 0), ("1.2.3", 0), ("", 0), ("x", 0), ("1.2.3.4\n", 0)])
def test_ip_to_long(spark, text, number):
    assert one(spark, ipv4.ip_to_long(F.lit(text))) == number


def test_strict_addresses(spark):
    with pytest.raises(Exception, match="not an address"):
        one(spark, ipv4.ip_to_long(F.lit("1.2.3"), strict=True))
    assert one(spark, ipv4.ip_to_long(F.lit(None).cast("string"))) is None


def test_long_to_ip(spark):
    assert one(spark, ipv4.long_to_ip(F.lit(3355508736))) == "200.1.0.0"


@pytest.mark.parametrize(
    "day, after",
    [(datetime.date(2025, 4, 30), "2025-05-01"), (datetime.date(2029, 12, 31), "2030-01-01"), (datetime.date(2028, 2, 29), "2028-03-01"), (datetime.date(2027, 2, 28), "2027-03-01")],
)
def test_day_bounds(spark, day, after):
    start, stop = times.day_bounds(day)
    assert str(one(spark, start)) == f"{day} 05:00:00" and str(one(spark, stop)) == f"{after} 05:00:00"


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_midnight_whatever_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.timestamp_seconds(F.lit(1804568400))  # 2027-03-09 00:00 at UTC-5
        assert str(one(spark, times.event_date(at).cast("string"))) == "2027-03-09"
        assert str(one(spark, times.event_date(F.timestamp_seconds(F.lit(1804568399))).cast("string"))) == "2027-03-08"
        assert one(spark, times.in_day(at, datetime.date(2027, 3, 9)))
        assert one(spark, times.day_suffix(times.event_date(at))) == "2027_03_09"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("record, packet, received, want", [(5, 6, 7, 5), (0, 6, 7, 6), (0, 0, 7, 7)])
def test_timestamp_fallback(spark, record, packet, received, want):
    assert one(spark, times.timestamp_fallback(*map(F.lit, (record, packet, received)))) == want


def test_timestamp_fallback_to_now(spark):
    assert one(spark, times.timestamp_fallback(F.lit(0), F.lit(0), F.lit(0))) > 1_700_000_000


@pytest.mark.parametrize("name, good", [("a", True), ("a.b_1", True), ("1a", False), ("a.b.c", False), ("a.", False), ("", False), ("a\n", False), ("ä", False)])
def test_table_names(spark, name, good):
    assert one(spark, names.valid_table_name(F.lit(name))) is good


def test_names(spark):
    assert [one(spark, names.protocol_name(F.lit(k))) for k in (0, 1, 6, 17, 99)] == ["unknown", "icmp", "tcp", "udp", "99"]
    assert one(spark, names.batch_id(F.lit("a"))) == "batch-ca978112ca1bbdcafac231b3"
