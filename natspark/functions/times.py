"""Instants, and days and hours at the fixed offset of UTC-5. Nothing here depends on the session's time zone."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

OFFSET_S = -5 * 3600
DAY_S, HOUR_S = 86_400, 3_600


def timestamp_fallback(record_s: Column, packet_s: Column, received_s: Column) -> Column:
    """Seconds of the record, the packet or the reception, whichever is first not zero; else of now."""
    some = [F.nullif(c.cast("bigint"), F.lit(0).cast("bigint")) for c in (record_s, packet_s, received_s)]
    return F.coalesce(*some, F.unix_timestamp())


def event_date(instant: Column) -> Column:
    """The local day of an instant; sessions belong to the day of their ``end_time``."""
    return F.date_from_unix_date(F.floor((F.unix_seconds(instant) + OFFSET_S) / DAY_S).cast("int"))


def day_suffix(day: Column) -> Column:
    return F.date_format(day, "yyyy_MM_dd")


def hour_utc(instant: Column) -> Column:
    """Start of the hour; the offset is a whole number of hours, so the local hour starts at the same instant."""
    return F.timestamp_seconds(F.floor(F.unix_seconds(instant) / HOUR_S) * HOUR_S)


hour_lima = hour_utc


def day_bounds(day: Column | datetime.date) -> tuple[Column, Column]:
    """The half-open local day as two instants."""
    day = F.lit(day) if isinstance(day, datetime.date) else day
    start = F.unix_date(day).cast("bigint") * DAY_S - OFFSET_S
    return F.timestamp_seconds(start), F.timestamp_seconds(start + DAY_S)


def in_day(instant: Column, day: Column | datetime.date) -> Column:
    start, stop = day_bounds(day)
    return (instant >= start) & (instant < stop)
