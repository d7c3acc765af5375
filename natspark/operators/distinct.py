"""Exact numbers of distinct values without expanding rows: bitmaps for numbers that lie close together, such as ports and
addresses of a pool, and one grouping a column for the rest. Bitmaps are 4 kB for 32,768 numbers, are built before the
shuffle, and can be kept and merged."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bitmaps(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, bucket, bitmap, records``: which numbers of a bucket occur, and the rows there. Numbers are not negative;
    rows without one have no bitmap but are counted."""
    number = F.col(value).cast("bigint")
    return df.groupBy(*keys, F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bitmap"), F.count(F.lit(1)).alias("records"))


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of finer keys as those of ``keys``."""
    return parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.sum("records").alias("records"))


def counted(parts: DataFrame, keys: list[str], name: str, records: str = "records") -> DataFrame:
    """``keys, name, records`` from bitmaps: distinct numbers and rows."""
    of_bucket = F.when(F.col("bucket").isNotNull(), F.bitmap_count("bitmap")).otherwise(0)
    return parts.groupBy(*keys).agg(F.sum(of_bucket).alias(name), F.sum("records").alias(records))


def grouped(df: DataFrame, keys: list[str], value: Column | str, name: str, **sums: Column) -> DataFrame:
    """``keys, name`` and ``sums``: distinct values by grouping them first, so that a hot key is spread over its values. A sum is a column to add up
    over all rows."""
    each = df.groupBy(*keys, (F.col(value) if isinstance(value, str) else value).alias("_value"))
    each = each.agg(F.count(F.lit(1)).alias("_rows"), *(F.sum(c).alias(n) for n, c in sums.items()))
    return each.groupBy(*keys).agg(F.count("_value").alias(name), *(F.sum(n).alias(n) for n in sums))


def side_by_side(keys: list[str], *parts: DataFrame) -> DataFrame:
    """Reports of the same keys as one. Each was shuffled by these keys last, so joining them moves nothing."""
    return reduce(lambda a, b: a.join(b, keys), parts)
