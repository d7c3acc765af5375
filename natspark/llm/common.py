"""Shared helpers: the shared work folder, written intermediate tables, and the words of a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.sources.shared import shared_dir, stored

__all__ = ["GAP", "WORD", "documents", "free_name", "shared_dir", "stored", "word_count"]

#: A word is a maximal run of characters other than these six (space, tab, newline, vertical tab, form feed, return).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def word_count(text: Column) -> Column:
    """Number of words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
