"""Numbers of distinct days from states that merge.

A day is a bit; the days of a group are bitmaps of 32,768 bits (some 90 years). States of batches, reaches or years are put together by
OR, so a day that several of them hold counts once, at any level above, and no day is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_bitmaps(df: DataFrame, keys: Sequence[str], day: Column | str) -> DataFrame:
    """``keys``, ``bucket`` and ``bits``: the days of each group. Missing days don't count; a group without any day has no row."""
    number = F.unix_date(F.col(day) if isinstance(day, str) else day).cast("long")
    rows = df.select(*keys, number.alias("_day")).where(F.col("_day").isNotNull())
    return rows.groupBy(*keys, F.bitmap_bucket_number("_day").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_day")).alias("bits"))


def merge_days(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of fewer keys, or of several states that were put together with ``union``."""
    return state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_days_of(state: DataFrame, keys: Sequence[str], into: str = "days") -> DataFrame:
    return merge_days(state, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(into))
