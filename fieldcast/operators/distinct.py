"""Exact distinct counts of whole numbers as bitmaps that can be merged.

A bitmap covers 32,768 neighbouring numbers in 4 KB. Tasks set bits of their own rows and pass on
one bitmap per group and stretch of numbers, so rows are neither doubled (as by several distinct
counts at once) nor shuffled one by one. Suited to dense identifiers such as those of grid cells;
scattered ones would need a bitmap each and are better counted by ``count_distinct``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def number_bitmaps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``(keys, bucket, bits)``; a NULL sets no bit."""
    number = F.col(column).cast("long")
    return df.where(number.isNotNull()).groupBy(
        *keys, F.bitmap_bucket_number(number).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def merged_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, without another look at the rows."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_counts(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``(keys, name)`` with the number of distinct values of each group that has one."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))
