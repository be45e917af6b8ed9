"""Exact distinct counts that merge: bitmaps over dense whole-number keys.

A bitmap stands for a range of 32,768 keys and is made where the rows are, so a group with most of
the rows moves a bitmap per range and task, not its keys.  Bitmaps of fine groups merge into those
of coarser ones, which sums of distinct counts do not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_bitmaps(df: DataFrame, groups: Sequence[str], key: str) -> DataFrame:
    """`groups`, key_range, key_bits: the keys of each group, NULLs apart."""
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(key).alias("key_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("key_bits")
    )


def merge_bitmaps(bitmaps: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*groups, "key_range").agg(F.bitmap_or_agg("key_bits").alias("key_bits"))


def count_keys(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """`groups` and the number of distinct keys of each."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("key_bits")).alias(name))
