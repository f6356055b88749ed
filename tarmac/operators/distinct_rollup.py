"""Distinct counts that add up: exact bitmaps per group and range of numbers, stored per load and united later."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_bitmaps(rows: DataFrame, groups: list[str], values: list[str]) -> DataFrame:
    """(groups, value_name, bucket, bits): which numbers occur, in bitmaps of 4 KB for each range of 32,768 of them.

    Any whole numbers do; NULL is left out. Rows are combined before the shuffle, so a frequent group or value costs a
    bitmap per task. Numbers far apart make nearly empty bitmaps: use it for dense ids.
    """
    parts = []
    for name in values:
        value = F.col(name).cast("bigint")
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
        keyed = rows.filter(value.isNotNull()).groupBy(*groups, F.lit(name).alias("value_name"), F.bitmap_bucket_number(value).alias("bucket"))
        parts.append(keyed.agg(bits))
    return reduce(DataFrame.unionByName, parts)


def united_counts(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """(groups, value_name, n_distinct) over all bitmaps of a group, of whichever loads; what occurs in several counts once."""
    united = bitmaps.groupBy(*groups, "value_name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*groups, "value_name").agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))
