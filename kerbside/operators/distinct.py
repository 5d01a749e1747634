"""Exact distinct counts that can be added up again: bitmaps over dense key numbers, one set per group and day.

A count of distinct keys per day cannot be summed to a month, as a key may occur on several days. A bitmap per day can be
merged with others by OR, so days are counted once and rolled up to any period or group later, without the rows. Keys get
numbers without gaps in order of their first day, so a day's keys lie in few bitmaps of 32768 keys (4 KB) each; later
loads number their new keys only. Nulls are no keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.joins import not_in
from kerbside.session import materialise

_ROW_BITS = 33  # monotonically_increasing_id holds the row in its partition in its lower 33 bits


def numbered(df: DataFrame, key: str, order: str, before: DataFrame | None = None) -> DataFrame:
    """(_key, _number): numbers from 1 for the distinct keys of ``df`` by their first ``order``, written. Keys of ``before``,
    an earlier result, keep their numbers, and new ones follow. Numbers come from the rows' places in sorted ranges and one
    running sum over the ranges, so no task sees all keys."""
    firsts = df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("first"))
    last = 0
    if before is not None:
        firsts = not_in(firsts, before, "_key")
        last = before.agg(F.coalesce(F.max("_number"), F.lit(0))).first()[0]
    ranges = firsts.repartitionByRange("first", "_key").sortWithinPartitions("first", "_key")
    placed = materialise(ranges.select("_key", F.monotonically_increasing_id().alias("place")), "key-places")
    part, row = F.shiftright("place", _ROW_BITS), F.col("place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
    before_part = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = materialise(sizes.select("part", F.coalesce(before_part, F.lit(0)).alias("start")), "range-starts")
    new = placed.join(starts, part == F.col("part")).select("_key", (row + F.col("start") + F.lit(last + 1)).alias("_number"))
    return materialise(new if before is None else before.unionByName(new), "key-numbers")


def key_bitmaps(df: DataFrame, by: Sequence[str], key: str, numbers: DataFrame) -> DataFrame:
    """(by ..., bucket, bits): the keys of each group. Rows are made distinct before they meet the numbers."""
    pairs = df.filter(F.col(key).isNotNull()).select(*by, F.col(key).alias("_key")).distinct()
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("bits")
    return pairs.join(numbers, "_key").groupBy(*by, F.bitmap_bucket_number("_number").alias("bucket")).agg(bits)


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str = "keys") -> DataFrame:
    """(by ..., name): distinct keys of each group of ``by``, from bitmaps of finer groups, loads or days."""
    merged = bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))
