"""Bloom filters of key columns as tables: small, mergeable by union, and tested by a join.

A filter of a group has ``buckets`` rows, a power of two; a key's hash names its row, and one bit in each of the row's
``BITMAPS`` bitmaps of 32768 bits. A group of n keys gets a row for every ``KEYS_PER_ROW`` keys, so a filter takes about
ten bits a key and lets about one in a hundred absent keys through, whatever the size of the group. No key is ever missed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAPS = 5
KEYS_PER_ROW = 16_384
MOST_ROWS = 512  # of a filter that is broadcast: 10 MB
_BITS = 32_768
FILTER_SCHEMA = "buckets int, bucket int, " + ", ".join(f"bits_{i} binary" for i in range(BITMAPS))


def buckets_for(keys: int) -> int:
    """Rows of the filter of a group with so many keys."""
    return 1 << max(0, (max(1, keys) - 1) // KEYS_PER_ROW).bit_length()


def _position(key: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(i)), F.lit(_BITS))


def _bucket(key: Column, buckets: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), buckets).cast("int")


def key_filters(df: DataFrame, key: str, group: str, sizes: dict[str, int]) -> DataFrame:
    """(group, buckets, bucket, bits_0 ...): the filters of the groups of ``df``; ``sizes`` gives their number of keys."""
    of_group = F.create_map(*[x for g, n in sizes.items() for x in (F.lit(g), F.lit(buckets_for(n)))])
    text = F.col(key).cast("string")
    placed = df.filter(F.col(key).isNotNull()).select(F.col(group), text.alias("_key"), of_group[F.col(group)].alias("buckets"))
    bits = [F.bitmap_construct_agg(_position(F.col("_key"), i)).alias(f"bits_{i}") for i in range(BITMAPS)]
    return placed.groupBy(group, "buckets", _bucket(F.col("_key"), F.col("buckets")).alias("bucket")).agg(*bits)


def _is_set(bits: str, key: Column, i: int) -> Column:
    position = _position(key, i)
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def groups_holding(filters: DataFrame, groups: list[str], buckets: list[int], keys: DataFrame, key: str) -> DataFrame:
    """The distinct groups whose filter lets one of ``keys`` through; ``buckets`` are the numbers of rows that occur."""
    text = F.col(key).cast("string")
    asked = keys.filter(F.col(key).isNotNull()).select(text.alias("_key"), F.explode(F.array(*[F.lit(b) for b in sorted(set(buckets))])).alias("buckets"))
    asked = asked.withColumn("bucket", _bucket(F.col("_key"), F.col("buckets")))
    met = filters.join(asked, ["buckets", "bucket"])
    for i in range(BITMAPS):
        met = met.filter(_is_set(f"bits_{i}", F.col("_key"), i))
    return met.select(*groups).distinct()


def rows_maybe_held(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` may be among ``keys``: all that are, and about one in a hundred of the others.

    The filter is broadcast and at most ``MOST_ROWS`` rows large; beyond 8 million keys it lets more of the others through.
    """
    keys = keys.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"))
    buckets = F.lit(min(MOST_ROWS, buckets_for(keys.count())))
    bits = [F.bitmap_construct_agg(_position(F.col("_key"), i)).alias(f"bits_{i}") for i in range(BITMAPS)]
    filters = keys.groupBy(_bucket(F.col("_key"), buckets).alias("_bucket")).agg(*bits)
    met = df.join(F.broadcast(filters), _bucket(F.col(column), buckets) == F.col("_bucket"))
    for i in range(BITMAPS):
        met = met.filter(_is_set(f"bits_{i}", F.col(column), i))
    return met.select(*df.columns)
