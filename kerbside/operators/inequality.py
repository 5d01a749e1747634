"""Counts of pairs under an inequality, without listing the pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.ranged import RANGE, inside, with_carried
from kerbside.session import materialise

_COUNT = "decimal(38,0)"
_RANGE_ROWS = 500_000


def pairs_above(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str, ranges: int | None = None) -> DataFrame:
    """For each key how many pairs of a left and a right row have a greater left value: (key, pairs), none without a pair.

    A left value beyond all right values of its key meets every one of them, which the key's number of right rows tells.
    Only keys with a left value between their right values need more: there both sides are dealt out by ranges of (key,
    value) and equal values are counted, and cumulative counts in the order of a range give the right rows below each left
    value. Ranges have about ``_RANGE_ROWS`` rows and a partition of their own, so a key with very many rows on both sides
    takes n log n steps in many tasks, and none of them grows with the input. Tables of a row per key are written, so that
    their true size tells whether a join may broadcast them: no side is shuffled by a hot key.
    """
    lefts = left.filter(F.col(key).isNotNull() & F.col(left_value).isNotNull()).select(F.col(key), F.col(left_value).alias("_v"))
    rights = right.filter(F.col(key).isNotNull() & F.col(right_value).isNotNull()).select(F.col(key).alias("_k"), F.col(right_value).alias("_v"))
    ends = materialise(rights.groupBy("_k").agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.count("*").alias("_n")), "key-ends")
    met = materialise(lefts.join(ends, F.col(key) == F.col("_k")).filter("_v > _low").drop("_k", "_low"), "pairs-met")
    product = lambda a, b: (F.col(a).cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(_COUNT)
    beyond = met.filter("_v > _high").groupBy(key, "_n").agg(F.count("*").alias("_l"))
    easy = beyond.select(key, product("_l", F.col("_n")).alias("_p"))

    between = met.filter("_v <= _high").select(F.col(key), "_v", F.lit(1).cast("long").alias("_l"), F.lit(0).cast("long").alias("_r"))
    busy = materialise(between.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_rows")), "busy-keys")
    held = rights.join(busy.select("_k"), "_k", "left_semi")
    merged = between.unionByName(held.select(F.col("_k").alias(key), "_v", F.lit(0).cast("long").alias("_l"), F.lit(1).cast("long").alias("_r")))
    rows = busy.join(ends, "_k").agg(F.sum(F.col("_rows") + F.col("_n"))).first()[0] or 0
    parts = ranges or 1 + rows // _RANGE_ROWS
    dealt = merged.repartitionByRange(parts, key, "_v").groupBy(key, "_v").agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    dealt = materialise(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")
    dealt = with_carried(dealt, F.sum("_r"), F.sum("_here"), key, "_before").repartition(parts, RANGE)
    below = F.sum("_r").over(inside(key, "_v").rowsBetween(Window.unboundedPreceding, -1))
    counted = dealt.withColumn("_below", F.coalesce(below, F.lit(0)) + F.coalesce("_before", F.lit(0))).filter("_l > 0 and _below > 0")
    hard = counted.select(key, product("_l", F.col("_below")).alias("_p"))
    return easy.unionByName(hard).groupBy(key).agg(F.sum("_p").cast(_COUNT).alias("pairs"))
