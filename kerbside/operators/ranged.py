"""Running values per key over rows that are dealt out by ranges of (key, order), so that a hot key is many ranges.

Spark samples the sort order and picks the split points, wherever the rows lie: neither a key with a third of all rows nor
a burst within one second ends up in one task. Inside a range a window runs per key; between ranges only one value for
each key and range is carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from kerbside.session import materialise

RANGE = "_range"


def in_ranges(df: DataFrame, *order: str, ranges: int | None = None) -> DataFrame:
    """``df`` with the number of its range; ranges follow each other in the given order. Written, so that they stay."""
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    return materialise(dealt.withColumn(RANGE, F.spark_partition_id()), "ranges")


def inside(key: str, *order: str) -> WindowSpec:
    """The rows of a key within a range, in order."""
    return Window.partitionBy(RANGE, key).orderBy(*order)


def with_carried(df: DataFrame, per_range: Column, over_ranges: Column, key: str, name: str) -> DataFrame:
    """``df`` with a column that holds, for each row, what the earlier ranges of its key come to.

    ``per_range`` aggregates the rows of a key in one range into ``_here``; ``over_ranges`` aggregates ``_here`` over the
    earlier ranges. The carried values are written, so that their true size tells whether the join may broadcast them."""
    summed = df.groupBy(key, RANGE).agg(per_range.alias("_here"))
    earlier = Window.partitionBy(key).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = summed.select(F.col(key).alias("_key"), F.col(RANGE).alias("_of"), over_ranges.over(earlier).alias(name))
    carried = materialise(carried, "carried")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col(RANGE) == F.col("_of"))
    return df.join(carried, same).drop("_key", "_of")
