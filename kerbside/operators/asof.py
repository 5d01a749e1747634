"""As-of lookup: the latest known value at or before a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.operators.ranged import in_ranges, inside, with_carried
from kerbside.session import materialise


def asof_lookup(
    points: DataFrame, facts: DataFrame, key: str, point_time: str, fact_time: str, value: str, ranges: int | None = None
) -> DataFrame:
    """For each distinct (key, time) of ``points`` the value of the latest fact of that key at or before it.

    Times are compared exactly, to the microsecond. Of several facts of one key and time the greatest value counts.
    Points and facts are merged in order of (key, time), in ranges (``ranges`` of them, or as many as Spark shuffles
    into). Inside a range the value is carried forward by a window; across ranges only the last value of each key. So
    no task holds all times of a key, even if they lie within one second. Points before the first fact get null.
    """
    known = facts.select(F.col(key), F.col(fact_time).alias("_t"), F.col(value).alias("_v")).filter("_v is not null and _t is not null")
    known = known.groupBy(key, "_t").agg(F.max("_v").alias("_v"))
    asked = points.select(F.col(key), F.col(point_time).alias("_t")).distinct()
    at = F.col("_t").cast("timestamp_ntz").alias("_at")
    no_value, no_time = F.lit(None).cast(facts.schema[value].dataType), F.lit(None).cast(points.schema[point_time].dataType)
    events = asked.select(key, at, F.lit(1).alias("_asks"), "_t", no_value.alias("_v")).unionByName(
        known.select(key, at, F.lit(0).alias("_asks"), no_time.alias("_t"), "_v")
    )
    merged = in_ranges(events, key, "_at", "_asks", ranges=ranges)
    newest = F.max_by("_v", F.when(F.col("_asks") == 0, F.col("_at")))
    merged = with_carried(merged, newest, F.last("_here", ignorenulls=True), key, "_carried")
    here = F.last("_v", ignorenulls=True).over(inside(key, "_at", "_asks").rowsBetween(Window.unboundedPreceding, 0))
    found = merged.withColumn("_found", here).filter(F.col("_asks") == 1)
    return found.select(key, F.col("_t").alias(point_time), F.coalesce("_found", "_carried").alias(value))


def asof_join(
    left: DataFrame, facts: DataFrame, key: str, left_time: str, fact_time: str, value: str, ranges: int | None = None
) -> DataFrame:
    """Left join of each row to the latest fact at or before its time.

    Only distinct (key, time) pairs take part in the lookup; the answer is written, so its true size decides
    between a broadcast and a shuffle join, and in the latter Spark splits hot pairs at run time.
    """
    points = materialise(left.select(key, left_time).distinct(), "asof-points")
    found = materialise(asof_lookup(points, facts, key, left_time, fact_time, value, ranges), "asof")
    return left.join(found, [key, left_time], "left")
