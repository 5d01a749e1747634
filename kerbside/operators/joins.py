"""Existence joins, anti joins and joins whose key may be badly skewed."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.session import materialise

# A key is hot when it holds more than this share of the rows, so there are never more than 1 / share of them.
HOT_SHARE = 0.01
# Number of parts a hot key is split into.
SPREAD = 256


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """The few key values that hold more than ``share`` of all rows, found with one bounded-memory aggregate.

    Only the choice of join strategy depends on this list, never the result of the join.
    """
    most = math.ceil(1 / share)
    found = (
        df.select(F.col(key).alias("k"))
        .filter(F.col("k").isNotNull())
        .agg(F.expr(f"approx_top_k(k, {most}, {most * 100})").alias("top"), F.count("*").alias("n"))
        .first()
    )
    return [entry["item"] for entry in (found["top"] or []) if entry["count"] > share * found["n"]]


def skew_safe_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread: int = SPREAD, share: float = HOT_SHARE, hot: list | None = None
) -> DataFrame:
    """Equi-join (inner or left semi) of a large ``left`` whose key may be hot with a ``right`` of few rows per key.

    Rows of a hot key are spread over ``spread`` reducers by the map task they come from, and the matching right
    rows, at most ``1 / share`` keys, are repeated once per part. The part number depends on the task and not on
    row order, so a task that runs again after a lost executor sends its rows to the same place. Without a hot
    key this is a plain join. ``hot`` saves the search where the hot keys are known.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    hot = hot_keys(left, key, share) if hot is None else hot
    if not hot:
        return left.join(right, key, how)
    is_hot = F.col(key).isin(hot)
    part = F.when(is_hot, F.pmod(F.spark_partition_id(), F.lit(spread))).otherwise(F.lit(0))
    parts = F.when(is_hot, F.sequence(F.lit(0), F.lit(spread - 1))).otherwise(F.array(F.lit(0)))
    spread_left = left.withColumn("_part", part)
    spread_right = right.withColumn("_part", F.explode(parts))
    return spread_left.join(spread_right, [key, "_part"], how).drop("_part")


def existing_only(df: DataFrame, other: DataFrame, key: str, **skew: float) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``. ``other`` should hold each key once or a few times."""
    return skew_safe_join(df, other.select(key), key, "left_semi", **skew)


def existing_in_dimension(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``dimension``.

    The distinct keys of the dimension are written first, so that Spark's own size check sees their true bytes: a
    small dimension is broadcast and ``df`` is not shuffled; for a larger one Spark splits hot keys at run time.
    """
    keys = materialise(dimension.select(key).distinct(), "dimension-keys")
    return df.join(keys, key, "left_semi")


def not_in(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``; null keys stay.

    ``df`` is expected to hold each key once (a deduplicated table); the keys of ``other`` are made distinct
    before the shuffle, so repeated keys there do not gather.
    """
    return df.join(other.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def with_presence(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a boolean column telling whether the key of each row occurs in ``other``."""
    keys = other.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(flag, F.lit(True))
    return df.join(keys, key, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
