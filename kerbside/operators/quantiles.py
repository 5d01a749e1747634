"""Exact interpolated quantiles per group, without holding a group in one task."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.session import materialise

BINS = 4096
# A slice of at most this many distinct values may be ranked inside one task.
SLICE_VALUES = 1_000_000
_LARGEST = sys.float_info.max


def exact_quantiles(
    df: DataFrame, group: str, value: str, probs: Sequence[float], slice_values: int = SLICE_VALUES, bins: int = BINS
) -> DataFrame:
    """``percentile_cont`` of ``value`` per ``group``: columns ``group``, ``q_0``, ``q_1``, ...

    Values are counted per (group, value) first, so repeated values shrink before the shuffle. Each wanted rank
    is then narrowed down by histograms of at most ``bins`` rows per group until the slice of values that holds it
    has at most ``slice_values`` entries, and only that slice is ranked. Every step is exact and no task ever sees
    a whole group; Spark's ``percentile`` would keep all values of a group in one buffer.
    """
    counts = materialise(
        df.filter(F.col(value).isNotNull())
        .groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
        .agg(F.count("*").alias("n")),
        "value-counts",
    )
    position = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    ranks = F.array_sort(
        F.array_distinct(F.array(*[edge(p).cast("long") for p in position for edge in (F.floor, F.ceil)]))
    )
    sizes = materialise(
        counts.groupBy("g").agg(
            F.min("v").alias("lo"),
            F.max("v").alias("hi"),
            F.sum("n").alias("total"),
            F.count("*").alias("distinct_values"),
        ),
        "group-sizes",
    )
    slices = sizes.select("g", "lo", "hi", F.lit(0).cast("long").alias("before"), ranks.alias("ranks"), "distinct_values")

    largest = _largest(slices)
    while largest > slice_values:
        slices = materialise(_narrow(counts, slices, bins), "rank-slices")
        previous, largest = largest, _largest(slices)
        if largest >= previous:
            raise RuntimeError(f"{largest} distinct values within one double step of each other")

    by_value = Window.partitionBy("g", "lo").orderBy("v")
    ranked = _in_slices(counts, slices).withColumn(
        "until", F.col("before") + F.sum("n").over(by_value.rowsBetween(Window.unboundedPreceding, 0))
    )
    at_rank = ranked.select(
        "g",
        "v",
        F.explode(F.filter("ranks", lambda r: (r >= F.col("until") - F.col("n")) & (r < F.col("until")))).alias("rank"),
    )
    values = at_rank.groupBy(F.col("g").alias("vg")).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at")
    )
    totals = sizes.select(F.col("g").alias(group), "total")
    out = totals.join(values, F.col(group).eqNullSafe(F.col("vg")))
    quantiles = []
    for i, p in enumerate(position):
        low, high = F.floor(p).cast("long"), F.ceil(p).cast("long")
        below, above = F.element_at("at", low), F.element_at("at", high)
        weight = p - F.floor(p)
        between = below * (F.lit(1.0) - weight) + above * weight
        # An infinite neighbour counts only where it has weight.
        quantiles.append(F.when((weight == 0) | (below == above), below).otherwise(between).alias(f"q_{i}"))
    return out.select(group, *quantiles)


def _largest(slices: DataFrame) -> int:
    return slices.agg(F.max("distinct_values")).first()[0] or 0


def _in_slices(counts: DataFrame, slices: DataFrame) -> DataFrame:
    """Value counts that fall into a slice. Slices are a small written table, so Spark's size check applies."""
    s = slices.select(F.col("g").alias("sg"), "lo", "hi", "before", "ranks")
    inside = F.col("g").eqNullSafe(F.col("sg")) & (F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi"))
    return counts.join(s, inside).drop("sg")


def _narrow(counts: DataFrame, slices: DataFrame, bins: int) -> DataFrame:
    """Cut every slice into ``bins`` equal widths and keep the bins that hold a wanted rank.

    Infinite values and NaN have bins of their own at the ends, so that the widths are those of finite numbers.
    """
    finite = lambda c: F.greatest(F.least(F.col(c), F.lit(_LARGEST)), F.lit(-_LARGEST)) / 2
    width = finite("hi") - finite("lo")
    share = F.when(width == 0, F.lit(0.0)).otherwise((finite("v") - finite("lo")) / F.nullif(width, F.lit(0.0)))
    inner = F.least(F.floor(share * bins), F.lit(bins - 1))
    place = F.when(F.isnan("v"), bins + 1).when(F.col("v") > _LARGEST, bins).when(F.col("v") < -_LARGEST, -1).otherwise(inner)
    histogram = (
        _in_slices(counts, slices)
        .withColumn("bin", place)
        .groupBy("g", "lo", "before", "ranks", "bin")
        .agg(
            F.sum("n").alias("n"),
            F.min("v").alias("bin_lo"),
            F.max("v").alias("bin_hi"),
            F.count("*").alias("distinct_values"),
        )
    )
    running = Window.partitionBy("g", "lo").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    bounds = histogram.withColumn("until", F.col("before") + F.sum("n").over(running))
    wanted = F.filter("ranks", lambda r: (r >= F.col("until") - F.col("n")) & (r < F.col("until")))
    return (
        bounds.withColumn("wanted", wanted)
        .filter(F.size("wanted") > 0)
        .select(
            "g",
            F.col("bin_lo").alias("lo"),
            F.col("bin_hi").alias("hi"),
            (F.col("until") - F.col("n")).alias("before"),
            F.col("wanted").alias("ranks"),
            "distinct_values",
        )
    )


def iqr_upper_outliers(
    df: DataFrame,
    group: str,
    value: str,
    factor: float,
    limit_name: str,
    slice_values: int = SLICE_VALUES,
    quartiles: DataFrame | None = None,
) -> DataFrame:
    """Rows whose value lies above ``q3 + factor * (q3 - q1)`` of their group, with that limit.

    Rows without a group form one. The limits, one row per group, are written once; their true size decides whether
    the join broadcasts them. ``quartiles`` (group, q_0, q_1) takes the place of the exact ones, for instance from summaries.
    """
    if quartiles is None:
        quartiles = exact_quantiles(df, group, value, (0.25, 0.75), slice_values)
    limit = F.col("q_1") + F.lit(factor) * (F.col("q_1") - F.col("q_0"))
    limits = materialise(quartiles.select(F.col(group).alias("_group"), limit.alias(limit_name)), "iqr-limits")
    above = df.join(limits, df[group].eqNullSafe(limits["_group"])).drop("_group")
    return above.filter(F.col(value) > F.col(limit_name)).select(group, *[c for c in df.columns if c != group], limit_name)
