"""Mergeable quantile summaries (KLL sketches): an opt-in for quantiles over many loads, with a stated rank error.

A summary of a group is a few kilobytes, whatever its rows. Summaries of loads or days are kept and merged; the rows are
not read again. ``exact_quantiles`` stays the default wherever a result must be exact. Nulls and NaN are left out, and a
group without values has no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 800


def rank_error(size: int = SIZE) -> float:
    """Difference of ranks, as a share of the values, that a quantile stays within in 99 of 100 cases."""
    return 2.296 / size**0.9723


def value_sketches(df: DataFrame, by: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(by ..., sketch): one summary a group; tasks summarise their rows before the shuffle."""
    rows = df.select(*by, F.col(value).cast("double").alias("_value")).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    return rows.groupBy(*by).agg(F.kll_sketch_agg_double("_value", F.lit(size)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, by: Sequence[str], probs: Sequence[float], size: int = SIZE) -> DataFrame:
    """(by ..., n, q_0, q_1, ...): quantiles of each group of ``by``, from summaries of finer groups, loads or days."""
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", F.lit(size)).alias("_merged"))
    quantiles = [F.kll_sketch_get_quantile_double("_merged", F.lit(float(p))).alias(f"q_{i}") for i, p in enumerate(probs)]
    return merged.select(*by, F.kll_sketch_get_n_double("_merged").alias("n"), *quantiles)


def rank_distance(df: DataFrame, by: str, value: str, quantiles: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(by, n, d_0, d_1, ...): how far each quantile's rank lies from the wanted one, as a share of the group, counted exactly.

    ``quantiles`` has a row per group; a value that occurs often covers a range of ranks, within which the distance is 0.
    """
    limits = quantiles.select(F.col(by).alias("_by"), *[f"q_{i}" for i in range(len(probs))])
    rows = df.select(F.col(by), F.col(value).cast("double").alias("_value")).filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    rows = rows.join(limits, rows[by].eqNullSafe(limits["_by"]))
    counts = [F.count("*").alias("n")]
    for i in range(len(probs)):
        counts += [F.count_if(F.col("_value") < F.col(f"q_{i}")).alias(f"below_{i}"), F.count_if(F.col("_value") <= F.col(f"q_{i}")).alias(f"upto_{i}")]
    far = [F.greatest(F.lit(0.0), F.col(f"below_{i}") / F.col("n") - p, p - F.col(f"upto_{i}") / F.col("n")).alias(f"d_{i}") for i, p in enumerate(probs)]
    return rows.groupBy(by).agg(*counts).select(by, "n", *far)
