"""Outliers against mean and population standard deviation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_sigma_limits(df: DataFrame, value: str, sigmas: float) -> DataFrame:
    """Add ``mean``, ``sigma``, ``upper``, ``lower`` and ``above`` (value strictly over the upper limit).

    Mean and deviation come from one aggregate used as a scalar subquery; there is no join.
    """
    stats = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev_pop(value).alias("sigma"))).scalar()
    return (
        df.withColumn("_stats", stats)
        .withColumn("mean", F.col("_stats.mean"))
        .withColumn("sigma", F.col("_stats.sigma"))
        .drop("_stats")
        .withColumn("upper", F.col("mean") + F.lit(float(sigmas)) * F.col("sigma"))
        .withColumn("lower", F.col("mean") - F.lit(float(sigmas)) * F.col("sigma"))
        .withColumn("above", F.col(value) > F.col("upper"))
    )
