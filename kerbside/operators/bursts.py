"""Bursts of events of one actor within a short time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.time import bucket_start, epoch_seconds


def fixed_bursts(df: DataFrame, actor: str, ts: str, seconds: int, threshold: int) -> DataFrame:
    """Actors with more than ``threshold`` events in one fixed bucket: columns ``actor`` and ``peak``.

    Buckets at or below the threshold are dropped before the second aggregation, which leaves it almost nothing.
    """
    per_bucket = df.groupBy(F.col(actor), bucket_start(ts, seconds).alias("_bucket")).agg(F.count("*").alias("_n"))
    return per_bucket.filter(F.col("_n") > threshold).groupBy(actor).agg(F.max("_n").alias("peak"))


def sliding_bursts(
    df: DataFrame, actor: str, ts: str, seconds: int, threshold: int, block_seconds: int = 3600
) -> DataFrame:
    """Actors with more than ``threshold`` events within any ``seconds`` consecutive seconds, with their peak.

    Events are counted per actor and second before the shuffle. Time is cut into blocks and the tail of each
    block is repeated at the head of the next, so a window task sees at most ``block_seconds + seconds`` rows
    however many events an actor has, and no burst is lost at a block edge.
    """
    if seconds > block_seconds:
        raise ValueError("a block must be at least as long as the window")
    per_second = df.groupBy(F.col(actor), epoch_seconds(ts).alias("_second")).agg(F.count("*").alias("_n"))
    block = F.floor(F.col("_second") / block_seconds)
    in_tail = F.pmod(F.col("_second"), F.lit(block_seconds)) > block_seconds - seconds
    placed = (
        per_second.withColumn("_own", block)
        .withColumn("_block", F.explode(F.when(in_tail, F.array(block, block + 1)).otherwise(F.array(block))))
    )
    window = Window.partitionBy(actor, "_block").orderBy("_second").rangeBetween(-(seconds - 1), 0)
    counted = placed.withColumn("_in_window", F.sum("_n").over(window)).filter(F.col("_own") == F.col("_block"))
    return counted.filter(F.col("_in_window") > threshold).groupBy(actor).agg(F.max("_in_window").alias("peak"))
