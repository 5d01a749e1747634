"""Streaming twins: burst detection and the incremental fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.constants import BURST_SECONDS, BURST_THRESHOLD
from kerbside.sources.facts import FactTable


def stream_burst_counts(
    searches: DataFrame,
    checkpoint: str,
    out: str,
    seconds: int = BURST_SECONDS,
    delay: str = "10 minutes",
    slide_seconds: int | None = None,
) -> StreamingQuery:
    """Count searches per session and bucket, and keep the counts current under ``out``.

    Buckets are fixed; with ``slide_seconds`` a new one starts that often, so that a burst across the edge of one
    bucket lies inside another.

    Update mode sends each changed count once per micro-batch, so open buckets are visible before the watermark
    passes them and state of closed ones is dropped. Every micro-batch overwrites its own folder: a batch that is
    replayed after a failure leaves no second copy. A watermark needs a time with a zone, so wall-clock times are
    read in the session time zone, which should be UTC.
    """
    slide = f"{slide_seconds or seconds} seconds"
    counts = (
        searches.select("session_id", F.col("searched_at").cast("timestamp").alias("event_time"))
        .withWatermark("event_time", delay)
        .groupBy("session_id", F.window("event_time", f"{seconds} seconds", slide).alias("bucket"))
        .agg(F.count("*").alias("n"))
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("session_id", F.col("bucket.start").alias("bucket_start"), "n")
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )


def bursts_from_counts(counts: DataFrame, threshold: int = BURST_THRESHOLD) -> DataFrame:
    """Peak per session from the kept counts. A bucket's count only grows, so its newest value is its largest."""
    return (
        counts.filter(F.col("n") > threshold)
        .groupBy("session_id")
        .agg(F.max("n").alias("pico_buscas_5min"))
    )


def stream_into_fact(
    arrivals: DataFrame, fact: FactTable, prepare: Callable[[DataFrame], DataFrame], checkpoint: str
) -> StreamingQuery:
    """Feed a stream of staged rows into a fact table, one load per micro-batch.

    ``prepare`` turns a micro-batch into valid rows with unique keys, with the same functions the batch job uses.
    All rows of a micro-batch take part, in whatever order files arrive and however many make a batch: the newest
    version of a key stays. The fact table notes the batch of the stream, which its checkpoint names, so that a
    replayed micro-batch changes nothing.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        fact.merge(prepare(batch), checkpoint, batch_id)

    return (
        arrivals.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )
