"""Streams with state of their own: exact sliding bursts, newest versions, and searches of valid sessions.

All three hand their rows to a fact table, which notes each micro-batch, so that a replay changes nothing and small files
are compacted. Event times need a zone for watermarks: wall-clock times are read in the session time zone, which should
be UTC. State lives in RocksDB and is dropped once the watermark has passed it. What arrives later than ``delay`` is lost,
as with any watermark; choose it for the latest arrival that still counts.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kerbside.constants import BURST_SECONDS, BURST_THRESHOLD
from kerbside.sources.facts import FactTable

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _rocks_state(spark: SparkSession):
    """A query keeps the settings it was started with; the session gets its own back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _into(rows: DataFrame, fact: FactTable, checkpoint: str, mode: str, prepare: Callable[[DataFrame], DataFrame], **merging: bool) -> StreamingQuery:
    def merge(batch: DataFrame, batch_id: int) -> None:
        fact.merge(prepare(batch), checkpoint, batch_id, **merging)

    with _rocks_state(rows.sparkSession):
        writer = rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        return writer.foreachBatch(merge).start()


def stream_sliding_peaks(
    searches: DataFrame,
    fact: FactTable,
    checkpoint: str,
    seconds: int = BURST_SECONDS,
    threshold: int = BURST_THRESHOLD,
    delay: str = "10 minutes",
    block_seconds: int = 3600,
) -> StreamingQuery:
    """Exact sliding bursts: more than ``threshold`` searches of a session within any ``seconds`` consecutive seconds.

    State is one aggregate per session and block of time, with the tail of the block before, as in the batch operator: the
    events of each second, at most ``block_seconds + seconds`` counts, however long or busy a session is. A histogram with
    as many bins as there can be seconds only ever joins bins of one second, whose place may move by a rounding error, so
    that its counts are exact. It goes when the watermark has passed the end of its block by two
    blocks. ``fact`` (key ``burst_key``, time ``block_start``) holds the peak of each block; see ``peaks``. Peaks that the
    table holds already are not handed on.
    """
    if seconds > block_seconds:
        raise ValueError("a block must be at least as long as the window")
    second = F.unix_seconds(F.col("searched_at").cast("timestamp"))
    timed = searches.filter("session_id is not null and searched_at is not null").select("session_id", second.alias("second"))
    own = F.floor(F.col("second") / block_seconds)
    in_tail = F.pmod(F.col("second"), F.lit(block_seconds)) > block_seconds - seconds
    placed = timed.withColumn("block", F.explode(F.when(in_tail, F.array(own, own + 1)).otherwise(F.array(own))))
    start = F.col("block") * block_seconds
    ended = placed.select("session_id", F.timestamp_seconds(start + block_seconds).alias("_end"), (F.col("second") - start).cast("double").alias("_at"))
    # An event's blocks end at most two blocks after it, so nothing within ``delay`` is late.
    found = (
        ended.withWatermark("_end", f"{delay} {2 * block_seconds} seconds")
        .groupBy("session_id", "_end")
        .agg(F.histogram_numeric("_at", F.lit(block_seconds + seconds)).alias("_seconds"), F.count("*").alias("_n"))
        .filter(F.col("_n") > threshold)
    )

    def prepare(batch: DataFrame) -> DataFrame:
        block = F.floor(F.unix_seconds("_end") / block_seconds) - 1
        counts = batch.select("session_id", block.alias("block"), F.inline("_seconds").alias("_at", "_events")).withColumn("_at", F.round("_at").cast("long"))
        window = Window.partitionBy("session_id", "block").orderBy("_at").rangeBetween(-(seconds - 1), 0)
        inside = counts.withColumn("_inside", F.sum("_events").over(window)).filter(F.col("_at") >= 0)
        best = inside.groupBy("session_id", "block").agg(F.max("_inside").cast("long").alias("peak")).filter(F.col("peak") > threshold)
        begun = F.timestamp_seconds(F.col("block") * block_seconds).cast("timestamp_ntz")
        rows = best.select(F.concat_ws("|", "session_id", "block").alias("burst_key"), "session_id", begun.alias("block_start"), "peak")
        return rows.join(fact.read().select("burst_key", "peak"), ["burst_key", "peak"], "left_anti").select(*rows.columns) if fact.exists() else rows

    return _into(found, fact, checkpoint, "update", prepare)


def peaks(blocks: DataFrame) -> DataFrame:
    """The peak of each session over its blocks."""
    return blocks.groupBy("session_id").agg(F.max("peak").alias("peak"))


def stream_newest(
    staged: DataFrame, fact: FactTable, checkpoint: str, delay: str = "10 minutes", keep_days: int = 30, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> StreamingQuery:
    """Only new keys and newer versions reach the fact table, in whatever order files arrive.

    State is one aggregate: the newest row of each key and period of ``keep_days``, held for ``keep_days`` to twice that
    after its time; ties follow the columns as in the batch. With the row goes the micro-batch that brought it first, the
    earliest of equal rows, so copies and older versions of a period end there and cost the table nothing. Between
    periods, and after the time-out, the table's own rule holds: an older version never replaces a newer one. Rows
    without a key are left out; a NaN counts as missing.
    """
    kinds = {f.name: f.dataType.simpleString() for f in staged.schema}
    value = lambda c: F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("float", "double") else F.col(c)
    order = [fact.ts, *[c for c in kinds if c not in (fact.key, fact.ts)]]
    came = (-F.unix_micros(F.current_timestamp())).alias("_came")  # the same for all rows of a micro-batch
    period = keep_days * 86_400
    until = F.timestamp_seconds((F.floor(F.unix_seconds(F.col(fact.ts).cast("timestamp")) / period) + 2) * period)
    timed = staged.filter(F.col(fact.key).isNotNull()).select(F.col(fact.key).alias("_key"), until.alias("_until"), F.struct(*[value(c).alias(c) for c in order], came).alias("_row"))
    # A row's period ends at most two periods after its time, so that much later its state goes.
    found = timed.withWatermark("_until", f"{delay} {2 * keep_days} days").groupBy("_key", "_until").agg(F.max("_row").alias("_row"))
    fresh = found.filter(F.col("_row._came") == came)

    def newest(batch: DataFrame) -> DataFrame:
        rows = batch.groupBy("_key").agg(F.max("_row").alias("_row"))
        return prepare(rows.select(*[(F.col("_key") if c == fact.key else F.col("_row")[c]).alias(c) for c in kinds]))

    return _into(fresh, fact, checkpoint, "update", newest, timeless_is_oldest=True)


def stream_searches_of_sessions(
    searches: DataFrame,
    sessions: DataFrame,
    fact: FactTable,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    delay: str = "1 day",
    longest: str = "1 day",
) -> StreamingQuery:
    """Searches made in a session of people, joined stream against stream, into a fact table.

    Each side has a watermark, and a search lies between the start of its session and ``longest`` after it (or as long
    before it, for clocks that differ), so both sides' state is bounded. A search waits for a session that arrives later.
    """
    made = searches.withColumn("_made_at", F.col("searched_at").cast("timestamp")).withWatermark("_made_at", delay)
    people = sessions.filter("not is_bot").select(F.col("session_id").alias("_session"), F.col("started_at").cast("timestamp").alias("_begun_at"))
    people = people.withWatermark("_begun_at", delay)
    close = F.expr(f"_made_at >= _begun_at - interval {longest} and _made_at <= _begun_at + interval {longest}")
    joined = made.join(people, (F.col("session_id") == F.col("_session")) & close, "left_semi")
    return _into(joined.drop("_made_at"), fact, checkpoint, "append", prepare)
