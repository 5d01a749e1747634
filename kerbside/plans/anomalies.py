"""Violations and suspicious patterns, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.constants import (
    BOT_CAUGHT_LABEL,
    BOT_MISSED_LABEL,
    BURST_SECONDS,
    BURST_THRESHOLD,
    IQR_FACTOR,
    LONG_SESSION_HOURS,
    NULL_CATEGORY_LABEL,
)
from kerbside.functions.time import hour_boundaries
from kerbside.operators.bursts import fixed_bursts, sliding_bursts
from kerbside.operators.inequality import pairs_above
from kerbside.operators.quantiles import SLICE_VALUES, iqr_upper_outliers
from kerbside.plans.metrics import revenue_bookings
from kerbside.session import materialise


def search_bursts(
    stg_searches: DataFrame,
    stg_sessions: DataFrame,
    threshold: int = BURST_THRESHOLD,
    seconds: int = BURST_SECONDS,
    sliding: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """Sessions with too many searches in a short time, beside the bot mark they already carry.

    Works on staging, so sessions marked as bots and repeated rows count. A session row that occurs twice in
    staging is listed twice, unless ``distinct``. The suspects are written first: their true size decides whether
    they are broadcast, and otherwise Spark may split a session with many copies.
    """
    find = sliding_bursts if sliding else fixed_bursts
    suspects = materialise(find(stg_searches, "session_id", "searched_at", seconds, threshold), "burst-suspects")
    caught = F.when(F.col("is_bot"), BOT_CAUGHT_LABEL).otherwise(BOT_MISSED_LABEL)
    out = stg_sessions.select("session_id", "is_bot").join(suspects, "session_id").select(
        "session_id",
        F.col("peak").alias("pico_buscas_5min"),
        F.col("is_bot").alias("ja_marcada_como_bot"),
        caught.alias("status_deteccao"),
    )
    return (out.distinct() if distinct else out).orderBy(F.desc_nulls_last("pico_buscas_5min"), F.asc("session_id"))


def clicks_without_result(searches: DataFrame) -> DataFrame:
    """Searches with a click although nothing was found."""
    odd = (F.col("num_results") == 0) & F.col("partner_id_clicked").isNotNull()
    return searches.filter(odd).select("search_id", "session_id", "num_results", "partner_id_clicked")


def long_sessions(sessions: DataFrame, hours: int = LONG_SESSION_HOURS) -> DataFrame:
    """Sessions that cross more than ``hours`` full hours."""
    length = hour_boundaries("started_at", "ended_at").cast("long")
    return sessions.select("session_id", "started_at", "ended_at", length.alias("duracao_horas")).filter(
        F.col("duracao_horas") > hours
    )


def amounts_by_category(bookings: DataFrame) -> DataFrame:
    """Revenue bookings with a positive amount; no category is a category too."""
    category = F.coalesce("car_category", F.lit(NULL_CATEGORY_LABEL))
    return revenue_bookings(bookings).filter(F.col("total_amount") > 0).withColumn("car_category", category)


def amount_outliers(
    bookings: DataFrame, factor: float = IQR_FACTOR, slice_values: int = SLICE_VALUES, quartiles: DataFrame | None = None
) -> DataFrame:
    """Revenue bookings far above the interquartile range of their category. ``quartiles`` (car_category, q_0, q_1), for
    instance from summaries of earlier loads, take the place of exact ones."""
    base = amounts_by_category(bookings).select("booking_id", "car_category", "total_amount")
    found = iqr_upper_outliers(base, "car_category", "total_amount", factor, "limite_superior", slice_values, quartiles)
    return found.select("booking_id", "car_category", "total_amount", "limite_superior")


def refunds_over_total(stg_cancellations: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """Staged cancellation and booking rows where the refund exceeds the total.

    Staging holds copies on both sides. Equal rows are counted before the join and ``copies`` says how often each
    pair occurs, so copies are never multiplied out: the sum of ``copies`` is the number of violations.
    """
    refunds = stg_cancellations.filter(F.col("refund_amount").isNotNull()).groupBy(
        "cancellation_id", "booking_id", "refund_amount"
    ).agg(F.count("*").alias("_c"))
    totals = stg_bookings.filter(F.col("total_amount").isNotNull()).groupBy("booking_id", "total_amount").agg(
        F.count("*").alias("_b")
    )
    pairs = refunds.join(totals, "booking_id").filter(F.col("refund_amount") > F.col("total_amount"))
    return pairs.select(
        "cancellation_id", "booking_id", "refund_amount", "total_amount", (F.col("_c") * F.col("_b")).alias("copies")
    )


def refunds_over_total_counted(stg_cancellations: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """Per booking how many pairs of staged rows violate the rule, without listing a pair: (booking_id, pairs)."""
    return pairs_above(stg_cancellations, stg_bookings, "booking_id", "refund_amount", "total_amount")


def refund_over_total_rows(stg_cancellations: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """The same violations as one row per pair of staged rows, copies included."""
    pairs = refunds_over_total(stg_cancellations, stg_bookings)
    # Many copies become chunks first, so that no row holds an array of all of them.
    chunk = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(1024).cast("long")))
    each = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + 1023, F.col("copies") - 1)))
    return pairs.withColumn("_from", chunk).withColumn("_copy", each).drop("_from", "_copy", "copies")


def same_user_day(bookings: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """Users with more than one booking on a day. By default bookings of any status count."""
    counted = bookings if statuses is None else bookings.filter(F.col("status").isin(*statuses))
    return (
        counted.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("booked_at").cast("date").alias("booked_date"))
        .agg(F.count("*").alias("qtd_reservas_no_dia"))
        .filter(F.col("qtd_reservas_no_dia") > 1)
    )
