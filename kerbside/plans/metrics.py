"""Business metrics over the marts. Results are whole; sorting and caps for readers are in the sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.constants import (
    CURRENCIES,
    FUNNEL_STAGES,
    REVENUE_STATUSES,
    SIGMAS,
    TOP_PARTNERS,
    TRAILING_DAYS,
    UNKNOWN_LABEL,
)
from kerbside.functions.numeric import money, ratio_pct, round2, sums_by_value
from kerbside.functions.text import blank_as
from kerbside.functions.time import month_label
from kerbside.operators.distinct import distinct_counts
from kerbside.operators.joins import not_in, with_presence
from kerbside.operators.periods import ordered, trailing_period
from kerbside.operators.sigma import with_sigma_limits


def revenue_bookings(bookings: DataFrame) -> DataFrame:
    """Bookings whose status earns revenue."""
    return bookings.filter(F.col("status").isin(*REVENUE_STATUSES))


def standing_revenue(bookings: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Revenue bookings without a registered cancellation."""
    return not_in(revenue_bookings(bookings), cancellations, "booking_id")


def _sessions_with_flags(
    sessions: DataFrame, searches: DataFrame, bookings: DataFrame, cancellations: DataFrame, statuses: Sequence[str] | None
) -> DataFrame:
    counted = bookings if statuses is None else bookings.filter(F.col("status").isin(*statuses))
    standing = not_in(counted, cancellations, "booking_id")
    return with_presence(with_presence(sessions, searches, "session_id", "searched"), standing, "session_id", "booked")


def funnel_by_segment(
    sessions: DataFrame,
    searches: DataFrame,
    bookings: DataFrame,
    cancellations: DataFrame,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """Sessions, sessions with a search, sessions with a standing booking, by country and device.

    Sessions are unique, so the distinct counts are plain flag counts. By default a booking of any status counts;
    ``statuses`` narrows that.
    """
    people = sessions.select(
        "session_id", blank_as("country", UNKNOWN_LABEL).alias("pais"), blank_as("device", UNKNOWN_LABEL).alias("dispositivo")
    )
    flagged = _sessions_with_flags(people, searches, bookings, cancellations, statuses)
    counts = flagged.groupBy("pais", "dispositivo").agg(
        F.count("session_id").alias("total_sessoes"),
        F.count_if("searched").alias("sessoes_com_busca"),
        F.count_if("booked").alias("sessoes_com_reserva"),
    )
    return _funnel_rates(counts)


def _funnel_rates(counts: DataFrame) -> DataFrame:
    rates = counts.withColumns(
        {
            "taxa_sessao_para_busca_pct": round2(ratio_pct("sessoes_com_busca", "total_sessoes")),
            "taxa_busca_para_reserva_pct": round2(ratio_pct("sessoes_com_reserva", "sessoes_com_busca")),
            "taxa_conversao_geral_pct": round2(ratio_pct("sessoes_com_reserva", "total_sessoes")),
        }
    )
    return ordered(rates, F.desc_nulls_last("total_sessoes"), F.asc("pais"), F.asc("dispositivo"))


def funnel_activity(sessions: DataFrame, searches: DataFrame, bookings: DataFrame, cancellations: DataFrame) -> DataFrame:
    """(pais, dispositivo, etapa, dia, session_id): on which days each session started, searched, or made a standing booking.

    Days of a session are made distinct before they meet the unique sessions, so a busy session is a row per day.
    """
    people = sessions.select(
        F.col("session_id").alias("_session"), blank_as("country", UNKNOWN_LABEL).alias("pais"), blank_as("device", UNKNOWN_LABEL).alias("dispositivo")
    )
    days = None
    standing = not_in(bookings, cancellations, "booking_id")
    for stage, (rows, ts) in zip(FUNNEL_STAGES, ((sessions, "started_at"), (searches, "searched_at"), (standing, "booked_at")), strict=True):
        own = rows.select("session_id", F.lit(stage).alias("etapa"), F.col(ts).cast("date").alias("dia"))
        days = own if days is None else days.unionByName(own)
    return days.distinct().join(people, F.col("session_id") == F.col("_session")).drop("_session")


FUNNEL_GROUPS = ("pais", "dispositivo", "etapa", "dia")


def funnel_from_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """``funnel_by_segment`` from bitmaps of sessions by ``FUNNEL_GROUPS``, of any days and loads."""
    counts = distinct_counts(bitmaps, ("pais", "dispositivo", "etapa"), "sessoes")
    names = ("total_sessoes", "sessoes_com_busca", "sessoes_com_reserva")
    sums = [F.coalesce(F.sum(F.when(F.col("etapa") == stage, F.col("sessoes"))), F.lit(0)).alias(name) for stage, name in zip(FUNNEL_STAGES, names, strict=True)]
    return _funnel_rates(counts.groupBy("pais", "dispositivo").agg(*sums))


def funnel_stages(
    sessions: DataFrame,
    searches: DataFrame,
    bookings: DataFrame,
    cancellations: DataFrame,
    statuses: Sequence[str] | None = None,
) -> DataFrame:
    """The same funnel as three rows, from a single aggregation that is unpivoted afterwards."""
    flagged = _sessions_with_flags(sessions.select("session_id"), searches, bookings, cancellations, statuses)
    totals = flagged.agg(
        F.count("session_id").alias("s1"), F.count_if("searched").alias("s2"), F.count_if("booked").alias("s3")
    )
    stages = F.array(
        *[
            F.struct(F.lit(label).alias("etapa"), F.lit(i).cast("long").alias("ordem"), F.col(f"s{i}").alias("valor"))
            for i, label in enumerate(FUNNEL_STAGES, start=1)
        ]
    )
    return totals.select(F.inline(stages)).orderBy("ordem")


def top_partners(
    bookings: DataFrame, cancellations: DataFrame, partners: DataFrame, days: int = TRAILING_DAYS, top: int = TOP_PARTNERS
) -> DataFrame:
    """Partners with most standing revenue bookings in the trailing period, with revenue per currency.

    The period ends at the latest booking of any status. Revenue is aggregated per partner before the name is
    joined, so a dominant partner is one row by then.
    """
    recent = standing_revenue(trailing_period(bookings, "booked_at", days), cancellations)
    per_partner = recent.groupBy("partner_id").agg(
        F.count("*").alias("quantidade_reservas"), *sums_by_value("total_amount", "currency", CURRENCIES, "total_")
    )
    named = per_partner.join(partners.select("partner_id", "partner_name"), "partner_id")
    best = ordered(
        named,
        F.desc_nulls_last("quantidade_reservas"),
        F.desc_nulls_last("total_brl"),
        F.asc("partner_id"),
        limit=top,
    )
    return best.withColumnRenamed("partner_name", "parceiro").drop("partner_id")


def ltv_cohort(
    bookings: DataFrame, cancellations: DataFrame, users: DataFrame, cohort: Column | None = None
) -> DataFrame:
    """Mean revenue per user and currency by cohort of first sight (month by default).

    Everybody of a cohort counts, buyers or not; users never seen in a session have no cohort.
    """
    cohort = month_label("first_seen_at") if cohort is None else cohort
    spent = (
        standing_revenue(bookings, cancellations)
        .filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(*sums_by_value("total_amount", "currency", CURRENCIES, "ltv_", rounded=False))
    )
    members = users.filter(F.col("first_seen_at").isNotNull()).select("user_id", cohort.alias("cohort_mes_ano"))
    amounts = [f"ltv_{c.lower()}" for c in CURRENCIES]
    per_cohort = members.join(spent, "user_id", "left").groupBy("cohort_mes_ano").agg(
        F.count("*").alias("quantidade_usuarios"),
        *[F.sum(F.coalesce(F.col(a), F.lit(0).cast("decimal(28,2)"))).alias(a) for a in amounts],
    )
    means = [
        round2(F.col(a).cast("double") / F.col("quantidade_usuarios")).alias(a.replace("ltv_", "ltv_medio_")) for a in amounts
    ]
    return per_cohort.select("cohort_mes_ano", "quantidade_usuarios", *means).orderBy("cohort_mes_ano")


def monthly_evolution(bookings: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Count and revenue per currency of standing revenue bookings by month."""
    return (
        standing_revenue(bookings, cancellations)
        .groupBy(month_label("booked_at").alias("mes_ano"))
        .agg(F.count("*").alias("quantidade_reservas"), *sums_by_value("total_amount", "currency", CURRENCIES, "receita_"))
        .orderBy(F.asc_nulls_last("mes_ano"))
    )


def cancellation_rates(bookings: DataFrame, cancellations: DataFrame, same_population: bool = False) -> DataFrame:
    """Cancellations over revenue bookings per partner, in per cent (unrounded).

    By default cancellations of bookings of any status count, so a rate may exceed 100; ``same_population`` counts
    only those of revenue bookings. Cancellations are counted per booking before the join: a booking with very
    many of them is one row, and one pass over the bookings serves both counts.
    """
    per_booking = cancellations.groupBy("booking_id").agg(F.count("*").alias("_cancellations"))
    earns = F.coalesce(F.col("status").isin(*REVENUE_STATUSES), F.lit(False))
    counted = F.when(earns, F.col("_cancellations")) if same_population else F.col("_cancellations")
    per_partner = (
        bookings.select("booking_id", "partner_id", "status")
        .join(per_booking, "booking_id", "left")
        .groupBy("partner_id")
        .agg(
            F.count_if(earns).alias("quantidade_reservas"),
            F.coalesce(F.sum(counted), F.lit(0)).alias("quantidade_cancelamentos"),
        )
        .filter(F.col("quantidade_reservas") > 0)
    )
    return per_partner.withColumn("taxa", ratio_pct("quantidade_cancelamentos", "quantidade_reservas"))


def cancellation_outliers(
    bookings: DataFrame,
    cancellations: DataFrame,
    partners: DataFrame,
    sigmas: float = SIGMAS,
    same_population: bool = False,
    include_lower: bool = False,
) -> DataFrame:
    """Cancellation rate per partner against mean plus ``sigmas`` population deviations of all partners."""
    judged = with_sigma_limits(cancellation_rates(bookings, cancellations, same_population), "taxa", sigmas)
    named = judged.join(partners.select("partner_id", "partner_name"), "partner_id")
    columns = [
        F.col("partner_name").alias("parceiro"),
        F.col("quantidade_reservas"),
        F.col("quantidade_cancelamentos"),
        round2(F.col("taxa")).alias("taxa_cancelamento_pct"),
        round2(F.col("mean")).alias("media_geral_pct"),
        round2(F.col("sigma")).alias("desvio_padrao_pct"),
        round2(F.col("upper")).alias("limite_superior_2sigma"),
        F.col("above").alias("eh_outlier"),
    ]
    if include_lower:
        columns.append(round2(F.col("lower")).alias("limite_inferior_2sigma"))
    return ordered(named, F.desc_nulls_last("taxa"), F.asc("partner_id")).select(*columns)


def average_ticket(bookings: DataFrame) -> DataFrame:
    """Mean amount of revenue bookings per currency."""
    total = F.sum(money("total_amount")).cast("double")
    return revenue_bookings(bookings).groupBy("currency").agg(
        F.count("total_amount").alias("quantidade_reservas"), round2(total / F.count("total_amount")).alias("ticket_medio")
    )


def scorecards(
    sessions: DataFrame, searches: DataFrame, bookings: DataFrame, cancellations: DataFrame
) -> DataFrame:
    """Four headline numbers, one row each: bookings, revenue in BRL, overall conversion, mean cancellation rate."""
    standing = standing_revenue(bookings, cancellations).agg(
        F.count("*").cast("double").alias("reservas"),
        F.coalesce(F.sum(F.when(F.col("currency") == "BRL", money("total_amount"))), F.lit(0)).cast("double").alias("brl"),
    )
    stages = funnel_stages(sessions, searches, bookings, cancellations)
    reached = [F.max(F.when(F.col("ordem") == i, F.col("valor"))) for i in (1, 3)]
    conversion = stages.agg(round2(ratio_pct(reached[1], reached[0])).alias("value"))
    rate = cancellation_rates(bookings, cancellations).agg(round2(F.avg("taxa")).alias("value"))
    counts = standing.select(
        F.inline(
            F.array(
                F.struct(F.lit("reservas_validas").alias("indicador"), F.col("reservas").alias("valor")),
                F.struct(F.lit("receita_brl").alias("indicador"), F.col("brl").alias("valor")),
            )
        )
    )
    return counts.unionByName(
        conversion.select(F.lit("conversao_geral_pct").alias("indicador"), F.col("value").alias("valor"))
    ).unionByName(rate.select(F.lit("taxa_media_cancelamento_pct").alias("indicador"), F.col("value").alias("valor")))


def revenue_change(report: DataFrame) -> DataFrame:
    """Month-on-month change of revenue per partner and currency; null where the month before has no row.

    The input has one row per month, so a window group is as long as the calendar and no longer.
    """
    months = Window.partitionBy("partner_id", "currency").orderBy("reference_month")
    follows = F.add_months(F.lag("reference_month").over(months), 1) == F.col("reference_month")
    previous = F.when(follows, F.lag("revenue_amount").over(months))
    rows = report.select("partner_id", "currency", "reference_month", "revenue_amount", previous.alias("previous_amount"))
    change = F.col("revenue_amount").cast("double") - F.col("previous_amount").cast("double")
    return rows.withColumn("change_pct", round2(ratio_pct(change, "previous_amount")))
