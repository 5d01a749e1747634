"""The contract revenue report, its alerts, and the revenue views derived from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.constants import COMPLETENESS_LIMIT_PCT, CONTRACT_GRAIN, CURRENCIES, REVENUE_STATUSES, SUSPICIOUS_LIMIT_PCT
from kerbside.functions.numeric import money, ratio_pct, round2
from kerbside.functions.time import month_start
from kerbside.operators.asof import asof_lookup
from kerbside.operators.joins import with_presence
from kerbside.plans.metrics import revenue_bookings, standing_revenue
from kerbside.schemas import REVENUE_CONTRACT
from kerbside.session import materialise
from kerbside.sources.facts import FactTable


def monthly_parts(active: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Partner, month and currency with revenue, booking count, invalid count, flagged count and newest booking.

    ``active`` holds the latest bookings of active partners before the amount rule, since the invalid ones must
    still be there to be counted. Flagged bookings are counted per (user, day, partner, currency) before the
    (user, day) totals are joined, so a user with very many bookings on a day is a few rows by then. The result,
    one row per partner, month and currency, is written once; report, alerts and the partial-month mark read it.
    """
    zero = F.lit(0).cast("long")
    group = ["partner_id", "reference_month", "currency"]
    dated = active.withColumn("reference_month", month_start("booked_at"))
    valid = F.coalesce((F.col("total_amount") > 0) & F.col("status").isin(*REVENUE_STATUSES), F.lit(False))
    invalid = F.col("status").isin(*REVENUE_STATUSES) & ~valid
    counted = valid & ~F.col("cancelled")
    counts = (
        with_presence(dated, cancellations, "booking_id", "cancelled")
        .groupBy(*group)
        .agg(
            F.sum(F.when(counted, money("total_amount"))).alias("revenue"),
            F.count_if(counted).alias("bookings"),
            F.count_if(invalid).alias("invalid"),
            zero.alias("flagged"),
            F.max("booked_at").alias("newest"),
        )
    )
    user_days = (
        dated.filter(valid & F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("booked_at").cast("date").alias("booked_date"), *group)
        .agg(F.count("*").alias("n"))
    )
    crowded = user_days.groupBy("user_id", "booked_date").agg(F.sum("n").alias("total")).filter(F.col("total") > 1)
    flagged = (
        user_days.join(crowded, ["user_id", "booked_date"], "left_semi")
        .groupBy(*group)
        .agg(
            F.lit(None).cast("decimal(28,2)").alias("revenue"),
            zero.alias("bookings"),
            zero.alias("invalid"),
            F.sum("n").alias("flagged"),
            F.lit(None).cast("timestamp_ntz").alias("newest"),
        )
    )
    parts = counts.unionByName(flagged).groupBy(*group).agg(
        F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
        F.sum("bookings").alias("bookings"),
        F.sum("invalid").alias("invalid"),
        F.sum("flagged").alias("flagged"),
        F.max("newest").alias("newest"),
    )
    return materialise(parts, "monthly-parts")


def changed_months(changes: DataFrame, ts: str = "booked_at") -> DataFrame:
    """The months (reference_month) that changed bookings lie in now or lay in before, one row each."""
    months = F.explode(F.array(month_start(ts), month_start("was"))).alias("reference_month")
    return changes.select(months).filter("reference_month is not null").distinct()


def months_of(bookings: DataFrame, booking_ids: DataFrame) -> DataFrame:
    """The months of the bookings with the given ids, as when cancellations of theirs came or went."""
    hit = bookings.join(booking_ids.select("booking_id").distinct(), "booking_id", "left_semi")
    return hit.select(month_start("booked_at").alias("reference_month")).filter("reference_month is not null").distinct()


def refreshed_parts(parts: DataFrame, bookings: FactTable, cancellations: DataFrame, months: DataFrame) -> DataFrame:
    """Monthly parts after a change: those of ``months`` are made anew, from these months' folders alone; the others stay.

    All that a part holds comes from bookings of its own month, so an untouched month cannot change. ``bookings`` is a fact
    table of active bookings before the amount rule."""
    months = materialise(months, "touched-months")
    labels = {r["reference_month"].strftime("%Y-%m") for r in months.collect()}  # one row per month
    if not labels:
        return parts
    again = monthly_parts(bookings.read(months=labels), cancellations)
    return materialise(parts.join(months, "reference_month", "left_anti").unionByName(again), "monthly-parts")


def revenue_by_partner(parts: DataFrame, partners: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The contract report from the monthly parts: one row per partner, month and currency with revenue.

    The invalid and flagged counts belong to the partner and month and repeat on each currency row; do not sum
    them (the window that spreads them holds one row per currency). Revenue is never summed across currencies. The
    month of ``as_of`` (the newest booking by default) and later ones are partial.
    """
    as_of = parts.agg(F.max("newest")).scalar() if as_of is None else as_of
    month = Window.partitionBy("partner_id", "reference_month")
    spread = parts.select(
        "*",
        F.sum("invalid").over(month).alias("excluded_invalid_amount_count"),
        F.sum("flagged").over(month).alias("flagged_suspicious_booking_count"),
    )
    named = spread.filter(F.col("bookings") > 0).join(partners.select("partner_id", "partner_name"), "partner_id")
    return named.select(
        "partner_id",
        "partner_name",
        "reference_month",
        "currency",
        F.col("revenue").alias("revenue_amount"),
        F.col("bookings").alias("booking_count"),
        "excluded_invalid_amount_count",
        "flagged_suspicious_booking_count",
        (F.col("reference_month") >= month_start(as_of)).alias("is_partial_month"),
    )


class ContractBroken(ValueError):
    """A report that is not what the contract promises."""


def check_contract(report: DataFrame) -> DataFrame:
    """The report itself, after its columns and types are found to be those of the contract."""
    expected = [(f.name, f.dataType) for f in REVENUE_CONTRACT]
    actual = [(f.name, f.dataType) for f in report.schema]
    if expected != actual:
        raise ContractBroken(f"contract broken: expected {expected}, found {actual}")
    return report


def contract_violations(report: DataFrame) -> DataFrame:
    """What breaks the contract in the rows of a report: (rule, field, failing_rows), rules that hold included.

    No field may be null, and partner, month and currency make a row unique. One pass for the nulls, one aggregate
    for the grain.
    """
    names = [f.name for f in REVENUE_CONTRACT if not f.nullable]
    nulls = report.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    listed = [F.struct(F.lit("not_null").alias("rule"), F.lit(c).alias("field"), F.col(c).alias("failing_rows")) for c in names]
    grain = report.groupBy(*CONTRACT_GRAIN).agg(F.count("*").alias("n"))
    repeated = grain.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("failing_rows"))
    return nulls.select(F.inline(F.array(*listed))).unionByName(
        repeated.select(F.lit("unique").alias("rule"), F.lit(", ".join(CONTRACT_GRAIN)).alias("field"), "failing_rows")
    )


def enforced(report: DataFrame) -> DataFrame:
    """The report, written once, unless its shape, its rows or its currencies break the contract, which raises."""
    report = materialise(check_contract(report), "contract-report")
    broken = contract_violations(report).filter("failing_rows > 0").first()  # one row per rule
    if broken is not None:
        raise ContractBroken(f"contract broken: {broken['rule']} of {broken['field']} fails in {broken['failing_rows']} rows")
    return publishable(report)


class ForeignCurrency(ValueError):
    """A currency outside the contract blocks publication."""


def foreign_currencies(report: DataFrame, allowed: Sequence[str] = CURRENCIES) -> DataFrame:
    """Currencies outside the contract and how many rows carry them; a missing currency is foreign too."""
    allowed_here = F.coalesce(F.col("currency").isin(*allowed), F.lit(False))
    return report.filter(~allowed_here).groupBy("currency").agg(F.count("*").alias("failing_rows"))


def publishable(report: DataFrame, allowed: Sequence[str] = CURRENCIES) -> DataFrame:
    """The report, unless it carries a foreign currency, which raises."""
    worst = foreign_currencies(report, allowed).orderBy(F.desc("failing_rows"), "currency").first()
    if worst is not None:
        raise ForeignCurrency(f"currency {worst['currency']!r} in {worst['failing_rows']} rows")
    return report


def completeness_index(parts: DataFrame, limit_pct: float = COMPLETENESS_LIMIT_PCT) -> DataFrame:
    """Share of revenue-status bookings left out for a missing or bad amount, per partner and month, with an alert."""
    per_month = parts.groupBy("partner_id", "reference_month").agg(
        F.sum("bookings").alias("booking_count"), F.sum("invalid").alias("excluded_invalid_amount_count")
    )
    whole = F.col("booking_count") + F.col("excluded_invalid_amount_count")
    rate = ratio_pct("excluded_invalid_amount_count", whole)
    return per_month.filter(whole > 0).select(
        "*", round2(rate).alias("invalid_pct"), (rate > F.lit(limit_pct)).alias("alert")
    )


def invalid_amount_rate(parts: DataFrame, limit_pct: float = COMPLETENESS_LIMIT_PCT) -> DataFrame:
    """The same share over the whole run, against its limit: one row."""
    totals = parts.agg(
        F.coalesce(F.sum("bookings"), F.lit(0)).alias("booking_count"),
        F.coalesce(F.sum("invalid"), F.lit(0)).alias("excluded_invalid_amount_count"),
    )
    rate = ratio_pct("excluded_invalid_amount_count", F.col("booking_count") + F.col("excluded_invalid_amount_count"))
    return totals.select("*", round2(rate).alias("invalid_pct"), F.coalesce(rate > F.lit(limit_pct), F.lit(False)).alias("alert"))


def suspicious_bookings(bookings: DataFrame) -> DataFrame:
    """The revenue bookings of users with more than one of them on a day, with partner and month, for a separate review.

    Users' days are counted first; the few crowded ones are joined back.
    """
    valid = revenue_bookings(bookings).filter((F.col("total_amount") > 0) & F.col("user_id").isNotNull())
    day = F.col("booked_at").cast("date")
    crowded = valid.groupBy("user_id", day.alias("booked_date")).agg(F.count("*").alias("bookings_on_day")).filter("bookings_on_day > 1")
    return valid.withColumn("booked_date", day).join(crowded, ["user_id", "booked_date"]).select(
        "partner_id", month_start("booked_at").alias("reference_month"), "booking_id", "user_id", "booked_date", "bookings_on_day", "currency", "total_amount"
    )


def suspicious_rate(
    bookings: DataFrame,
    limit_pct: float = SUSPICIOUS_LIMIT_PCT,
    statuses: Sequence[str] | None = REVENUE_STATUSES,
) -> DataFrame:
    """Bookings in same-user-same-day groups over users with a booking, with an alert: one row.

    ``statuses`` says which bookings form the groups; every user with a booking of any status is in the base.
    """
    counted = F.lit(True) if statuses is None else F.col("status").isin(*statuses)
    per_day = (
        bookings.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.col("booked_at").cast("date").alias("day"))
        .agg(F.count_if(counted).alias("n"))
    )
    per_user = per_day.groupBy("user_id").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("flagged"))
    totals = per_user.agg(
        F.coalesce(F.sum("flagged"), F.lit(0)).cast("long").alias("flagged_bookings"), F.count("*").alias("users_with_booking")
    )
    rate = ratio_pct("flagged_bookings", "users_with_booking")
    return totals.select(
        "*", round2(rate).alias("suspicious_pct"), F.coalesce(rate > F.lit(limit_pct), F.lit(False)).alias("alert")
    )


def net_revenue(bookings: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Revenue bookings before and after refunds, by partner, month and currency.

    Cancelled bookings stay in (the contract report leaves them out), since their refund is what makes the
    difference. Refunds are summed per booking first, so several cancellations of a booking do not repeat its
    amount.
    """
    refunds = (
        cancellations.filter(F.col("booking_id").isNotNull())
        .groupBy("booking_id")
        .agg(F.sum(money("refund_amount")).alias("refund"))
    )
    per_month = (
        revenue_bookings(bookings)
        .join(refunds, "booking_id", "left")
        .groupBy("partner_id", month_start("booked_at").alias("reference_month"), "currency")
        .agg(
            F.count("*").alias("booking_count"),
            F.sum(money("total_amount")).alias("gross_amount"),
            F.coalesce(F.sum("refund"), F.lit(0)).cast("decimal(28,2)").alias("refund_amount"),
        )
    )
    net = (F.col("gross_amount") - F.col("refund_amount")).cast("decimal(28,2)")
    return per_month.withColumn("revenue_amount_net_of_refund", net)


def revenue_in_brl(
    bookings: DataFrame, cancellations: DataFrame, rates: DataFrame, rate_date: str = "booking"
) -> DataFrame:
    """Standing revenue by month, converted with the latest rate at or before the booking day or the month's end.

    Amounts are summed per (currency, day) before the rates are looked up: currencies are few and heavy, days
    are many and light. These sums are written once, since the lookup and the join both read them.
    ``unconverted_bookings`` counts those without any earlier rate.
    """
    if rate_date not in ("booking", "month_close"):
        raise ValueError(f"unknown rate date {rate_date}")
    day = F.col("booked_at").cast("date")
    rate_day = day if rate_date == "booking" else F.last_day(day)
    daily = (
        standing_revenue(bookings, cancellations)
        .groupBy("currency", rate_day.alias("rate_day"), month_start("booked_at").alias("reference_month"))
        .agg(F.sum(money("total_amount")).alias("amount"), F.count("*").alias("n"))
    )
    daily = materialise(daily, "daily-amounts")
    found = asof_lookup(daily, rates, "currency", "rate_day", "rate_date", "rate")
    priced = daily.join(found, ["currency", "rate_day"], "left")
    converted = F.sum(F.col("amount").cast("decimal(20,2)") * F.col("rate").cast("decimal(17,10)"))
    return priced.groupBy("reference_month").agg(
        F.sum("n").alias("booking_count"),
        round2(F.coalesce(converted, F.lit(0)).cast("double")).alias("receita_total_brl"),
        F.coalesce(F.sum(F.when(F.col("rate").isNull(), F.col("n"))), F.lit(0)).alias("unconverted_bookings"),
    )
