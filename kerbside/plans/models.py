"""Staging, intermediate and mart models as plain functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.constants import ACTIVE_STATUS, REVENUE_STATUSES
from kerbside.functions.text import cleaned
from kerbside.operators.dedup import latest_per_key
from kerbside.operators.joins import existing_in_dimension, existing_only, skew_safe_join
from kerbside.schemas import RAW_COLUMNS, column_metadata
from kerbside.session import materialise


def stage(raw: DataFrame, table: str, strict: bool = True) -> DataFrame:
    """Typed and cleaned columns of a raw table; no row is added or removed."""
    return raw.select(
        *[cleaned(name, rule, strict).alias(name, metadata=column_metadata(name)) for name, _, rule in RAW_COLUMNS[table]]
    )


def int_partners(stg_partners: DataFrame) -> DataFrame:
    """Latest version of every partner, whatever its status."""
    return latest_per_key(stg_partners, "partner_id", F.coalesce("updated_at", "created_at"))


def int_sessions(stg_sessions: DataFrame) -> DataFrame:
    """Latest version of every session not marked as a bot; a missing mark excludes it too."""
    people = stg_sessions.filter(~F.col("is_bot")).drop("is_bot")
    return latest_per_key(people, "session_id", "started_at")


def int_searches(stg_searches: DataFrame, valid_sessions: DataFrame) -> DataFrame:
    """Latest version of every search made in a valid session."""
    known = existing_only(stg_searches, valid_sessions, "session_id")
    return latest_per_key(known, "search_id", "searched_at").select(*stg_searches.columns)


def active_bookings(stg_bookings: DataFrame, stg_partners: DataFrame) -> DataFrame:
    """Latest version of every booking among those of active partners, before the amount rule."""
    active = stg_partners.filter(F.col("status") == ACTIVE_STATUS)
    known = existing_in_dimension(stg_bookings, active, "partner_id")
    return latest_per_key(known, "booking_id", "booked_at").select(*stg_bookings.columns)


def valid_amounts(bookings: DataFrame) -> DataFrame:
    """A revenue booking needs a positive amount. A missing status with a missing or bad amount does not pass."""
    return bookings.filter((F.col("total_amount") > 0) | ~F.col("status").isin(*REVENUE_STATUSES))


def int_bookings(stg_bookings: DataFrame, stg_partners: DataFrame) -> DataFrame:
    """Valid bookings. The amount rule judges the latest version only; an older valid one does not come back."""
    return valid_amounts(active_bookings(stg_bookings, stg_partners))


def latest_cancellations(stg_cancellations: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """Latest version of every cancellation of an existing booking, with the booking's total."""
    totals = latest_per_key(stg_bookings.select("booking_id", "booked_at", "total_amount"), "booking_id", "booked_at")
    totals = totals.select("booking_id", F.col("total_amount").alias("booking_total_amount"))
    known = skew_safe_join(stg_cancellations, totals, "booking_id", "inner")
    return latest_per_key(known, "cancellation_id", "cancelled_at", ties=stg_cancellations.columns[1:])


def int_cancellations(stg_cancellations: DataFrame, stg_bookings: DataFrame) -> DataFrame:
    """Cancellations whose refund does not exceed the booking's total; a refund against no total is dropped."""
    fits = F.col("refund_amount").isNull() | (F.col("refund_amount") <= F.col("booking_total_amount"))
    return latest_cancellations(stg_cancellations, stg_bookings).filter(fits).select(*stg_cancellations.columns)


def dim_partners(partners: DataFrame) -> DataFrame:
    """One row per partner."""
    return partners


def dim_users(sessions: DataFrame, bookings: DataFrame) -> DataFrame:
    """Every identified user of a session or booking, with the time of the first session (null without one).

    One aggregation over both sources gives the distinct users and their first session; no join is needed.
    """
    seen = sessions.select("user_id", F.col("started_at").alias("first_seen_at"))
    booked = bookings.select("user_id", F.lit(None).cast("timestamp_ntz").alias("first_seen_at"))
    users = seen.unionByName(booked).filter(F.col("user_id").isNotNull())
    return users.groupBy("user_id").agg(F.min("first_seen_at").alias("first_seen_at"))


STAGING = tuple(f"stg_{t}" for t in RAW_COLUMNS)
INTERMEDIATE = ("int_partners", "int_sessions", "int_searches", "int_bookings", "int_cancellations")
MARTS = ("dim_partners", "dim_users", "fct_bookings", "fct_sessions")
# Models whose making shuffles, and staging, which several models and checks read. int_bookings is a plain filter of
# active_bookings.
_WRITTEN = (*STAGING, "int_partners", "int_sessions", "int_searches", "active_bookings", "int_cancellations", "dim_users")


class Models:
    """The model graph over a set of raw tables. Each model is built once, when first asked for.

    With ``written`` every model that takes a shuffle to make is written to the shared folder when first asked for,
    so that several readers share one run of it and each reads only the columns it needs. A job that reads a model
    once leaves it lazy, and Catalyst plans through it.
    """

    def __init__(self, raw: dict[str, DataFrame], strict: bool = True, written: bool = False):
        self._raw, self._strict, self._written = raw, strict, written
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            df = self._build(name)
            keep = self._written and name in _WRITTEN
            self._built[name] = materialise(df, name) if keep else df
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in STAGING:
            table = name.removeprefix("stg_")
            return stage(self._raw[table], table, self._strict)
        builders = {
            "int_partners": lambda: int_partners(self["stg_partners"]),
            "int_sessions": lambda: int_sessions(self["stg_sessions"]),
            "int_searches": lambda: int_searches(self["stg_searches"], self["int_sessions"]),
            "active_bookings": lambda: active_bookings(self["stg_bookings"], self["stg_partners"]),
            "int_bookings": lambda: valid_amounts(self["active_bookings"]),
            "int_cancellations": lambda: int_cancellations(self["stg_cancellations"], self["stg_bookings"]),
            "dim_partners": lambda: dim_partners(self["int_partners"]),
            "dim_users": lambda: dim_users(self["int_sessions"], self["int_bookings"]),
            # On a first run a fact holds exactly its intermediate model; FactTable does later runs.
            "fct_bookings": lambda: self["int_bookings"],
            "fct_sessions": lambda: self["int_sessions"],
        }
        return builders[name]()

    def write(self, folder: str, names: tuple[str, ...] = (*INTERMEDIATE, *MARTS)) -> None:
        """Write models as parquet tables, each by its own name."""
        for name in names:
            self[name].write.mode("overwrite").parquet(f"{folder}/{name}")

    def register_views(self, names: tuple[str, ...] = (*STAGING, *INTERMEDIATE, *MARTS)) -> None:
        """Expose models as temporary views for SQL."""
        for name in names:
            self[name].createOrReplaceTempView(name)
