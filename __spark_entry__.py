"""Registered queries: every operator and job over whole tables, with the SQL each must agree with."""

from __future__ import annotations

import os
import sys
from collections import ChainMap
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kerbside.constants import CURRENCIES, IQR_FACTOR
from kerbside.functions.numeric import sums_by_value
from kerbside.functions.sql import register_functions
from kerbside.functions.time import bucket_start, day_label, month_label
from kerbside.operators.asof import asof_join
from kerbside.operators.bursts import fixed_bursts, sliding_bursts
from kerbside.operators.dedup import latest_per_key
from kerbside.operators.distinct import distinct_counts, key_bitmaps, numbered
from kerbside.operators.inequality import pairs_above
from kerbside.operators.quantiles import exact_quantiles, iqr_upper_outliers
from kerbside.operators.sketches import SIZE, rank_distance, rank_error, sketched_quantiles, value_sketches
from kerbside.plans import anomalies, metrics, quality, report
from kerbside.plans.check_states import CheckStates
from kerbside.plans.exports import EXPORTS, export_results
from kerbside.plans.models import INTERMEDIATE, MARTS, STAGING, Models, int_bookings, int_sessions, stage, valid_amounts
from kerbside.schemas import RAW_COLUMNS, raw_schema
from kerbside.session import materialise, scratch_path
from kerbside.sources.facts import FactTable
from kerbside.sources.mapping import MAPPED_CATEGORIES, TABLES, daily_rates, raw_tables, search_events, table
from kerbside.sources.raw import read_csv, read_tables
from kerbside.sources.sinks import export_closed_months, export_csv, restricted
from kerbside.streaming.jobs import bursts_from_counts, stream_burst_counts, stream_into_fact
from kerbside.streaming.stateful import peaks, stream_newest, stream_searches_of_sessions, stream_sliding_peaks

try:  # the operators for training data are a subpackage of their own, which may be absent
    import corpus_pipeline
    from kerbside.llm.queries import ORACLES as LLM_ORACLES
    from kerbside.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as error:
    if error.name != "corpus_pipeline" and not error.name.startswith("kerbside.llm"):
        raise
    LLM_QUERIES, LLM_ORACLES = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        LLM_ORACLES = {**LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}
from oracle_queries import BOOKING_CUT, MOVED_TO, ORACLES, SESSION_CUT

Query = Callable[[SparkSession, str], DataFrame]

# The mapped sessions are short, so one search more than a single one already is a burst there.
MAPPED_BURST = 1
SUITE = quality.with_categories(quality.SUITE, MAPPED_CATEGORIES)
EXPECTED_NULLS = {
    "stg_partners": {"tier": 25.0, "updated_at": 33.0, "contact_email": 30.0},
    "stg_sessions": {"user_id": 12.5, "ended_at": 4.0, "utm_source": 30.0},
    "stg_bookings": {"user_id": 11.0, "car_category": 3.0, "total_amount": 1.0, "payment_method": 25.0},
    "stg_cancellations": {"refund_amount": 10.0},
}
CASE_COLUMNS = (
    ("sessions", "device"),
    ("sessions", "country"),
    ("partners", "status"),
    ("bookings", "currency"),
    ("bookings", "status"),
    ("bookings", "car_category"),
)


_WAREHOUSES: dict[tuple, Models] = {}


def _models_of(raw: dict[str, DataFrame], written: bool = False) -> Models:
    return Models(raw, written=written)


def _models(spark: SparkSession, sf_dir: str, written: bool = False) -> Models:
    return _models_of(raw_tables(spark, sf_dir), written)


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """The files of the tables that models are made of, with their sizes and times: other files, other models."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    rows = files.load([f"{sf_dir}/{name}.parquet" for name in TABLES]).select("path", "length", "modificationTime")
    return tuple(rows.agg(F.count("*"), F.sum("length"), F.sum(F.xxhash64("path", "modificationTime") % 1_000_003)).first())


def _warehouse(spark: SparkSession, sf_dir: str) -> Models:
    """The written models of these tables. As in production, a session makes each model once, by the first query
    that needs it, and the metrics, reports and checks read the written tables."""
    key = (spark.sparkContext.applicationId, sf_dir, _state(spark, sf_dir))
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = _models(spark, sf_dir, written=True)
    return _WAREHOUSES[key]


def _plain(df: DataFrame) -> DataFrame:
    """Integers as bigint and decimals as double, so that engines with other result types compare equal."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, (T.IntegerType, T.ShortType)):
            out.append(F.col(f.name).cast("long").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def _model_query(name: str) -> Query:
    return lambda spark, sf_dir: _models(spark, sf_dir)[name]


def _on_models(build: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_warehouse(spark, sf_dir))


def build_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Make and write every model anew, and count its rows."""
    m = _models(spark, sf_dir, written=True)
    counts = [m[name].agg(F.lit(name).alias("model"), F.count("*").alias("row_count")) for name in (*INTERMEDIATE, *MARTS)]
    return reduce(DataFrame.unionByName, counts)


def _six_digits(df: DataFrame, *columns: str) -> DataFrame:
    """Interpolated values agree between engines up to the last bit; compare them at six decimals."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


# -- incremental facts ----------------------------------------------------------------------------------------
def _fact(spark: SparkSession, key: str, ts: str) -> FactTable:
    return FactTable(spark, scratch_path(spark, "fact"), key, ts, grain="month")


def _number(column: str) -> Column:
    return F.substring(column, 4, 20).cast("long")


def _before(ts: str, cut: str) -> Column:
    return F.col(ts) < F.lit(cut).cast("timestamp_ntz")


def fct_bookings_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load of the early half, replaced by a full refresh."""
    m = _models(spark, sf_dir)
    fact = _fact(spark, "booking_id", "booked_at")
    fact.load(int_bookings(m["stg_bookings"].filter(_before("booked_at", BOOKING_CUT)), m["stg_partners"]))
    return fact.load(m["int_bookings"], full_refresh=True)


def _two_loads(fact: FactTable, first: DataFrame, second: DataFrame, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Load the staged rows of a first run, then those a second run finds above the mark."""
    fact.load(prepare(first))
    return fact.load(prepare(fact.pending(second)))


def _booking_loads(spark: SparkSession, sf_dir: str, first: Column, change: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    m = _models(spark, sf_dir)
    staged = m["stg_bookings"]
    fact = _fact(spark, "booking_id", "booked_at")
    return _two_loads(fact, staged.filter(first), change(staged), lambda rows: int_bookings(rows, m["stg_partners"]))


def fct_bookings_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _booking_loads(spark, sf_dir, _before("booked_at", BOOKING_CUT))


def fct_bookings_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that arrive after the mark has passed them are not loaded."""
    return _booking_loads(spark, sf_dir, _before("booked_at", BOOKING_CUT) & (_number("booking_id") % 10 != 3))


def fct_bookings_updated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose time moved above the mark replace their old version."""
    moves = _before("booked_at", BOOKING_CUT) & (_number("booking_id") % 20 == 7) & (F.col("total_amount") > 0)

    def moved(staged: DataFrame) -> DataFrame:
        return staged.withColumns(
            {
                "booked_at": F.when(moves, F.lit(MOVED_TO).cast("timestamp_ntz")).otherwise(F.col("booked_at")),
                "status": F.when(moves, F.lit("completed")).otherwise(F.col("status")),
            }
        )

    return _booking_loads(spark, sf_dir, _before("booked_at", BOOKING_CUT), moved)


def fct_sessions_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = _models(spark, sf_dir)["stg_sessions"]
    fact = _fact(spark, "session_id", "started_at")
    return _two_loads(fact, staged.filter(_before("started_at", SESSION_CUT)), staged, int_sessions)


# -- streams --------------------------------------------------------------------------------------------------
def stream_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    # The brackets make it a pattern, which may match one file or a folder of part files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    searches = stage(search_events(events), "searches")
    out = scratch_path(spark, "stream-bursts")
    stream_burst_counts(searches, f"{out}/checkpoint", f"{out}/counts").awaitTermination()
    return bursts_from_counts(spark.read.parquet(f"{out}/counts"), MAPPED_BURST)


def _booking_stream(spark: SparkSession, sf_dir: str, arrivals: list[Column], per_batch: int | None) -> DataFrame:
    """Raw bookings that land as files in the given order, as a stream into a fact table."""
    raw = raw_tables(spark, sf_dir)
    partners = materialise(stage(raw["partners"], "partners"), "stream-partners")
    landing = scratch_path(spark, "landing")
    fact = _fact(spark, "booking_id", "booked_at")
    for number, arrival in enumerate(arrivals):
        raw["bookings"].filter(arrival).write.parquet(f"{landing}/in/slice={number}")
    reader = spark.readStream.schema(raw["bookings"].schema)
    reader = reader if per_batch is None else reader.option("maxFilesPerTrigger", per_batch)
    staged = stage(reader.parquet(f"{landing}/in/slice=*"), "bookings")
    stream_into_fact(
        staged, fact, lambda batch: int_bookings(batch, partners), f"{landing}/checkpoint"
    ).awaitTermination()
    return fact.read()


def stream_fct_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later bookings arrive first, in several micro-batches; none is lost."""
    early = _before("booked_at", BOOKING_CUT)
    return _booking_stream(spark, sf_dir, [~early, early], 4)


_ALL_TIME = "36500 days"  # the tables are read as one backlog: nothing counts as late


def stream_burst_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact sliding bursts of a stream, beside the bot mark that the sessions carry."""
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    fact = FactTable(spark, scratch_path(spark, "fact"), "burst_key", "block_start", grain="month")
    checkpoint = scratch_path(spark, "stream-sliding")
    stream_sliding_peaks(stage(search_events(events), "searches"), fact, checkpoint, threshold=MAPPED_BURST, delay=_ALL_TIME).awaitTermination()
    return peaks(fact.read())


def stream_newest_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later bookings arrive first; after a restart the early ones come, and every third one a second time."""
    raw = raw_tables(spark, sf_dir)
    partners = materialise(stage(raw["partners"], "partners"), "stream-partners")
    landing, fact = scratch_path(spark, "landing"), _fact(spark, "booking_id", "booked_at")
    early = _before("booked_at", BOOKING_CUT)
    again = raw["bookings"].filter(_number("booking_id") % 3 == 0)
    for number, arrival in enumerate((raw["bookings"].filter(~early), raw["bookings"].filter(early).unionByName(again))):
        arrival.write.parquet(f"{landing}/in/slice={number}")
        reader = spark.readStream.schema(raw["bookings"].schema)
        staged = stage(reader.parquet(f"{landing}/in/slice=*"), "bookings")
        known = staged.join(partners.filter("status = 'active'").select("partner_id").distinct(), "partner_id", "left_semi").select(*staged.columns)
        stream_newest(known, fact, f"{landing}/checkpoint", delay=_ALL_TIME).awaitTermination()
    return valid_amounts(fact.read())


def stream_int_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Searches and sessions as two streams."""
    raw, landing = raw_tables(spark, sf_dir), scratch_path(spark, "landing")
    raw["sessions"].write.parquet(f"{landing}/sessions")
    sessions = stage(spark.readStream.schema(raw["sessions"].schema).parquet(f"{landing}/sessions"), "sessions")
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parque[t]")
    searches = stage(search_events(events), "searches")
    fact = FactTable(spark, scratch_path(spark, "fact"), "search_id", "searched_at", grain="month")
    newest = lambda rows: latest_per_key(rows, "search_id", "searched_at").select(*searches.columns)
    stream_searches_of_sessions(searches, sessions, fact, f"{landing}/checkpoint", newest, _ALL_TIME, _ALL_TIME).awaitTermination()
    return fact.read()


def fct_lookback_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with lookback that brings older versions of stored bookings, and bookings that are late.

    Every booking is loaded but those of one residue; then every booking arrives again, a day older.
    """
    m = _models(spark, sf_dir)
    fact = FactTable(spark, scratch_path(spark, "fact"), "booking_id", "booked_at", grain="month", lookback="36500 days")
    bookings = materialise(m["int_bookings"], "all-bookings")
    fact.load(bookings.filter(_number("booking_id") % 10 != 3))
    older = bookings.withColumn("booked_at", F.col("booked_at") - F.expr("interval 1 day")).withColumn("status", F.lit("late"))
    return fact.load(fact.pending(older))


def stream_fct_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of raw bookings; the stream is stopped and resumed from its checkpoint in between."""
    raw = raw_tables(spark, sf_dir)
    partners = stage(raw["partners"], "partners")
    landing = scratch_path(spark, "landing")
    fact = _fact(spark, "booking_id", "booked_at")
    early = _before("booked_at", BOOKING_CUT)
    for number, arrival in enumerate((raw["bookings"].filter(early), raw["bookings"].filter(~early))):
        arrival.write.parquet(f"{landing}/in/slice={number}")
        arrivals = spark.readStream.schema(raw["bookings"].schema).parquet(f"{landing}/in/slice=*")
        staged = stage(arrivals, "bookings")
        stream_into_fact(
            staged, fact, lambda batch: int_bookings(batch, partners), f"{landing}/checkpoint"
        ).awaitTermination()
    return fact.read()


# -- reports --------------------------------------------------------------------------------------------------
def _parts(m: Models) -> DataFrame:
    return report.monthly_parts(m["active_bookings"], m["int_cancellations"])


def _report(m: Models) -> DataFrame:
    return report.enforced(report.revenue_by_partner(_parts(m), m["dim_partners"]))


def rpt_contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rules on a report that breaks them: some names are missing and one currency's rows come twice."""
    m = _warehouse(spark, sf_dir)
    good = report.revenue_by_partner(_parts(m), m["dim_partners"])
    name = F.when(F.col("currency") != "USD", F.col("partner_name"))
    return report.contract_violations(good.withColumn("partner_name", name).unionByName(good.filter("currency = 'BRL'")))


def _refresh(spark: SparkSession, sf_dir: str) -> tuple:
    """Bookings and cancellations loaded in two steps: the second brings late bookings, newer versions and late
    cancellations, all in every third month. Gives the fact tables and the versions after the first step."""
    m = _warehouse(spark, sf_dir)
    third = F.month("booked_at") % 3 == 0
    late, updated = third & (_number("booking_id") % 10 == 3), third & (_number("booking_id") % 20 == 7)
    active = m["active_bookings"]
    older = active.withColumn("status", F.when(updated, F.lit("pending")).otherwise(F.col("status")))
    older = older.withColumn("booked_at", F.when(updated, F.col("booked_at") - F.expr("interval 1 hour")).otherwise(F.col("booked_at")))
    bookings = FactTable(spark, scratch_path(spark, "fact"), "booking_id", "booked_at", grain="month", lookback="36500 days")
    bookings.load(older.filter(~late))
    in_third = active.filter(third & (_number("booking_id") % 4 == 1)).select("booking_id")
    cancelled = FactTable(spark, scratch_path(spark, "fact"), "cancellation_id", "cancelled_at", grain="month", lookback="36500 days")
    cancelled.load(m["int_cancellations"].join(in_third, "booking_id", "left_anti").select(*m["int_cancellations"].columns))
    return m, bookings, cancelled, active.filter(late | updated), m["int_cancellations"].join(in_third, "booking_id", "left_semi")


def rpt_refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revenue report after late, updated and cancelled bookings: only the months these touch are made anew."""
    m, bookings, cancelled, new_bookings, new_cancelled = _refresh(spark, sf_dir)
    parts = report.monthly_parts(bookings.read(), cancelled.read())
    seen = bookings.version(), cancelled.version()
    bookings.load(new_bookings)
    cancelled.load(new_cancelled.select(*m["int_cancellations"].columns))
    months = report.changed_months(bookings.changes(seen[0])).unionByName(report.months_of(bookings.read(), cancelled.changes(seen[1]))).distinct()
    parts = report.refreshed_parts(parts, bookings, cancelled.read(), months)
    return report.enforced(report.revenue_by_partner(parts, m["dim_partners"]))


def fct_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the second load did to the bookings, key by key."""
    _, bookings, _, new_bookings, _ = _refresh(spark, sf_dir)
    seen = bookings.version()
    bookings.load(new_bookings)
    return bookings.changes(seen).select("booking_id", "status", "booked_at", "change", "was")


def fct_random_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings under keys without any order, loaded by halves; the second half brings some stored keys again."""
    m = _warehouse(spark, sf_dir)
    keyed = m["int_bookings"].select(F.sha2("booking_id", 256).alias("booking_key"), "booking_id", "booked_at", "status")
    fact = _fact(spark, "booking_key", "booked_at")
    early = _before("booked_at", BOOKING_CUT)
    fact.load(keyed.filter(early))
    again = early & (_number("booking_id") % 50 == 1)
    moved = F.when(again, F.lit(MOVED_TO).cast("timestamp_ntz")).otherwise(F.col("booked_at"))
    return fact.load(fact.pending(keyed.withColumn("booked_at", moved).filter(~early | again)))


def fx_revenue(rate_date: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = _warehouse(spark, sf_dir)
        return report.revenue_in_brl(m["fct_bookings"], m["int_cancellations"], daily_rates(spark, sf_dir), rate_date)

    return query


def asof_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each event the latest error at or before half a second before it; errors are doubled, so that facts tie."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts", "value")
    points = events.select("event_id", (F.col("user_id") % 50).alias("k"), (F.col("ts") - F.expr("interval 500 milliseconds")).alias("t"))
    errors = events.filter("event_type = 'error'").select((F.col("user_id") % 50).alias("k"), F.col("ts").alias("at"), F.col("value").alias("v"))
    tied = errors.unionByName(errors.withColumn("v", F.col("v") / 2))
    return asof_join(points, tied, "k", "t", "at", "v").select("event_id", F.col("v").alias("latest"))


def asof_skewed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup with a third of all rows under one key and all times squeezed into a few seconds."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts", "value")
    k = F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id") % 50).alias("k")
    squeezed = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (event_id % 4000000) / 1000000.0)")
    points = events.select("event_id", k, squeezed.alias("t"))
    errors = events.filter("event_type = 'error'").select(k, squeezed.alias("at"), F.col("value").alias("v"))
    return asof_join(points, errors, "k", "t", "at", "v").select("event_id", F.col("v").alias("latest"))


def lines_above_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many pairs of a line and a cheaper order there are, under three keys that are all hot."""
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") % 3).alias("k"), "l_extendedprice")
    orders = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).alias("k"), "o_totalprice")
    return pairs_above(lines, orders, "k", "l_extendedprice", "o_totalprice").select("k", F.col("pairs").cast("long").alias("pairs"))


def fx_fine_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of ten decimals."""
    m = _warehouse(spark, sf_dir)
    fine = daily_rates(spark, sf_dir).withColumn("rate", (F.col("rate").cast("decimal(18,10)") / 97).cast("decimal(18,10)"))
    return report.revenue_in_brl(m["fct_bookings"], m["int_cancellations"], fine, "booking")


def asof_booking_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    bookings = _warehouse(spark, sf_dir)["fct_bookings"].select(
        "booking_id", "currency", F.col("booked_at").cast("date").alias("booked_date")
    )
    return asof_join(bookings, daily_rates(spark, sf_dir), "currency", "booked_date", "rate_date", "rate")


# -- quality --------------------------------------------------------------------------------------------------
def _dq(kind: str) -> Query:
    return _on_models(lambda m: quality.run_checks(m, [c for c in SUITE if c.kind == kind]))


def _alerts(m: Models) -> DataFrame:
    return quality.alert_limits(m, MAPPED_CATEGORIES)


def _loaded(spark: SparkSession, m: Models) -> DataFrame:
    """The load times of a fact table that was loaded just now."""
    fact = _fact(spark, "booking_id", "booked_at")
    fact.load(m["fct_bookings"])
    return fact.loads()


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fact table loaded now, judged at ages of 3, 6, 9, ... hours, one for each nation."""
    loaded = _loaded(spark, _warehouse(spark, sf_dir))
    latest = loaded.agg(F.max("loaded_at").cast("timestamp_ntz")).first()[0]
    ages = sorted(3 * (r[0] + 1) for r in table(spark, sf_dir, "nation").select("n_nationkey").collect())
    judged = [quality.freshness(loaded, "loaded_at", F.lit(latest) + F.expr(f"interval {h} hours")) for h in ages]
    return reduce(DataFrame.unionByName, judged).select("age_hours", "fresh")


def dq_trust_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict right after a load, and 30 hours later."""
    m = _warehouse(spark, sf_dir)
    loaded = _loaded(spark, m)
    latest = loaded.agg(F.max("loaded_at").cast("timestamp_ntz")).first()[0]
    fresh = [quality.freshness(loaded, "loaded_at", F.lit(latest) + F.expr(f"interval {h} hours")) for h in (0, 30)]
    return quality.verdict(m, reduce(DataFrame.unionByName, fresh), SUITE, MAPPED_CATEGORIES)


def dq_trust_gate_untrusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load noted at one clock and judged at two others, with partners that come twice and fail an error check."""
    m = _warehouse(spark, sf_dir)
    fact = FactTable(spark, scratch_path(spark, "fact"), "booking_id", "booked_at", grain="month", clock=lambda: datetime(2024, 3, 1, 6))
    fact.load(m["fct_bookings"])
    at = [F.lit(t).cast("timestamp_ntz") for t in ("2024-03-02 05:30:00", "2024-03-02 06:15:00")]
    fresh = reduce(DataFrame.unionByName, [quality.freshness(fact.loads(), "loaded_at", t) for t in at])
    twice = m["dim_partners"].unionByName(m["dim_partners"])
    return quality.verdict(ChainMap({"dim_partners": twice}, _AllModels(m)), fresh, SUITE, MAPPED_CATEGORIES)


class _AllModels(dict):
    """Models as a mapping that makes each when asked for."""

    def __init__(self, models: Models) -> None:
        super().__init__()
        self._models = models

    def __missing__(self, name: str) -> DataFrame:
        return self._models[name]


def dq_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _warehouse(spark, sf_dir)
    parts = [quality.null_rates(m[name], name, expected) for name, expected in EXPECTED_NULLS.items()]
    return reduce(DataFrame.unionByName, parts)


def profile_case_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_tables(spark, sf_dir)
    return reduce(DataFrame.unionByName, [quality.case_variants(raw[t], column, t) for t, column in CASE_COLUMNS])


# -- the same models through SQL ------------------------------------------------------------------------------
def _sql(spark: SparkSession, sf_dir: str, views: tuple[str, ...], text: str) -> DataFrame:
    register_functions(spark)
    _warehouse(spark, sf_dir).register_views(views)
    return spark.sql(text)


def sql_monthly_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(
        spark,
        sf_dir,
        ("fct_bookings", "int_cancellations"),
        """SELECT strftime(b.booked_at, '%Y-%m') AS mes_ano, count(*) AS quantidade_reservas
        FROM fct_bookings b LEFT ANTI JOIN int_cancellations c ON b.booking_id = c.booking_id
        WHERE b.status IN ('confirmed', 'completed') GROUP BY ALL""",
    )


def sql_burst_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sql(
        spark,
        sf_dir,
        ("stg_searches", "fct_sessions"),
        """SELECT time_bucket(INTERVAL '7' MINUTE, q.searched_at) AS bucket, count(*) AS searches,
          max(hour_boundaries(s.started_at, q.searched_at)) AS latest_hour
        FROM stg_searches q JOIN fct_sessions s ON q.session_id = s.session_id GROUP BY ALL""",
    )


# -- operators on the large tables themselves -----------------------------------------------------------------
def latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


def revenue_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = sums_by_value("l_extendedprice", "l_returnflag", ("A", "N", "R"), "total_")
    return table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(F.count("*").alias("line_count"), *sums)


def event_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return _six_digits(iqr_upper_outliers(events, "event_type", "value", IQR_FACTOR, "upper_limit"), "upper_limit")


def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    out = exact_quantiles(lines, "l_returnflag", "l_extendedprice", (0.05, 0.5, 0.95))
    return _six_digits(out, "q_0", "q_1", "q_2")


def event_outliers_null_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a type are a group of their own."""
    events = table(spark, sf_dir, "events").select("event_id", F.nullif("event_type", F.lit("view")).alias("event_type"), "value")
    return _six_digits(iqr_upper_outliers(events, "event_type", "value", IQR_FACTOR, "upper_limit"), "upper_limit")


def quantiles_infinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles next to infinite values."""
    price = F.when(F.col("l_quantity") > 48, float("inf")).otherwise(F.col("l_extendedprice"))
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", price.alias("price"))
    return _six_digits(exact_quantiles(lines, "l_returnflag", "price", (0.5, 0.9, 1.0)), "q_0", "q_1", "q_2")


# -- sources and sinks ----------------------------------------------------------------------------------------
def csv_round_trip(name: str) -> Query:
    """A raw table written as CSV, read with its declared schema and staged."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, raw = scratch_path(spark, "raw-csv"), raw_tables(spark, sf_dir)[name]
        writer = raw.select(*raw_schema(name).names).write.option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        # Blanks stay, so that a blank value does not come back as null.
        writer.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return stage(read_csv(spark, path, name), name)

    return query


def exported(name: str) -> Query:
    """A reader export written as CSV and read back with the types of its result."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder, m = scratch_path(spark, "exports"), _warehouse(spark, sf_dir)
        export_results(m, folder, [name])
        return spark.read.schema(EXPORTS[name](m).schema).csv(f"{folder}/{name}", header=True, mode="FAILFAST")

    return query


def parquet_marts_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models written as tables and read by name."""
    folder = scratch_path(spark, "marts")
    _warehouse(spark, sf_dir).write(folder, ("dim_partners", "fct_bookings"))
    tables = read_tables(spark, folder, ["dim_partners", "fct_bookings"])
    return tables["fct_bookings"].join(tables["dim_partners"].select("partner_id", "partner_name"), "partner_id").select(
        "booking_id", "partner_name", "total_amount"
    )


def csv_export_uncapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sorted CSV export of every booking, read back."""
    path, m = scratch_path(spark, "export"), _warehouse(spark, sf_dir)
    export_csv(m["fct_bookings"].select("booking_id", "currency", "status"), path, F.asc("booking_id"))
    return spark.read.schema("booking_id string, currency string, status string").csv(path, header=True)


def month_close_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed months exported twice, the second time one month alone; the others stay."""
    path, whole = scratch_path(spark, "close"), _report(_warehouse(spark, sf_dir))
    export_closed_months(whole, path)
    first = whole.agg(F.min("reference_month")).first()[0]
    export_closed_months(whole.filter(F.col("reference_month") == F.lit(first)), path)
    names = [c for c in whole.columns if c not in ("is_partial_month", "reference_month")]
    text = ", ".join(f"{c} string" for c in names)
    back = spark.read.schema(f"{text}, reference_month date").csv(path, header=True)
    return back.select("partner_id", "currency", F.col("booking_count").cast("long").alias("booking_count"), "reference_month")


def _session_bitmaps(m: Models) -> DataFrame:
    """Bitmaps of the funnel's sessions from two loads, days before the middle one and the others; the second load numbers
    its new sessions only."""
    activity = materialise(metrics.funnel_activity(*[m[n] for n in ("int_sessions", "int_searches", "fct_bookings", "int_cancellations")]), "funnel-days")
    middle = activity.agg(F.expr("date_add(min(dia), CAST(datediff(max(dia), min(dia)) / 2 AS INT))")).first()[0]
    early = F.coalesce(F.col("dia") < F.lit(middle), F.lit(False))
    numbers, loads = None, []
    for rows in (activity.filter(early), activity.filter(~early)):
        numbers = numbered(rows, "session_id", "dia", numbers)
        loads.append(materialise(key_bitmaps(rows, metrics.FUNNEL_GROUPS, "session_id", numbers), "session-bitmaps"))
    return reduce(DataFrame.unionByName, loads)


def _active_by_month(m: Models) -> DataFrame:
    months = _session_bitmaps(m).withColumn("mes", month_label("dia"))
    return distinct_counts(months, ("mes", "etapa"), "sessoes")


def _sketched_amounts(m: Models) -> DataFrame:
    """Quartiles per category from summaries of months, with whether their ranks, counted exactly, lie within the stated
    error; twice that error leaves room for the one case in a hundred."""
    base = anomalies.amounts_by_category(m["int_bookings"]).withColumn("mes", month_label("booked_at"))
    months = materialise(value_sketches(base, ("car_category", "mes"), "total_amount"), "month-sketches")
    quartiles = materialise(sketched_quantiles(months, ("car_category",), (0.25, 0.75)), "quartiles")
    far = rank_distance(base, "car_category", "total_amount", quartiles, (0.25, 0.75))
    return far.join(quartiles.select("car_category", F.col("n").alias("summarised")), "car_category").select(
        "car_category", "n", "summarised", *[(F.col(f"d_{i}") <= 2 * rank_error(SIZE)).alias(f"q{q}_within") for i, q in ((0, 1), (1, 3))]
    )


def dq_suite_by_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suite from three loads of every table, one of them judged twice."""
    m, states = _warehouse(spark, sf_dir), CheckStates(spark, scratch_path(spark, "check-states"), SUITE)
    names = {name for c in SUITE for name in (c.model, c.parent) if name}
    for load in (0, 1, 2, 1):
        states.judge(f"load {load}", {n: m[n].filter(F.pmod(F.xxhash64(m[n].columns[0]), F.lit(3)) == load) for n in names})
    return states.results().unionByName(quality.run_singular(m))


def event_bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixed_bursts(table(spark, sf_dir, "events"), "user_id", "ts", 7 * 86400, 1)


def event_bursts_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_bursts(table(spark, sf_dir, "events"), "user_id", "ts", 3600, 1)


def events_per_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = bucket_start("ts", 7 * 60).alias("bucket_start")
    return table(spark, sf_dir, "events").groupBy(start).agg(F.count("*").alias("events"))


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """The contract revenue report, on the smallest tables unless told otherwise."""
    return _plain(_report(_models(spark, sf_dir, written=True)))


def _findable(run: Query) -> Query:
    """Python workers of a local session find the package even if the session was started in another folder."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        here, environment = os.path.dirname(os.path.abspath(__file__)), spark.sparkContext.environment
        paths = environment.get("PYTHONPATH", "").split(os.pathsep)
        if here not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, paths)])
        return run(spark, sf_dir)

    return query


def _all() -> dict[str, Query]:
    funnel_inputs = ("int_sessions", "int_searches", "fct_bookings", "int_cancellations")
    named: dict[str, Query] = {name: _model_query(name) for name in (*STAGING, *INTERMEDIATE, "dim_partners", "dim_users")}
    named |= {
        "build_models": build_models,
        "fct_bookings_full": fct_bookings_full,
        "fct_bookings_incremental": fct_bookings_incremental,
        "fct_bookings_late_rows": fct_bookings_late_rows,
        "fct_bookings_updated_rows": fct_bookings_updated_rows,
        "fct_sessions_incremental": fct_sessions_incremental,
        "fct_random_keys": fct_random_keys,
        "fct_changes": fct_changes,
        "rpt_refreshed": rpt_refreshed,
        "funnel_by_segment": _on_models(lambda m: metrics.funnel_by_segment(*[m[n] for n in funnel_inputs])),
        "funnel_by_segment_confirmed": _on_models(
            lambda m: metrics.funnel_by_segment(*[m[n] for n in funnel_inputs], statuses=("confirmed", "completed"))
        ),
        "funnel_stages_long": _on_models(lambda m: metrics.funnel_stages(*[m[n] for n in funnel_inputs])),
        "funnel_from_bitmaps": _on_models(lambda m: metrics.funnel_from_bitmaps(_session_bitmaps(m))),
        "sessions_active_by_month": _on_models(_active_by_month),
        "top_partners_90d": _on_models(
            lambda m: metrics.top_partners(m["fct_bookings"], m["int_cancellations"], m["dim_partners"])
        ),
        "ltv_cohort": _on_models(
            lambda m: metrics.ltv_cohort(
                m["fct_bookings"], m["int_cancellations"], m["dim_users"], day_label("first_seen_at")
            )
        ),
        "ltv_cohort_month": _on_models(
            lambda m: metrics.ltv_cohort(m["fct_bookings"], m["int_cancellations"], m["dim_users"])
        ),
        "monthly_evolution": _on_models(lambda m: metrics.monthly_evolution(m["fct_bookings"], m["int_cancellations"])),
        "bot_burst_fixed": _on_models(
            lambda m: anomalies.search_bursts(m["stg_searches"], m["stg_sessions"], MAPPED_BURST)
        ),
        "bot_burst_sliding": _on_models(
            lambda m: anomalies.search_bursts(m["stg_searches"], m["stg_sessions"], MAPPED_BURST, sliding=True, distinct=True)
        ),
        "cancellation_outliers": _on_models(
            lambda m: metrics.cancellation_outliers(
                m["fct_bookings"], m["int_cancellations"], m["dim_partners"], include_lower=True
            )
        ),
        "cancellation_outliers_15": _on_models(
            lambda m: metrics.cancellation_outliers(m["fct_bookings"], m["int_cancellations"], m["dim_partners"], 1.5)
        ),
        "cancellation_outliers_same_population": _on_models(
            lambda m: metrics.cancellation_outliers(
                m["fct_bookings"], m["int_cancellations"], m["dim_partners"], same_population=True
            )
        ),
        "click_without_result": _on_models(lambda m: anomalies.clicks_without_result(m["int_searches"])),
        "long_sessions": _on_models(lambda m: anomalies.long_sessions(m["int_sessions"])),
        "amount_outliers_iqr": _on_models(
            lambda m: _six_digits(anomalies.amount_outliers(m["int_bookings"]), "limite_superior")
        ),
        "amount_quartiles_sketched": _on_models(_sketched_amounts),
        "refund_over_total": _on_models(
            lambda m: anomalies.refund_over_total_rows(m["stg_cancellations"], m["stg_bookings"])
        ),
        "refund_over_total_counted": _on_models(
            lambda m: anomalies.refunds_over_total(m["stg_cancellations"], m["stg_bookings"])
        ),
        "refund_over_total_by_booking": _on_models(
            lambda m: anomalies.refunds_over_total_counted(m["stg_cancellations"], m["stg_bookings"]).withColumn("pairs", F.col("pairs").cast("long"))
        ),
        "lines_above_orders": lines_above_orders,
        "same_user_day": _on_models(lambda m: anomalies.same_user_day(m["int_bookings"])),
        "dq_not_null": _dq("not_null"),
        "dq_unique": _dq("unique"),
        "dq_accepted_values": _dq("accepted_values"),
        "dq_relationships": _dq("relationships"),
        "dq_between": _dq("between"),
        "dq_pair_greater": _dq("pair_greater"),
        "dq_suite": _on_models(lambda m: quality.run_suite(m, SUITE)),
        "dq_suite_by_loads": dq_suite_by_loads,
        "dq_extended": _on_models(lambda m: quality.run_checks(m, quality.EXTENDED_SUITE)),
        "dq_thresholds": _on_models(_alerts),
        "dq_null_rates": dq_null_rates,
        "dq_freshness": dq_freshness,
        "dq_trust_gate": dq_trust_gate,
        "dq_trust_gate_untrusted": dq_trust_gate_untrusted,
        "profile_duplicates": lambda spark, sf_dir: quality.profile_duplicates(
            raw_tables(spark, sf_dir), quality.RAW_KEYS
        ),
        "profile_case_variants": profile_case_variants,
        "rpt_revenue_by_partner": _on_models(_report),
        "completeness_index": _on_models(lambda m: report.completeness_index(_parts(m))),
        "invalid_amount_run": _on_models(lambda m: report.invalid_amount_rate(_parts(m))),
        "rpt_contract_violations": rpt_contract_violations,
        "suspicious_bookings": _on_models(lambda m: report.suspicious_bookings(m["int_bookings"])),
        "suspicious_rate": _on_models(lambda m: report.suspicious_rate(m["int_bookings"])),
        "currency_domain_check": _on_models(lambda m: quality.currency_domain(m["fct_bookings"], CURRENCIES[:4])),
        "net_revenue": _on_models(lambda m: report.net_revenue(m["fct_bookings"], m["int_cancellations"])),
        "fx_revenue_asof": fx_revenue("booking"),
        "fx_revenue_month_close": fx_revenue("month_close"),
        "fx_fine_rates": fx_fine_rates,
        "asof_booking_rate": asof_booking_rate,
        "asof_event_times": asof_event_times,
        "asof_skewed_times": asof_skewed_times,
        "avg_ticket": _on_models(lambda m: metrics.average_ticket(m["fct_bookings"])),
        "scorecards": _on_models(lambda m: metrics.scorecards(*[m[n] for n in funnel_inputs])),
        "sql_monthly_evolution": sql_monthly_evolution,
        "sql_burst_counts": sql_burst_counts,
        "revenue_mom_change": _on_models(lambda m: metrics.revenue_change(_report(m))),
        "stream_burst": stream_burst,
        "stream_fct_upsert": stream_fct_upsert,
        "stream_fct_unordered": stream_fct_unordered,
        "stream_burst_sliding": stream_burst_sliding,
        "stream_newest_bookings": stream_newest_bookings,
        "stream_int_searches": stream_int_searches,
        "fct_lookback_late": fct_lookback_late,
        "csv_round_trip": csv_round_trip("bookings"),
        **{f"csv_round_trip_{t}": csv_round_trip(t) for t in RAW_COLUMNS if t != "bookings"},
        **{f"export_{name}": exported(name) for name in EXPORTS if name != "search_bursts"},  # no session is over its limit
        "parquet_marts_read": parquet_marts_read,
        "csv_export_uncapped": csv_export_uncapped,
        "month_close_export": month_close_export,
        "event_outliers_null_group": event_outliers_null_group,
        "quantiles_infinite": quantiles_infinite,
        "pii_masked_export": _on_models(lambda m: restricted(m["fct_bookings"])),
        "pii_keyed_export": _on_models(lambda m: restricted(m["fct_bookings"], key="registered")),
        "pii_masked_partners": _on_models(lambda m: restricted(m["dim_partners"])),
        "pii_dropped_sessions": _on_models(lambda m: restricted(m["fct_sessions"], "drop")),
        "latest_line": latest_line,
        "revenue_by_flag": revenue_by_flag,
        "event_outliers": event_outliers,
        "price_quantiles": price_quantiles,
        "event_bursts": event_bursts,
        "event_bursts_sliding": event_bursts_sliding,
        "events_per_bucket": events_per_bucket,
    }
    return named


def queries() -> dict[str, Query]:
    own = {name: (lambda spark, sf_dir, run=run: _plain(run(spark, sf_dir))) for name, run in _all().items()}
    return {**own, **{name: _findable(run) for name, run in LLM_QUERIES.items()}}


def oracle_sql() -> dict[str, str]:
    """The SQL whose result each query must equal."""
    return {**ORACLES, **LLM_ORACLES}
