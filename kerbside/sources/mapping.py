"""The five raw tables derived from the order and event tables of the test data.

The mapping adds the faults the real inputs have: repeated rows, stray case and spaces, nulls, wrong signs, late
ends, unknown partners. Every raw row depends only on table values, so the same rows come out of any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The car categories that count as canonical in this mapping ("promo" plays the foreign one).
MAPPED_CATEGORIES = ("economy", "standard", "medium", "large", "small")


# Declared schemas: reading a table then needs no extra job over the file footers.
TABLES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


class RawTables(dict):
    """The raw tables by name, each built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._read = lambda name: table(spark, sf_dir, name)

    def __missing__(self, name: str) -> DataFrame:
        build, inputs = _BUILDERS[name]
        self[name] = build(*[self._read(i) for i in inputs])
        return self[name]


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    """All raw tables, lazily."""
    return RawTables(spark, sf_dir)


def _repeat_if(df: DataFrame, condition: str) -> DataFrame:
    """Emit rows that meet the condition twice, in the same scan."""
    return df.withColumn("_copy", F.expr(f"explode(if({condition}, array(0, 1), array(0)))"))


def _partners(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    rows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).withColumnRenamed("s_suppkey", "k")
    return _repeat_if(rows, "k % 10 = 1").selectExpr(
        "'PRT' || k AS partner_id",
        "s_name AS partner_name",
        "n_name AS country",
        "CASE k % 4 WHEN 0 THEN 'gold' WHEN 1 THEN 'Silver ' WHEN 2 THEN 'bronze' END AS tier",
        "CASE WHEN k % 7 = 3 THEN 'inactive' WHEN k % 5 = 2 THEN 'Active' ELSE 'active' END AS status",
        "CASE WHEN k % 9 = 8 THEN 0.35D ELSE 0.05D + (k % 26) / 100D END AS commission_rate",
        "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS created_at",
        "CASE WHEN k % 3 > 0 THEN TIMESTAMP_NTZ '2023-06-01 00:00:00' END AS updated_at",
        "CASE WHEN k % 6 > 0 THEN 'OPS' || k || '@Example.com ' END AS contact_email",
    )


def _sessions(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    daily = events.groupBy(F.col("user_id").alias("k"), F.dayofmonth("ts").alias("day")).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.min("event_id").alias("first_event"),
        F.count("*").cast("int").alias("page_views"),
        F.expr("count_if(event_type = 'error')").alias("errors"),
    )
    rows = daily.join(customer, F.col("k") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _repeat_if(rows, "k % 20 = 4").selectExpr(
        "k || '-' || day AS session_id",
        "CASE WHEN k % 8 <> 7 THEN 'U' || k END AS user_id",
        "first_ts AS started_at",
        "CASE WHEN first_event % 25 <> 0 THEN last_ts END AS ended_at",
        "CASE k % 4 WHEN 0 THEN 'google_cpc' WHEN 1 THEN 'Direct ' WHEN 2 THEN 'affiliate' ELSE 'email' END AS channel",
        "CASE WHEN k % 3 = 0 THEN lower(c_mktsegment) WHEN k % 29 = 1 THEN '  ' ELSE c_mktsegment END AS device",
        "CASE WHEN k % 2 = 0 THEN lower(n_name) ELSE n_name END AS country",
        "page_views",
        "CASE WHEN k % 10 >= 3 THEN CASE WHEN k % 2 = 0 THEN ' Google' ELSE 'newsletter' END END AS utm_source",
        "CASE WHEN k % 10 >= 3 THEN 'CAMP' || k % 5 END AS utm_campaign",
        "errors >= 2 AS is_bot",
    )


def search_events(events: DataFrame) -> DataFrame:
    """Raw searches; row by row, so the same code serves a batch and a stream of events."""
    rows = events.filter("event_type IN ('view', 'click')").withColumnRenamed("event_id", "k")
    return _repeat_if(rows, "k % 50 = 0").selectExpr(
        "'SRC' || k AS search_id",
        "user_id || '-' || day(ts) AS session_id",
        "ts AS searched_at",
        "' City ' || k % 50 AS pickup_location",
        "'City ' || k % 40 || ' ' AS dropoff_location",
        "CAST(ts AS DATE) AS pickup_date",
        "CASE WHEN k % 113 = 0 THEN DATE '2023-12-01' ELSE DATE '2024-03-01' END AS dropoff_date",
        """CASE WHEN k % 37 = 0 THEN NULL ELSE CASE k % 6 WHEN 0 THEN 'economy' WHEN 1 THEN ' Standard'
           WHEN 2 THEN 'MEDIUM ' WHEN 3 THEN 'large' WHEN 4 THEN 'small' ELSE 'promo' END END AS car_category""",
        "CAST(floor(value) % 5 AS INT) AS num_results",
        """CASE WHEN event_type = 'click' THEN
           CASE WHEN k % 71 = 0 THEN 'PRT-unknown' ELSE 'PRT' || k % 10 END END AS partner_id_clicked""",
        "value AS price_shown",
    )


def _bookings(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    heads = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("suppkey"), F.min("l_partkey").alias("partkey"))
    rows = (
        orders.withColumnRenamed("o_orderkey", "k")
        .join(heads, F.col("k") == F.col("l_orderkey"), "left")
        .join(part.select("p_partkey", "p_type"), F.col("partkey") == F.col("p_partkey"), "left")
        .withColumn("pickup", F.expr("date_add(CAST(o_orderdate AS DATE), CAST(k % 30 AS INT))"))
    )
    return _repeat_if(rows, "k % 150 = 0").selectExpr(
        "'BKG' || k AS booking_id",
        "o_custkey || '-' || day(o_orderdate) AS session_id",
        "CASE WHEN k % 9 <> 0 THEN 'U' || o_custkey END AS user_id",
        "'PRT' || suppkey AS partner_id",
        "o_orderdate AS booked_at",
        "pickup AS pickup_date",
        "CASE WHEN k % 101 = 0 THEN date_sub(pickup, 1) ELSE date_add(pickup, CAST(k % 10 + 1 AS INT)) END AS dropoff_date",
        "' City ' || k % 50 AS pickup_location",
        "CASE WHEN k % 31 <> 0 THEN ' ' || p_type END AS car_category",
        "o_totalprice / 8D AS daily_rate",
        """CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN -o_totalprice
           WHEN k % 83 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS total_amount""",
        """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BRL' WHEN '2' THEN 'usd' WHEN '3' THEN 'ARS'
           WHEN '4' THEN 'CLP ' ELSE 'COP' END AS currency""",
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'Confirmed ' ELSE 'pending' END AS status",
        "CASE k % 4 WHEN 1 THEN 'Credit_Card ' WHEN 2 THEN 'pix' WHEN 3 THEN 'boleto' END AS payment_method",
    )


def _cancellations(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter("l_returnflag = 'R' AND l_linenumber = 1").selectExpr(
        "'CAN' || l_orderkey AS cancellation_id",
        "'BKG' || l_orderkey AS booking_id",
        "l_shipdate AS cancelled_at",
        "CASE l_suppkey % 3 WHEN 0 THEN 'Changed plans ' WHEN 1 THEN 'price' ELSE 'No Show' END AS reason",
        "CASE WHEN l_suppkey % 2 = 0 THEN 'User' ELSE 'partner ' END AS cancelled_by",
        "CASE WHEN l_quantity <= 45 THEN l_extendedprice END AS refund_amount",
        "CASE WHEN l_suppkey % 5 = 0 THEN 'Pending' ELSE 'done' END AS refund_status",
        "CAST(l_quantity AS INT) - 3 AS days_before_pickup",
    )


_BUILDERS = {
    "partners": (_partners, ("supplier", "nation")),
    "sessions": (_sessions, ("events", "customer", "nation")),
    "searches": (search_events, ("events",)),
    "bookings": (_bookings, ("orders", "lineitem", "part")),
    "cancellations": (_cancellations, ("lineitem",)),
}


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily exchange rates to BRL with missing days: (currency, rate_date, rate), counted from the orders."""
    currency = """CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'BRL' WHEN '2' THEN 'USD' WHEN '3' THEN 'ARS'
        WHEN '4' THEN 'CLP' ELSE 'COP' END"""
    counted = (
        table(spark, sf_dir, "orders")
        .filter("day(o_orderdate) % 3 = 1")
        .groupBy(F.expr(currency).alias("currency"), F.expr("CAST(o_orderdate AS DATE)").alias("rate_date"))
        .agg(F.count("*").alias("n"))
    )
    rate = "CAST(CASE WHEN currency = 'BRL' THEN 1D ELSE (n % 50 + 1) / 20D END AS DECIMAL(18, 6)) AS rate"
    return counted.selectExpr("currency", "rate_date", rate)
