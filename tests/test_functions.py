"""Expressions, against values worked out by hand."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kerbside.functions.numeric import ratio_pct, round2, sums_by_value
from kerbside.functions.text import blank_as, cleaned
from kerbside.functions.time import bucket_start, epoch_seconds, hour_boundaries, month_start


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.mark.parametrize("value, expected", [(1.005, 1.0), (0.285, 0.28), (8.325, 8.32), (2.5, 2.5), (-1.255, -1.25), (33.3333, 33.33)])
def test_round2_scales_before_rounding(spark, value, expected):
    assert one(spark, round2(F.lit(value))) == expected


def test_ratio_of_nothing_is_null(spark):
    assert one(spark, ratio_pct(F.lit(3), F.lit(0))) is None
    assert one(spark, ratio_pct(F.lit(1), F.lit(4))) == 25.0


@pytest.mark.parametrize(
    "start, end, hours",
    [
        ("2024-01-01 00:59:00", "2024-01-01 07:01:00", 7),
        ("2024-01-01 00:00:00", "2024-01-01 06:59:59", 6),
        ("2024-01-01 23:59:59", "2024-01-02 00:00:00", 1),
        ("2024-01-03 01:30:00", "2024-01-01 23:10:00", -26),
    ],
)
def test_hour_boundaries_count_the_clock(spark, start, end, hours):
    assert one(spark, hour_boundaries(ntz(start), ntz(end))) == hours


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert one(spark, epoch_seconds(ntz("1970-01-02 00:00:01"))) == 86401
        assert one(spark, hour_boundaries(ntz("2024-01-01 00:59:00"), ntz("2024-01-01 07:01:00"))) == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bucket_origin_is_a_monday_for_odd_widths(spark):
    df = spark.range(1).select(ntz("2024-01-04 10:07:30").alias("t"))
    assert str(df.select(bucket_start("t", 300).alias("a")).first()["a"]) == "2024-01-04 10:05:00"
    assert str(df.select(bucket_start("t", 7 * 86400).alias("b")).first()["b"]) == "2024-01-01 00:00:00"


def test_month_start(spark):
    assert str(one(spark, month_start(ntz("2024-02-29 23:00:00")))) == "2024-02-01"


def test_cleaning_and_blanks(spark):
    assert one(spark, cleaned(F.lit("  Br "), "upper")) == "BR"
    assert one(spark, cleaned(F.lit("  Br "), "lower")) == "br"
    assert one(spark, cleaned(F.lit("\tx "), "trim")) == "\tx"
    assert one(spark, blank_as(F.lit("   "), "?")) == "?"
    assert one(spark, blank_as(F.lit(None).cast("string"), "?")) == "?"
    assert one(spark, blank_as(F.lit(" a "), "?")) == "a"


def test_strict_cast_fails_and_tolerant_cast_is_null(spark):
    assert one(spark, cleaned(F.lit("not a date"), "date", strict=False)) is None
    with pytest.raises(PySparkException):
        one(spark, cleaned(F.lit("not a date"), "date"))


def test_sums_by_value_are_zero_without_rows(spark):
    df = spark.createDataFrame([("BRL", 0.1), ("BRL", 0.2), ("XXX", 9.0)], "currency string, amount double")
    row = df.agg(*sums_by_value("amount", "currency", ("BRL", "USD"), "t_")).first()
    assert (row["t_brl"], row["t_usd"]) == (0.3, 0.0)
