"""Lookups and counts by ranges: brute force, hot keys, and how evenly ranges are dealt."""

import bisect
import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kerbside import session
from kerbside.operators import inequality, ranged
from kerbside.operators.asof import asof_join
from kerbside.operators.inequality import pairs_above
from kerbside.operators.ranged import RANGE, in_ranges
from kerbside.plans import anomalies

NOW = datetime(2024, 1, 1)


@pytest.fixture
def plain_shuffles(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_asof_equals_brute_force_on_a_hot_key_within_a_second(plain_shuffles, ranges):
    spark, rng = plain_shuffles, random.Random(4)
    at = lambda: NOW + timedelta(microseconds=rng.randrange(900))
    key = lambda: rng.choice(["hot"] * 4 + ["a", "b", None])
    points = [(i, key(), at()) for i in range(400)] + [(400, "no facts", NOW), (401, "hot", NOW - timedelta(days=1)), (402, "hot", None)]
    facts = [(key(), at(), float(rng.randrange(50))) for _ in range(300)] + [("hot", None, 1.0), ("hot", NOW, None)]
    got = asof_join(spark.createDataFrame(points, "i int, k string, t timestamp_ntz"), spark.createDataFrame(facts, "k string, f timestamp_ntz, v double"), "k", "t", "f", "v", ranges)
    found = {r["i"]: r["v"] for r in got.collect()}
    assert len(found) == len(points)
    for i, k, t in points:
        known = [(f, v) for c, f, v in facts if c == k and k is not None and t is not None and f is not None and v is not None and f <= t]
        assert found[i] == (max(known)[1] if known else None)


def test_a_hot_key_is_dealt_to_all_ranges(plain_shuffles):
    rows = plain_shuffles.range(60_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 1000)).alias("k"),
        F.expr("timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 0, (id % 7919) / 1000000.0)").alias("t"),
        "id",
    )
    sizes = sorted(r["count"] for r in in_ranges(rows, "k", "t", "id", ranges=12).groupBy(RANGE).count().collect())
    assert len(sizes) == 12 and sum(sizes) == 60_000
    assert sizes[-1] <= 2 * sizes[6]


@pytest.mark.parametrize("ranges", [None, 5])
def test_pairs_are_counted_as_listed(plain_shuffles, ranges):
    spark, rng = plain_shuffles, random.Random(9)
    value = lambda: rng.choice([None, *range(12)])
    left = [(rng.choice(["hot"] * 5 + ["a", "b", "only left", None]), value()) for _ in range(600)]
    right = [(rng.choice(["hot"] * 5 + ["a", "b", "only right", None]), value()) for _ in range(500)] + [("low", 5)] * 3
    left += [("low", 9), ("low", 5), ("low", 1)]
    got = pairs_above(spark.createDataFrame(left, "k string, x int"), spark.createDataFrame(right, "k string, y int"), "k", "x", "y", ranges)
    want = Counter(k for k, x in left for c, y in right if k is not None and c == k and x is not None and y is not None and x > y)
    assert {r["k"]: r["pairs"] for r in got.collect()} == {k: Decimal(n) for k, n in want.items()}


def test_a_hot_booking_is_counted_without_listing_its_pairs(spark):
    rows = spark.range(200_000)
    refunds = rows.selectExpr("'B1' booking_id", "cast(id as string) cancellation_id", "cast(id as double) refund_amount")
    totals = rows.selectExpr("'B1' booking_id", "cast(id as double) + 0.5 total_amount")
    found = anomalies.refunds_over_total_counted(refunds, totals).collect()
    assert [(r["booking_id"], int(r["pairs"])) for r in found] == [("B1", 200_000 * 199_999 // 2)]


def test_copies_of_a_violation_are_listed(spark):
    refunds = spark.createDataFrame([("C1", "B1", 9.0)] * 50, "cancellation_id string, booking_id string, refund_amount double")
    totals = spark.createDataFrame([("B1", 5.0)] * 60 + [("B1", 20.0)], "booking_id string, total_amount double")
    assert anomalies.refund_over_total_rows(refunds, totals).count() == 3000
    assert int(anomalies.refunds_over_total_counted(refunds, totals).first()["pairs"]) == 3000


def test_ranges_of_a_hot_key_do_not_grow_with_the_rows(spark, monkeypatch):
    written = []
    monkeypatch.setattr(inequality, "_RANGE_ROWS", 1000, raising=False)
    keep = lambda df, label: written.append((label, session.materialise(df, label))) or written[-1][1]
    for module in (inequality, ranged):
        monkeypatch.setattr(module, "materialise", keep)
    left = spark.range(12_000).select(F.lit(1).alias("k"), (F.col("id") * 7 % 5000).alias("v"))
    right = spark.range(8_000).select(F.lit(1).alias("k"), (F.col("id") * 3 % 5000).alias("v"))
    pairs = inequality.pairs_above(left, right, "k", "v", "v").collect()
    rights = sorted(n * 3 % 5000 for n in range(8_000))
    assert [tuple(r) for r in pairs] == [(1, sum(bisect.bisect_left(rights, n * 7 % 5000) for n in range(12_000)))]
    sizes = [r["count"] for label, df in written if label == "ranges" for r in df.groupBy(ranged.RANGE).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 1000
