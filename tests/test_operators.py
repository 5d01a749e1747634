"""Operators against brute force on small inputs, with skewed keys and repeated rows."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.operators.asof import asof_join
from kerbside.operators.bursts import fixed_bursts, sliding_bursts
from kerbside.operators.dedup import duplicate_profile, latest_per_key
from kerbside.operators.joins import existing_in_dimension, existing_only, hot_keys, not_in, skew_safe_join, with_presence
from kerbside.operators.periods import trailing_period
from kerbside.operators.quantiles import exact_quantiles, iqr_upper_outliers
from kerbside.operators.sigma import with_sigma_limits

NOW = datetime(2024, 1, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_per_key_keeps_one_row_whatever_the_order(spark):
    data = [("a", 1, "x"), ("a", 3, "y"), ("a", 3, "z"), ("b", None, "p"), ("b", 0, "q"), (None, 5, "n"), ("c", None, "r")]
    want = [("a", 3, "z"), ("b", 0, "q"), ("c", None, "r"), (None, 5, "n")]
    for seed in range(4):
        shuffled = random.Random(seed).sample(data, len(data))
        got = latest_per_key(spark.createDataFrame(shuffled, "k string, t int, v string").repartition(3), "k", "t")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(latest_per_key(df, "k", "t"))
    assert text.count("WindowGroupLimit") == 2


def test_duplicate_profile_tells_copies_from_conflicts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", 2), ("c", 1), (None, 1), (None, 1)], "k string, v int")
    row = duplicate_profile(df, "k", "t").first()
    assert (row["row_count"], row["duplicated_keys"], row["conflicting_keys"]) == (7, 2, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows carry one key, in exact copies."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 100).cast("string"))).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("v"),
    ).repartition(8)


def test_hot_key_is_found_and_split(spark, skewed):
    assert hot_keys(skewed, "k", 0.1) == ["hot"]
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3)], "k string, w int")
    joined = skew_safe_join(skewed, right.hint("merge"), "k", "inner", spread=8, share=0.1)
    want = skewed.join(right, "k")
    assert rows(joined.select("k", "v", "w")) == rows(want.select("k", "v", "w"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = joined.filter("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spread > 1


def test_existing_only_matches_a_set_lookup(spark, skewed):
    other = spark.createDataFrame([("hot",), ("k4",), ("k4",), (None,)], "k string")
    want = [tuple(r) for r in skewed.collect() if r["k"] in ("hot", "k4")]
    assert rows(existing_only(skewed, other, "k")) == sorted(want)
    assert rows(existing_in_dimension(skewed, other, "k")) == sorted(want)


def test_a_small_compressible_hot_input_is_split(spark, tmp_path):
    """A column of one repeated value is a few hundred bytes on disk, whatever its rows."""
    path = f"file://{tmp_path}/hot"
    spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000 + 1).alias("k")).write.parquet(path)
    hot = spark.read.parquet(path)
    assert "_part" in plan(skew_safe_join(hot, spark.createDataFrame([(0, "x")], "k long, w string").hint("merge"), "k", "inner"))


def test_spark_decides_on_the_size_of_a_dimension(spark, skewed):
    other = spark.createDataFrame([("hot",), ("k4",)], "k string")
    assert "BroadcastHashJoin" in plan(existing_in_dimension(skewed, other, "k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert "BroadcastHashJoin" not in plan(existing_in_dimension(skewed, other, "k"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_not_in_keeps_null_keys_and_ignores_null_candidates(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert {r["k"] for r in not_in(left, right, "k").collect()} == {"b", None}
    flagged = {r["k"]: r["f"] for r in with_presence(left, right, "k", "f").collect()}
    assert flagged == {"a": True, "b": False, None: False}


def test_trailing_period_includes_its_limit(spark):
    df = spark.createDataFrame([(NOW - timedelta(days=d),) for d in (0, 89, 90, 91)], "t timestamp_ntz")
    assert trailing_period(df, "t", 90).count() == 3
    assert "CartesianProduct" not in plan(trailing_period(df, "t", 90))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.one_of(st.integers(-50, 50).map(float), st.floats(-1e9, 1e9))),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([1, 3, 1000]),
)
def test_quantiles_equal_numpy(spark, data, slice_values):
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: (r["q_0"], r["q_1"], r["q_2"]) for r in exact_quantiles(df, "g", "x", (0.0, 0.25, 0.9), slice_values, bins=4).collect()}
    for g in {g for g, _ in data}:
        values = np.array([x for h, x in data if h == g])
        assert got[g] == pytest.approx(tuple(np.quantile(values, [0.0, 0.25, 0.9])), rel=1e-9, abs=1e-6)


def test_quantiles_of_a_heavy_group_with_an_outlier(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "small").otherwise("big").alias("g"),
        F.when(F.col("id") == 1, 1e15).otherwise((F.col("id") * 7919 % 10007).cast("double")).alias("x"),
    )
    row = {r["g"]: r for r in exact_quantiles(df, "g", "x", (0.25, 0.75), slice_values=50, bins=16).collect()}
    for g in ("small", "big"):
        values = [r["x"] for r in df.filter(F.col("g") == g).collect()]
        assert (row[g]["q_0"], row[g]["q_1"]) == pytest.approx(tuple(np.quantile(values, [0.25, 0.75])))


def test_quantiles_narrow_down_beside_infinite_values(spark):
    ends = {0: float("inf"), 1: float("-inf"), 2: float("nan")}
    values = [ends.get(i % 20, float(i * 7919 % 10007)) for i in range(4000)]
    df = spark.createDataFrame([("a", x) for x in values] + [("b", float("inf")), ("c", float("nan"))], "g string, x double")
    row = {r["g"]: r for r in exact_quantiles(df, "g", "x", (0.0, 0.3, 0.5, 0.92, 1.0), slice_values=50, bins=16).collect()}
    ranked = sorted(values, key=lambda x: (x != x, x))
    at = lambda p: np.interp(p * 3999, range(3800), ranked[:3800])
    assert (row["a"]["q_0"], row["a"]["q_3"]) == (float("-inf"), float("inf"))
    assert (row["a"]["q_1"], row["a"]["q_2"]) == pytest.approx((at(0.3), at(0.5)))
    assert row["a"]["q_4"] != row["a"]["q_4"] and row["c"]["q_0"] != row["c"]["q_0"]
    assert row["b"]["q_2"] == float("inf")


def test_iqr_outliers_are_strictly_above_the_limit(spark):
    data = [("a", float(x)) for x in (1, 2, 3, 4, 7, 8)] + [("b", 5.0)]
    df = spark.createDataFrame(data, "g string, x double")
    # a: q1 = 2.25, q3 = 6.25, limit = 12.25
    out = iqr_upper_outliers(df.unionByName(spark.createDataFrame([("a", 100.0)], "g string, x double")), "g", "x", 1.5, "m")
    assert [r["x"] for r in out.collect()] == [100.0]


def test_sigma_is_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    row = with_sigma_limits(df, "x", 1.5).orderBy(F.desc("x")).first()
    assert row["sigma"] == pytest.approx(np.std([1, 2, 3, 10]))
    assert row["above"] is True


def brute_sliding(events, seconds):
    peaks = {}
    for actor in {a for a, _ in events}:
        times = sorted(t for a, t in events if a == actor)
        peaks[actor] = max(sum(1 for u in times if t - seconds < u <= t) for t in times)
    return peaks


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60)), min_size=1, max_size=40))
def test_sliding_bursts_cross_block_edges(spark, events):
    df = spark.createDataFrame([(a, NOW + timedelta(seconds=s)) for a, s in events], "a string, t timestamp_ntz")
    got = {r["a"]: r["peak"] for r in sliding_bursts(df, "a", "t", 5, 0, block_seconds=7).collect()}
    assert got == brute_sliding(events, 5)


def test_fixed_bursts_split_at_the_bucket_edge(spark):
    times = [NOW + timedelta(seconds=s) for s in (298, 299, 300, 301)]
    df = spark.createDataFrame([("a", t) for t in times], "a string, t timestamp_ntz")
    assert fixed_bursts(df, "a", "t", 300, 2).count() == 0
    assert sliding_bursts(df, "a", "t", 300, 2).first()["peak"] == 4


def test_asof_takes_the_latest_value_at_or_before(spark):
    days = [NOW.date() + timedelta(days=d) for d in range(0, 400)]
    rates = [("x", days[3], 1.5), ("x", days[40], 2.5), ("x", days[300], 3.5), ("y", days[10], 9.0)]
    facts = spark.createDataFrame(rates, "c string, d date, r double")
    asked = [(k, d) for d in days[::7] for k in ("x", "y", "z")] * 2
    left = spark.createDataFrame(asked, "c string, day date")
    got = {(r["c"], r["day"]): r["r"] for r in asof_join(left, facts, "c", "day", "d", "r", ranges=5).collect()}
    for k, d in asked:
        known = [(t, v) for c, t, v in rates if c == k and t <= d]
        assert got[k, d] == (max(known)[1] if known else None)
    assert asof_join(left, facts, "c", "day", "d", "r").count() == len(asked)


def test_asof_compares_exact_times_and_takes_the_greatest_of_tied_facts(spark):
    at = lambda seconds: NOW + timedelta(seconds=seconds)
    points = spark.createDataFrame([("a", at(10.1)), ("a", at(10.9)), ("a", at(-1)), (None, at(11))], "k string, t timestamp_ntz")
    facts = [("a", at(0), 1.0), ("a", at(10.9), 7.0), ("a", at(10.9), 9.0), ("a", at(10.5), 3.0), (None, at(5), 4.0)]
    for seed in range(3):
        shuffled = spark.createDataFrame(random.Random(seed).sample(facts, len(facts)), "k string, f timestamp_ntz, v double")
        got = asof_join(points, shuffled, "k", "t", "f", "v")
        assert {r["t"]: r["v"] for r in got.filter("k is not null").collect()} == {at(10.1): 1.0, at(10.9): 9.0, at(-1): None}


def test_quantiles_of_infinite_values_and_of_the_null_group(spark):
    inf = float("inf")
    data = [(None, 1.0), (None, 2.0), (None, 3.0), (None, 100.0), ("a", 1.0), ("a", 2.0), ("a", inf), ("b", inf)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r["g"]: (r["q_0"], r["q_1"]) for r in exact_quantiles(df, "g", "x", (0.5, 1.0)).collect()}
    assert got == {None: (2.5, 100.0), "a": (2.0, inf), "b": (inf, inf)}
    assert [tuple(r)[:2] for r in iqr_upper_outliers(df.filter("g is null"), "g", "x", 1.5, "m").collect()] == [(None, 100.0)]
