"""Results added up over loads: distinct counts by bitmaps, quantile summaries, states of checks."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_models import frame, models

from kerbside.operators.distinct import distinct_counts, key_bitmaps, numbered
from kerbside.operators.sketches import rank_distance, rank_error, sketched_quantiles, value_sketches
from kerbside.plans import anomalies, metrics, quality
from kerbside.plans.check_states import CheckStates

ROWS = "key string, day int, place string"


def test_numbers_have_no_gaps_and_follow_the_first_day(spark):
    rows = [(f"k{i % 70}", 100 - i, "a") for i in range(300)] + [(None, 1, "a")]
    got = numbered(spark.createDataFrame(rows, ROWS).repartition(5), "key", "day")
    by_key = {r["_key"]: r["_number"] for r in got.collect()}
    assert sorted(by_key.values()) == list(range(1, 71))
    first = {k: min(d for key, d, _ in rows if key == k) for k in by_key}
    assert [k for k, _ in sorted(by_key.items(), key=lambda x: x[1])] == sorted(first, key=lambda k: (first[k], k))


def test_later_loads_keep_numbers_and_add_new_keys_behind(spark):
    old = numbered(spark.createDataFrame([("a", 5, ""), ("b", 4, "")], ROWS), "key", "day")
    new = numbered(spark.createDataFrame([("b", 1, ""), ("c", 1, ""), ("d", 0, ""), ("c", 9, "")], ROWS), "key", "day", old)
    assert {r["_key"]: r["_number"] for r in new.collect()} == {"b": 1, "a": 2, "d": 3, "c": 4}
    again = numbered(spark.createDataFrame([("a", 1, "")], ROWS), "key", "day", new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_counts_roll_up_to_any_group_over_loads(spark):
    random.seed(3)
    rows = [(f"k{random.randrange(90_000)}", random.randrange(6), random.choice("xyz")) for _ in range(120_000)]
    rows += [("hot", d % 6, "x") for d in range(60_000)] + [(None, 2, "x"), ("k1", None, None)]
    df = spark.createDataFrame(rows, ROWS)
    numbers, loads = None, []
    for part in (df.filter("day < 2"), df.filter("day >= 2 OR day IS NULL"), df.filter("day = 5")):  # the last one is a replay
        numbers = numbered(part, "key", "day", numbers)
        loads.append(key_bitmaps(part, ["place", "day"], "key", numbers))
    bitmaps = loads[0].unionByName(loads[1]).unionByName(loads[2])
    for by in (["place"], ["day"], ["place", "day"], []):
        want = defaultdict(set)
        for key, day, place in rows:
            if key is not None:
                want[tuple({"place": place, "day": day}[c] for c in by)].add(key)
        got = {tuple(r)[:-1]: r["keys"] for r in distinct_counts(bitmaps, by).collect()}
        assert got == {k: len(v) for k, v in want.items()}
    assert distinct_counts(key_bitmaps(df.limit(0), ["day"], "key", numbers), ["day"]).count() == 0


def test_funnel_from_bitmaps_equals_the_funnel(spark):
    m = models(
        spark,
        sessions=[{}, {"session_id": "s2", "country": None}, {"session_id": "s3"}],
        searches=[{}, {"search_id": "q2", "searched_at": "2024-01-07 10:01:00"}, {"search_id": "q3", "session_id": "s2"}, {"search_id": "q4", "session_id": "lost"}],
        bookings=[{}, {"booking_id": "b2", "session_id": "s3"}, {"booking_id": "b3", "session_id": None}],
    )
    inputs = [m[n] for n in ("int_sessions", "int_searches", "fct_bookings", "int_cancellations")]
    activity = metrics.funnel_activity(*inputs)
    bitmaps = key_bitmaps(activity, metrics.FUNNEL_GROUPS, "session_id", numbered(activity, "session_id", "dia"))
    plain = [tuple(r) for r in metrics.funnel_by_segment(*inputs).collect()]
    assert [tuple(r) for r in metrics.funnel_from_bitmaps(bitmaps).collect()] == plain and len(plain) == 2


VALUES = "g string, load int, x double"


def test_merged_summaries_stay_within_the_stated_rank_error(spark):
    random.seed(8)
    rows = [("a", i % 40, random.lognormvariate(0, 2)) for i in range(60_000)]
    rows += [("b", i % 3, float(i % 4)) for i in range(900)] + [("c", 0, 7.0), ("c", 1, None), ("d", 0, None), (None, 1, 2.0), ("a", 1, float("nan"))]
    df, probs = spark.createDataFrame(rows, VALUES), (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    got = sketched_quantiles(value_sketches(df, ["g", "load"], "x"), ["g"], probs)
    far = {r["g"]: tuple(r)[1:] for r in rank_distance(df, "g", "x", got, probs).collect()}
    assert {g: v[0] for g, v in far.items()} == {"a": 60_000, "b": 900, "c": 1, None: 1}
    assert max(max(v[1:]) for v in far.values()) <= 3 * rank_error()
    assert {r["g"]: r["n"] for r in got.collect()} == {g: v[0] for g, v in far.items()}
    assert rank_error(800) < 0.0035 and rank_error(200) < 0.0134


def test_a_summary_does_not_grow_with_its_rows(spark):
    sizes = [value_sketches(spark.range(n).withColumn("g", F.lit(1)), ["g"], "id").select(F.length("sketch")).first()[0] for n in (20_000, 400_000)]
    assert sizes[1] < 1.5 * sizes[0] < 60_000


def test_outliers_by_summarised_quartiles(spark):
    bookings = frame(spark, "bookings", *[{"booking_id": f"b{i}", "total_amount": float(100 + i % 10)} for i in range(200)], {"booking_id": "far", "total_amount": 900.0})
    m = models(spark)
    m._raw["bookings"] = bookings
    base = anomalies.amounts_by_category(m["int_bookings"])
    quartiles = sketched_quantiles(value_sketches(base, ["car_category"], "total_amount"), ["car_category"], (0.25, 0.75))
    assert [r["booking_id"] for r in anomalies.amount_outliers(m["int_bookings"], quartiles=quartiles).collect()] == ["far"]


CHECKS = (
    quality.Check("child", "not_null", "id"),
    quality.Check("child", "unique", "id"),
    quality.Check("child", "relationships", "parent", quality.WARN, parent="parents", parent_column="id"),
    quality.Check("child", "between", "x", low=0, where="x IS NOT NULL"),
    quality.Check("parents", "unique", "id"),
    quality.Check("parents", "accepted_values", "kind", values=("k",)),
)
CHILD, PARENT = "id string, parent string, x double", "id string, kind string"
LOADS = {
    "2024-01/a": ([("1", "p", 1.0), ("2", "late", -1.0), (None, None, None)], [("p", "k")]),
    "2024-02": ([("1", "p", None), ("3", "never", 2.0)], [("late", "k"), ("p", "other")]),
    "2024-03": ([], [("q", None)]),
}


def load_tables(spark, *names):
    child, parents = ([r for n in names for r in LOADS[n][i]] for i in (0, 1))
    return {"child": spark.createDataFrame(child, CHILD), "parents": spark.createDataFrame(parents, PARENT)}


def results(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def states(spark, tmp_path):
    return CheckStates(spark, str(tmp_path), CHECKS)


def test_states_of_loads_add_up_to_one_run_over_all_rows(spark, states):
    assert results(states.results()) == results(quality.run_checks(load_tables(spark), CHECKS))
    for name in LOADS:
        states.judge(name, load_tables(spark, name))
    whole = results(quality.run_checks(load_tables(spark, *LOADS), CHECKS))
    assert results(states.results()) == whole and len(states.loads()) == 3
    unique = [r for r in states.results().collect() if r["check"] == "unique"]
    assert [r["failing_values"] for r in unique] == [1, 1]  # "1" and "p", each once in either load
    states.judge("2024-02", load_tables(spark, "2024-02"))  # a replay
    assert results(states.results()) == whole


def test_a_changed_load_replaces_its_state(spark, states):
    for name in LOADS:
        states.judge(name, load_tables(spark, name))
    states.judge("2024-01/a", load_tables(spark, "2024-03"))
    assert results(states.results()) == results(quality.run_checks(load_tables(spark, "2024-03", "2024-02", "2024-03"), CHECKS))


def test_tables_without_new_rows_may_be_left_out(spark, states):
    states.judge("a", load_tables(spark, "2024-01/a"))
    states.judge("b", {"parents": load_tables(spark, "2024-02")["parents"]})
    states.judge("c", {})
    both = {"child": load_tables(spark, "2024-01/a")["child"], "parents": load_tables(spark, "2024-01/a", "2024-02")["parents"]}
    assert results(states.results()) == results(quality.run_checks(both, CHECKS))
    assert states.loads() == ["a", "b"]


def test_another_suite_has_states_of_its_own(spark, states, tmp_path):
    states.judge("a", load_tables(spark, "2024-01/a"))
    assert CheckStates(spark, str(tmp_path), CHECKS[:2]).loads() == []
    assert CheckStates(spark, str(tmp_path), CHECKS).loads() == ["a"]
