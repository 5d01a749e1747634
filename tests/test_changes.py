"""Key filters, what a load reads, what commits changed, and reports that follow the changes."""

import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.operators.bloom import BITMAPS, KEYS_PER_ROW, buckets_for, groups_holding, key_filters
from kerbside.sources.facts import FactTable
from kerbside.sources.files import names_in
from test_incremental import SCHEMA, content, day, rows


def test_filters_miss_no_key_and_few_absent_ones(spark):
    keys = spark.range(60_000).select(F.when(F.col("id") < 50_000, "big").otherwise("small").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("k"))
    filters = key_filters(keys.unionByName(keys.limit(100)), "k", "g", {"big": 50_000, "small": 10_000})
    sizes = {"big": buckets_for(50_000), "small": buckets_for(10_000)}
    assert sizes == {"big": 4, "small": 1}
    assert {(r["g"], r["count"]) for r in filters.groupBy("g").count().collect()} == set(sizes.items())
    assert all(len(r[f"bits_{i}"]) == 4096 for r in filters.collect() for i in range(BITMAPS))
    found = lambda k: {r["g"] for r in groups_holding(filters, ["g"], list(sizes.values()), k, "k").collect()}
    for group in ("big", "small"):
        some = keys.filter(F.col("g") == group).orderBy("k").limit(5)
        assert all(group in found(some.filter(F.col("k") == r["k"])) for r in some.collect())
    absent = spark.range(2000).select(F.concat(F.lit("absent"), "id").alias("k"))
    asked = absent.withColumn("bucket", F.lit(0))
    let_through = sum(bool(found(asked.filter(F.col("k") == f"absent{i}"))) for i in range(8))
    assert let_through <= 2
    assert found(absent.limit(0)) == set() and found(spark.createDataFrame([(None,)], "k string")) == set()
    assert [buckets_for(n) for n in (0, 1, KEYS_PER_ROW, KEYS_PER_ROW + 1, 5 * KEYS_PER_ROW)] == [1, 1, 1, 2, 8]


def test_a_load_of_random_keys_reads_only_folders_that_hold_one(spark, tmp_path, monkeypatch):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "day")
    ids = [[str(uuid.UUID(int=n * 7919 + i * 104729 << 64 | i)) for i in range(50)] for n in range(6)]
    for n, keys in enumerate(ids):
        fact.load(rows(spark, *[(k, n + 1, 1) for k in keys]))
    searched = []
    find = FactTable._periods_with
    monkeypatch.setattr(FactTable, "_periods_with", lambda self, folders, *rest: searched.extend(folders) or find(self, folders, *rest))
    fact.load(rows(spark, (ids[2][7], 20, 2), ("a new one", 21, 2)))
    assert [f["period"] for f in searched] == ["2024-01-04"]
    searched.clear()
    fact.load(rows(spark, ("another", 22, 2), ("zz", 23, 2)))
    assert len(searched) <= 1
    assert fact.read().count() == 303


def changed(df):
    return sorted((r["id"], r["v"], r["change"], None if r["was"] is None else r["was"].day) for r in df.collect())


@pytest.mark.parametrize("grain", ["day", "month"])
def test_changes_between_commits(spark, tmp_path, grain):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", grain, lookback="90 days")
    assert fact.version() == 0
    fact.load(rows(spark, ("a", 1, 1), ("b", 5, 1), ("c", 6, 1), ("n", None, 1)))
    assert changed(fact.changes(0)) == [("a", 1, "inserted", None), ("b", 1, "inserted", None), ("c", 1, "inserted", None), ("n", 1, "inserted", None)]
    first = fact.version()
    fact.load(rows(spark, ("a", 1, 1), ("b", 7, 2), ("late", 2, 1)))
    fact.load(rows(spark, ("d", 40, 1)))
    assert changed(fact.changes(first)) == [("b", 2, "updated", 6), ("d", 1, "inserted", None), ("late", 1, "inserted", None)]
    assert changed(fact.changes(first, first + 1)) == [("b", 2, "updated", 6), ("late", 1, "inserted", None)]
    assert changed(fact.changes(fact.version())) == []
    before = fact.version()
    fact.load(rows(spark, ("a", 1, 1), ("x", 1, 1)), full_refresh=True)
    assert [(k, kind) for k, _, kind, _ in changed(fact.changes(before))] == [("b", "removed"), ("c", "removed"), ("d", "removed"), ("late", "removed"), ("n", "removed"), ("x", "inserted")]


def test_old_commits_go_with_the_folders_only_they_list(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month", most_folders=2, keep_commits=3)
    for n in range(7):
        fact.load(rows(spark, (f"k{n}", n + 1, n)))
    assert fact._commits() == [5, 6, 7]
    listed = {(f["load"], f["period"]) for n in fact._commits() for f in fact._state(n)["folders"]}
    there = {(load.removeprefix("load="), p.removeprefix("period=")) for load in names_in(spark, f"{fact.root}/data") if load.startswith("load=")
             for p in names_in(spark, f"{fact.root}/data/{load}") if p.startswith("period=")}
    assert listed <= there and len(there) < 14
    assert content(fact.read()) == [(f"k{n}", n) for n in range(7)]
    assert names_in(spark, str(tmp_path / "nowhere")) == []
    assert day(1) == datetime(2024, 1, 2) and SCHEMA
