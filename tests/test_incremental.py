"""Incremental fact loads: every consequence of the high-water mark, and recovery."""

from datetime import datetime

import pytest
from pyspark.sql import Row

from kerbside.operators.bloom import groups_holding
from kerbside.operators.dedup import latest_per_key
from kerbside.sources import facts
from kerbside.sources.facts import FactTable
from kerbside.streaming.jobs import bursts_from_counts, stream_burst_counts, stream_into_fact

SCHEMA = "id string, ts timestamp_ntz, v int"


def day(n):
    return datetime(2024, 1, 1 + n) if n < 31 else datetime(2024, 2, n - 30)


def rows(spark, *data):
    return spark.createDataFrame([(i, None if d is None else day(d), v) for i, d, v in data], SCHEMA)


def content(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


@pytest.fixture(params=["day", "month"])
def fact(spark, tmp_path, request):
    return FactTable(spark, str(tmp_path / "fact"), "id", "ts", request.param)


def test_first_load_takes_all_and_later_loads_go_above_the_mark(spark, fact):
    assert not fact.exists()
    assert content(fact.load(rows(spark, ("a", 1, 1), ("b", 5, 1), ("n", None, 1)))) == [("a", 1), ("b", 1), ("n", 1)]
    assert fact.high_water_mark() == day(5)
    later = rows(spark, ("late", 3, 2), ("equal", 5, 2), ("new", 6, 2), ("a", 40, 2), ("n", None, 3))
    assert content(fact.load(later)) == [("a", 2), ("b", 1), ("n", 1), ("new", 2)]
    assert content(fact.load(later)) == [("a", 2), ("b", 1), ("n", 1), ("new", 2)]


def test_an_update_below_the_mark_is_not_applied_and_absent_rows_stay(spark, fact):
    fact.load(rows(spark, ("a", 1, 1), ("b", 5, 1)))
    assert content(fact.load(rows(spark, ("a", 2, 9)))) == [("a", 1), ("b", 1)]


def test_lookback_admits_late_rows(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", lookback="3 days")
    fact.load(rows(spark, ("a", 1, 1), ("b", 10, 1)))
    staged = rows(spark, ("late", 8, 2), ("too late", 6, 2))
    assert content(fact.load(fact.pending(staged))) == [("a", 1), ("b", 1), ("late", 2)]


def test_lookback_keeps_the_newer_version(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", lookback="30 days")
    fact.load(rows(spark, ("a", 10, 1), ("b", 5, 1)))
    assert content(fact.load(rows(spark, ("a", 9, 2), ("b", 5, 3)))) == [("a", 1), ("b", 3)]


def test_an_empty_table_takes_everything_unless_told(spark, fact):
    fact.load(rows(spark, ("a", 1, 1)).limit(0))
    assert fact.exists() and fact.high_water_mark() is None
    assert fact.load(rows(spark, ("a", 1, 1)), empty_target="block").count() == 0
    assert content(fact.load(rows(spark, ("a", 1, 1)))) == [("a", 1)]


def test_a_taken_commit_number_fails(spark, fact):
    fact.load(rows(spark, ("a", 1, 1)))
    state = fact._newest()
    fact.load(rows(spark, ("b", 2, 1)))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        fact._commit(state, state["folders"], rows(spark).schema)
    assert content(fact.read()) == [("a", 1), ("b", 1)]


def test_only_folders_whose_keys_meet_the_arrivals_are_searched(spark, tmp_path, monkeypatch):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "day")
    for n in range(5):
        fact.load(rows(spark, (f"k{n}0", n + 1, 1), (f"k{n}9", n + 1, 1)))
    searched = []
    find = FactTable._periods_with
    monkeypatch.setattr(FactTable, "_periods_with", lambda self, folders, *rest: searched.extend(folders) or find(self, folders, *rest))
    fact.load(rows(spark, ("k35", 20, 2), ("k30", 21, 2)))
    assert [f["period"] for f in searched] == ["2024-01-05"]
    assert fact.read().filter("id = 'k30'").first()["v"] == 2


def test_folders_of_a_period_are_compacted(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month", most_folders=3)
    for n in range(8):
        fact.load(rows(spark, (f"k{n}", n + 1, n)))
    assert fact.loads().count() <= 3
    assert content(fact.read()) == [(f"k{n}", n) for n in range(8)]


def test_compaction_rewrites_a_row_a_few_times_only(spark, fact, monkeypatch):
    folder = lambda load, keys: Row(period="2024-01", load=load, buckets=keys)
    written = []

    def write(folders, load):
        written.append(sum(f["buckets"] for f in folders))
        return [folder(load, written[-1])]

    monkeypatch.setattr(fact, "_rows", lambda folders, schema: folders)
    monkeypatch.setattr(fact, "_write", write)
    folders = []
    for n in range(400):
        folders = fact._compacted([*folders, folder(f"new-{n}", 16)], f"compact-{n}", None)
        assert len(folders) <= fact.most_folders
    assert sum(f["buckets"] for f in folders) == 400 * 16
    assert sum(written) < 6 * 400 * 16  # all folders each time: 29 times


def test_many_arriving_keys_search_folders_without_filters(spark, fact, monkeypatch):
    asked = []
    monkeypatch.setattr(facts, "groups_holding", lambda *args: asked.append(1) or groups_holding(*args))
    fact.load(rows(spark, *[(f"k{n}", n % 5 + 1, n) for n in range(50)]))
    monkeypatch.setattr(facts, "KEYS_PER_ROW", 20, raising=False)
    fact.merge(rows(spark, ("k7", 9, 70)), "s", 0)
    assert len(asked) == 1
    fact.merge(rows(spark, *[(f"k{n}", 9, n + 100) for n in range(40)]), "s", 1)
    assert len(asked) == 1
    assert content(fact.read()) == sorted([(f"k{n}", n + 100) for n in range(40)] + [(f"k{n}", n) for n in range(40, 50)])


@pytest.mark.parametrize("per_batch", [1, 2])
def test_stream_takes_files_out_of_time_order(spark, tmp_path, per_batch):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month")
    for number, data in enumerate([[("a", 9, 2), ("b", 8, 1)], [("a", 1, 1), ("c", 2, 1)], [("c", 3, 2)]]):
        rows(spark, *data).coalesce(1).write.parquet(str(tmp_path / "in" / f"slice={number}"))
    arrivals = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch).parquet(str(tmp_path / "in" / "slice=*"))
    stream_into_fact(arrivals, fact, lambda batch: latest_per_key(batch, "id", "ts"), str(tmp_path / "checkpoint")).awaitTermination()
    assert content(fact.read()) == [("a", 2), ("b", 1), ("c", 2)]


def test_a_replayed_batch_changes_nothing(spark, fact):
    fact.merge(rows(spark, ("a", 5, 1)), "s", 0)
    fact.merge(rows(spark, ("a", 5, 2)), "s", 1)
    before = fact._newest()["commit"]
    assert content(fact.merge(rows(spark, ("a", 5, 1)), "s", 0)) == [("a", 2)]
    assert fact._newest()["commit"] == before
    assert content(fact.merge(rows(spark, ("a", 5, 7)), "other", 0)) == [("a", 7)]


def test_full_refresh_replaces_everything(spark, fact):
    fact.load(rows(spark, ("a", 1, 1)))
    assert content(fact.load(rows(spark, ("b", 1, 1)), full_refresh=True)) == [("b", 1)]


def test_a_load_that_dies_before_its_commit_leaves_the_table_alone(spark, fact, monkeypatch):
    fact.load(rows(spark, ("a", 1, 1)))
    with monkeypatch.context() as m:
        m.setattr(FactTable, "_commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            fact.load(rows(spark, ("a", 5, 2), ("b", 6, 2)))
    assert content(fact.read()) == [("a", 1)]
    assert content(fact.load(rows(spark, ("a", 5, 2), ("b", 6, 2)))) == [("a", 2), ("b", 2)]


def test_only_periods_that_lose_a_row_are_rewritten(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "day")
    fact.load(rows(spark, ("a", 1, 1), ("b", 2, 1), ("c", 3, 1)))
    before = {f["period"]: f["load"] for f in fact._newest()["folders"]}
    fact.load(rows(spark, ("b", 4, 2)))
    after = {f["period"]: f["load"] for f in fact._newest()["folders"]}
    assert after["2024-01-02"] == before["2024-01-02"] and after["2024-01-04"] == before["2024-01-04"]
    assert "2024-01-03" not in after and "2024-01-05" in after
    assert content(fact.read(since="2024-01-04")) == [("b", 2), ("c", 1)]
    assert {r["period"] for r in fact.loads().collect()} == set(after)


def test_cutting_before_the_dedup_gives_the_same_load(spark, tmp_path):
    first = [("a", 1, 1), ("b", 5, 1), ("c", 5, 1)]
    second = [("a", 2, 2), ("a", 7, 3), ("a", 6, 9), ("b", 5, 8), ("d", 8, 1), ("d", 3, 7), ("e", 4, 1)]
    results = []
    for name, cut in (("before", True), ("after", False)):
        fact = FactTable(spark, str(tmp_path / name), "id", "ts", "month")
        fact.load(rows(spark, *first))
        staged = rows(spark, *second)
        results.append(content(fact.load(latest_per_key(fact.pending(staged) if cut else staged, "id", "ts"))))
    assert results[0] == results[1] == [("a", 3), ("b", 1), ("c", 1), ("d", 1)]


def test_stream_resumes_and_equals_batch(spark, tmp_path):
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month")
    for number, data in enumerate([[("a", 1, 1), ("b", 5, 1)], [("a", 7, 2), ("c", 6, 1), ("late", 2, 1)]]):
        rows(spark, *data).write.parquet(str(tmp_path / "in" / f"slice={number}"))
        arrivals = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in" / "slice=*"))
        stream_into_fact(arrivals, fact, lambda batch: batch, str(tmp_path / "checkpoint")).awaitTermination()
    assert content(fact.read()) == [("a", 2), ("b", 1), ("c", 1), ("late", 1)]


def test_stream_counts_equal_batch_counts_over_several_micro_batches(spark, tmp_path):
    schema = "session_id string, searched_at timestamp_ntz"
    for number, minutes in enumerate([(0, 1, 2), (3, 4, 6), (7, 8)]):
        data = [("s", datetime(2024, 1, 1, 10, m)) for m in minutes]
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"n={number}"))
        arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "n=*"))
        stream_burst_counts(arrivals, str(tmp_path / "checkpoint"), str(tmp_path / "out")).awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "out"))
    assert [tuple(r) for r in bursts_from_counts(counts, 4).collect()] == [("s", 5)]
    assert bursts_from_counts(counts, 5).count() == 0


def test_sliding_stream_catches_a_burst_across_an_edge(spark, tmp_path):
    schema = "session_id string, searched_at timestamp_ntz"
    data = [("s", datetime(2024, 1, 1, 10, m)) for m in (3, 4, 5, 6)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in"))
    arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    stream_burst_counts(arrivals, str(tmp_path / "c"), str(tmp_path / "out"), slide_seconds=60).awaitTermination()
    assert [tuple(r) for r in bursts_from_counts(spark.read.parquet(str(tmp_path / "out")), 3).collect()] == [("s", 4)]
