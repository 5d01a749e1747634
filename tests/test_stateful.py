"""Stateful streams against their batch twins, over several micro-batches, out of order and after a restart."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators.bursts import sliding_bursts
from kerbside.operators.dedup import latest_per_key
from kerbside.sources.facts import FactTable
from kerbside.streaming.stateful import peaks, stream_newest, stream_searches_of_sessions, stream_sliding_peaks

NOW = datetime(2024, 1, 1, 9, 50)


def land(spark, data, schema, folder, number):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/slice={number}")


def test_sliding_peaks_equal_the_batch_and_old_blocks_go(spark, tmp_path):
    rng, schema = random.Random(2), "session_id string, searched_at timestamp_ntz"
    times = sorted(NOW + timedelta(seconds=rng.choice([rng.randrange(40), rng.randrange(20_000)])) for _ in range(500))
    data = [(rng.choice(["hot", "hot", "a", "b", None]), t) for t in times]
    fact = FactTable(spark, str(tmp_path / "fact"), "burst_key", "block_start", "day")
    for number in range(4):
        part = data[number * 125 : number * 125 + 125]
        rng.shuffle(part)
        land(spark, part, schema, tmp_path / "in", number)
        arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
        query = stream_sliding_peaks(arrivals, fact, str(tmp_path / "c"), seconds=300, threshold=2, delay="10 minutes", block_seconds=900)
        query.awaitTermination()
    batch = sliding_bursts(spark.createDataFrame(data, schema).filter("session_id is not null"), "session_id", "searched_at", 300, 2)
    assert sorted(map(tuple, peaks(fact.read()).collect())) == sorted(map(tuple, batch.select("session_id", "peak").collect()))
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] < 500
    assert fact.loads().count() <= 8


def stateful_operators(query):
    return {o["operatorName"] for o in query.lastProgress["stateOperators"]}


def test_sliding_peaks_of_a_busy_block_are_counted_by_built_in_aggregates(spark, tmp_path):
    rng, schema = random.Random(5), "session_id string, searched_at timestamp_ntz"
    data = [("hot", NOW + timedelta(seconds=rng.randrange(130))) for _ in range(6000)] + [(f"s{i}", NOW) for i in range(500)] + [("no time", None)]
    rng.shuffle(data)
    fact = FactTable(spark, str(tmp_path / "fact"), "burst_key", "block_start", "day")
    for number in range(3):  # every second of the blocks is held more than once, in each arrival
        land(spark, data[number::3], schema, tmp_path / "in", number)
        arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
        query = stream_sliding_peaks(arrivals, fact, str(tmp_path / "c"), seconds=20, threshold=2, block_seconds=60)
        query.awaitTermination()
    batch = sliding_bursts(spark.createDataFrame(data, schema).filter("searched_at is not null"), "session_id", "searched_at", 20, 2)
    assert sorted(map(tuple, peaks(fact.read()).collect())) == sorted(map(tuple, batch.select("session_id", "peak").collect()))
    assert stateful_operators(query) == {"stateStoreSave"}  # no Python call for each session and block
    before = fact.loads().collect()
    land(spark, [("s1", NOW + timedelta(seconds=1))], schema, tmp_path / "in", 9)  # no peak grows
    arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
    stream_sliding_peaks(arrivals, fact, str(tmp_path / "c"), seconds=20, threshold=2, block_seconds=60).awaitTermination()
    assert fact.loads().collect() == before


@pytest.mark.parametrize("per_batch", [1, 3])
def test_newest_versions_equal_the_batch(spark, tmp_path, per_batch):
    rng, schema = random.Random(per_batch), "id string, ts timestamp_ntz, v int, note string"
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month")
    data = [(f"k{rng.randrange(12)}", NOW + timedelta(days=rng.randrange(9)), rng.choice([None, 1, 2, 3]), rng.choice([None, "x", "y"])) for _ in range(90)]
    for number in range(6):
        land(spark, data[number * 15 : number * 15 + 15], schema, tmp_path / "in", number)
        if number in (2, 5):  # the query stops in between and goes on from its checkpoint
            arrivals = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(str(tmp_path / "in" / "slice=*"))
            stream_newest(arrivals, fact, str(tmp_path / "c"), delay="365 days").awaitTermination()
    want = latest_per_key(spark.createDataFrame(data, schema), "id", "ts")
    assert sorted(map(str, fact.read().collect())) == sorted(map(str, want.collect()))
    before = fact.version()
    land(spark, data[:20], schema, tmp_path / "in", 9)  # copies and older versions end in the state
    arrivals = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
    stream_newest(arrivals, fact, str(tmp_path / "c"), delay="365 days").awaitTermination()
    assert fact.changes(before).count() == 0


def test_newest_versions_across_periods_without_a_python_call_for_each_key(spark, tmp_path):
    schema = "id string, ts timestamp_ntz, v double"
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month")
    at = lambda days: NOW + timedelta(days=days)
    arrivals = [
        [("a", at(50), 1.0), ("a", at(5), 2.0), ("b", at(0), None), ("b", at(0), float("nan")), ("c", None, 3.0), (None, at(1), 4.0)],
        [("a", at(49), 9.0), ("a", at(1), 9.0), ("b", at(0), 0.5), ("c", at(2), 1.0), ("d", at(3), float("nan"))],
        [("a", at(50), 1.0), ("b", at(0), None), ("c", None, 7.0), ("d", at(3), None)],  # nothing new
    ]
    operators = set()
    for number, rows in enumerate(arrivals):
        land(spark, rows, schema, tmp_path / "in", number)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
        query = stream_newest(stream, fact, str(tmp_path / "c"), delay="365 days")
        query.awaitTermination()
        operators |= stateful_operators(query)
    want = [("a", at(50), 1.0), ("b", at(0), 0.5), ("c", at(2), 1.0), ("d", at(3), None)]
    assert sorted(map(tuple, fact.read().collect())) == want
    assert operators == {"stateStoreSave"}


def test_newest_versions_leave_the_state_and_copies_cost_nothing(spark, tmp_path):
    schema = "id string, ts timestamp_ntz, v int"
    fact = FactTable(spark, str(tmp_path / "fact"), "id", "ts", "month")

    def arrive(number, rows):
        land(spark, rows, schema, tmp_path / "in", number)
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "slice=*"))
        query = stream_newest(stream, fact, str(tmp_path / "c"), delay="1 day", keep_days=3)
        query.awaitTermination()
        return query.lastProgress["stateOperators"][0]["numRowsTotal"], fact.loads().collect()

    held, loads = arrive(0, [(f"k{i}", NOW, i) for i in range(50)])
    assert held == 50
    assert arrive(1, [(f"k{i}", NOW, i) for i in range(50)] + [("k1", NOW, 0)]) == (50, loads)
    assert arrive(2, [("later", NOW + timedelta(days=30), 1)])[0] <= 1
    assert fact.read().count() == 51


def test_searches_wait_for_sessions_that_arrive_later(spark, tmp_path):
    made, begun = "search_id string, session_id string, searched_at timestamp_ntz", "session_id string, started_at timestamp_ntz, is_bot boolean"
    at = lambda minutes: NOW + timedelta(minutes=minutes)
    searches = [[("q1", "s1", at(1)), ("q2", "late", at(2)), ("q3", "bot", at(3)), ("q4", "none", at(4))], [("q1", "s1", at(5)), ("q5", "s1", at(60 * 30))]]
    sessions = [[("s1", at(0), False), ("s1", at(0), False), ("bot", at(0), True)], [("late", at(1), False), ("none", at(1), None)]]
    fact = FactTable(spark, str(tmp_path / "fact"), "search_id", "searched_at", "month")
    for number in range(2):
        land(spark, searches[number], made, tmp_path / "q", number)
        land(spark, sessions[number], begun, tmp_path / "s", number)
        left, right = (spark.readStream.schema(s).parquet(str(tmp_path / f / "slice=*")) for s, f in ((made, "q"), (begun, "s")))
        newest = lambda rows: latest_per_key(rows, "search_id", "searched_at")
        stream_searches_of_sessions(left, right, fact, str(tmp_path / "c"), newest, delay="2 days", longest="1 day").awaitTermination()
    got = sorted((r["search_id"], r["searched_at"]) for r in fact.read().collect())
    assert got == [("q1", at(5)), ("q2", at(2))]  # q5 lies more than a day after its session began
    assert fact.read().filter(F.col("session_id") == "bot").count() == 0
