"""Task states in a state store: versions, timers, late rows, restarts."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from medloom.sinks.keyed import KeyedTable
from medloom.streaming import task_state

KIND = "name string, state smallint, timestamp timestamp, version bigint"
T0 = datetime(2024, 1, 1)
QUEUED, RUNNING, DONE, FAILED = 0, 1, 2, 3


def at(hours, us=0):
    return T0 + timedelta(hours=hours, microseconds=us)


def put(spark, folder, rows):
    spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, tmp_path, **options):
    """One run to the end of what is there; the table after it."""
    events = task_state.event_stream(spark, str(tmp_path / "in"), KIND)
    table = f"file://{tmp_path}/out"
    task_state.keep_states(events, table, f"file://{tmp_path}/check", buckets=4, **options).awaitTermination()
    return {r["name"]: (r["state"], r["timestamp"], r["version"], r["timed_out"]) for r in KeyedTable(spark, table).read().collect()}


def test_newest_row_of_a_task_counts(spark, tmp_path):
    put(spark, tmp_path / "in", [("a", RUNNING, at(1), 1), ("a", DONE, at(2), 2), ("b", DONE, at(3), 5), ("b", FAILED, at(3), 6), ("c", QUEUED, at(0), 1), ("c", RUNNING, None, 9), (None, DONE, at(9), 1), ("d", RUNNING, at(4, 7), 1)])
    got = run(spark, tmp_path, stuck="1 day")
    assert got == {"a": (DONE, at(2), 2, False), "b": (FAILED, at(3), 6, False), "c": (QUEUED, at(0), 1, False), "d": (RUNNING, at(4, 7), 1, False)}


def test_state_survives_a_restart(spark, tmp_path):
    put(spark, tmp_path / "in", [("a", DONE, at(10), 3), ("b", RUNNING, at(2), 1), ("c", RUNNING, at(9), 1)])
    first = run(spark, tmp_path, stuck="5 hours", late="100 hours")
    assert first["a"] == (DONE, at(10), 3, False) and first["b"][0] == RUNNING
    before = KeyedTable(spark, f"file://{tmp_path}/out").version()
    # an older row of a, which must lose against what only the state store has; news of c before its time is up
    put(spark, tmp_path / "in", [("a", FAILED, at(9), 9), ("c", DONE, at(11), 2), ("z", QUEUED, at(110), 1)])
    second = run(spark, tmp_path, stuck="5 hours", late="100 hours")
    assert second == {"a": (DONE, at(10), 3, False), "b": (QUEUED, at(7), 1, True), "c": (DONE, at(11), 2, False), "z": (QUEUED, at(110), 1, False)}
    after = KeyedTable(spark, f"file://{tmp_path}/out").version()
    mine = spark.createDataFrame([("a",)], "name string").select(KeyedTable(spark, f"file://{tmp_path}/out").bucket(after).alias("b")).first()["b"]
    others = {spark.createDataFrame([(n,)], "name string").select(KeyedTable(spark, f"file://{tmp_path}/out").bucket(after).alias("b")).first()["b"] for n in "bcz"}
    assert mine in others or before.folders[mine] == after.folders[mine]
    assert run(spark, tmp_path, stuck="5 hours", late="100 hours") == second


def test_a_stuck_task_is_queued_again_and_goes_on(spark, tmp_path):
    put(spark, tmp_path / "in", [("a", RUNNING, at(0, 123), 1), ("b", RUNNING, at(19), 1), ("c", DONE, at(20), 1)])
    got = run(spark, tmp_path, stuck="5 hours")
    assert got == {"a": (QUEUED, at(5, 123), 1, True), "b": (RUNNING, at(19), 1, False), "c": (DONE, at(20), 1, False)}
    put(spark, tmp_path / "in", [("a", RUNNING, at(21), 2), ("a", DONE, at(22), 3), ("b", RUNNING, at(23), 2)])
    got = run(spark, tmp_path, stuck="5 hours")
    assert got["a"] == (DONE, at(22), 3, False) and got["b"] == (RUNNING, at(23), 2, False)


@pytest.mark.parametrize("late", ["0 seconds", "3 hours"])
def test_same_as_the_batch(spark, tmp_path, late):
    rows = [(f"t{i % 37}", i * 7 % 5, at(i * 13 % 101, i), i * 31 % 17) for i in range(600)]
    put(spark, tmp_path / "in", rows)
    got = run(spark, tmp_path, stuck="10 hours", late=late)
    want = task_state.batch_states(spark.createDataFrame(rows, KIND), "10 hours", late)
    assert got == {r["name"]: (r["state"], r["timestamp"], r["version"], r["timed_out"]) for r in want.collect()}
    assert any(r[3] for r in got.values()) or late != "0 seconds"


def test_the_session_is_left_as_it_was(spark, tmp_path):
    put(spark, tmp_path / "in", [("a", DONE, at(1), 1)])
    before = spark.conf.get(task_state._PROVIDER, None)
    run(spark, tmp_path)
    assert spark.conf.get(task_state._PROVIDER, None) == before


def test_windows_that_are_over(spark, tmp_path):
    spark.createDataFrame([(at(0, 5), "x"), (at(0, 9), "x"), (at(1), "y"), (at(3), "x")], "ts timestamp, event_type string").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "e"))
    query = task_state.windowed_counts(stream, "30 minutes").writeStream.outputMode("append").format("memory").queryName("hours").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r["start"], r["event_type"], r["n"]) for r in spark.table("hours").select(F.col("start"), "event_type", "n").collect()) == [(at(0), "x", 2), (at(1), "y", 1)]


def test_only_the_newest_row_of_a_name_goes_to_its_task(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(task_state, "HELD", 40)
    rows = [(f"t{i % 7}", i * 7 % 5, at(i * 13 % 11), i * 31 % 17) for i in range(300)]
    batches = [pa.RecordBatch.from_pylist([dict(zip(("name", "state", "timestamp", "version"), r, strict=True)) for r in rows[a : a + 25]]) for a in range(0, 300, 25)]
    out = [r for b in task_state._newest_of_each(batches) for r in b.to_pylist()]
    want = {n: max((r[2], r[3], r[1]) for r in rows if r[0] == n) for n in {r[0] for r in rows}}
    assert {r["name"]: (r["timestamp"], r["version"], r["state"]) for r in out} == want and len(out) == 7
    # names that are all different are handed on before more than HELD are kept, and none is lost
    batches = [pa.RecordBatch.from_pylist([{"name": f"n{i}", "state": 1, "timestamp": at(1), "version": i} for i in range(a, a + 30)]) for a in range(0, 90, 30)]
    out = list(task_state._newest_of_each(iter(batches)))
    assert sorted(r["version"] for b in out for r in b.to_pylist()) == list(range(90)) and sum(map(len, out)) == 90
    assert list(task_state._newest_of_each(iter([]))) == []
