"""Keyed state in a stream against the same over a whole table."""

import datetime

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from siftspark.operators import history
from siftspark.plans.tables import observations
from siftspark.streaming import tracker


@pytest.fixture
def state_store(spark):
    spark.conf.set(*tracker.STATE_STORE)
    yield
    spark.conf.unset(tracker.STATE_STORE[0])


def run(spark, place, schema, out, check, **options):
    stream = tracker.tracked(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(place)), **options)
    query = stream.writeStream.format("parquet").option("path", str(out)).option("checkpointLocation", str(check)).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(tracker.OUT).parquet(str(out))


def test_replay_equals_the_window_query_with_a_restart(spark, tmp_path, state_store):
    rows = observations(spark, DATA).where("entity_id is not null").select("entity_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), "technical_status", F.col("latency").cast("long").alias("latency"))
    parts = [r for r in rows.select(F.ntile(3).over(__import__("pyspark").sql.Window.orderBy("ts", "event_id")).alias("n"), "*").collect()]
    schema = rows.schema
    for n in (1, 2, 3):  # three starts on one checkpoint
        spark.createDataFrame([tuple(r)[1:] for r in parts if r["n"] == n], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = run(spark, tmp_path / "in", schema, tmp_path / "out", tmp_path / "check", late="10000 days")
    want = history.replay_streaks(rows, ["entity_id"], ["ts", "event_id"], F.col("technical_status") == "healthy", "ts")
    columns = ["entity_id", "event_id", "consecutive_successes", "consecutive_failures", F.unix_micros("last_success_at").alias("at")]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(map(tuple, want.select(columns).collect()), key=repr)


def test_timers_and_latencies(spark, tmp_path, state_store):
    schema = "entity_id long, event_id long, ts timestamp, technical_status string, latency long"
    at = lambda h: datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=h)
    batches = [[(1, 1, at(0), "healthy", 5), (2, 2, at(0), "dead", None), (1, 3, at(1), "healthy", 7)], [(2, 4, at(30), "healthy", 9)], [(2, 5, at(31), "healthy", None)], [(1, 6, at(32), "dead", 1)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        got = run(spark, tmp_path / "in", schema, tmp_path / "out", tmp_path / "check", late="1 hour", absent=datetime.timedelta(hours=10))
    rows = {(r["entity_id"], r["event_id"]): (r["technical_status"], r["consecutive_successes"], r["consecutive_failures"], r["latencies"]) for r in got.where("event_id is not null").collect()}
    assert rows[1, 3] == ("healthy", 2, 0, [5, 7]) and rows[2, 4][:3] == ("healthy", 1, 0) and rows[2, 5] == ("healthy", 2, 0, [9])
    missing = {(r["entity_id"], r["ts"], r["consecutive_failures"]) for r in got.where("technical_status = 'missing'").collect()}
    assert missing == {(1, at(11), 1)}  # the other came back before the watermark had passed its timer
    assert rows[1, 6] == ("dead", 0, 2, [5, 7])  # the absence counted as a failure


def test_an_entity_costs_two_calls_to_the_state_store():
    from pyspark.sql import Row

    calls, held = [], {}

    class State:
        def __init__(self, name):
            self.name = name

        def __getattr__(self, call):
            def run(*value):
                calls.append(call)
                if call == "update":
                    held[self.name] = value[0]
                return held.get(self.name)

            return run

    handle = type("Handle", (), {"getValueState": lambda self, name, schema: State(name), "getListState": lambda self, name, schema: State(name)})()
    one = tracker.Tracker()
    one.init(handle)
    rows = [Row(at=2, event_id=2, technical_status="dead", latency=None), Row(at=1, event_id=1, technical_status="healthy", latency=5)]
    got = [tuple(r) for r in one.handleInputRows((7,), iter(rows), None)]
    assert got == [(7, 1, 1, "healthy", 1, 0, 1, [5]), (7, 2, 2, "dead", 0, 1, 1, [5])] and calls == ["get", "update"]
