from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row

from docvec.streaming import life

BEGIN = datetime(2024, 5, 1, tzinfo=timezone.utc)


def at(minutes):
    return BEGIN + timedelta(minutes=minutes)


@pytest.fixture
def stream(spark, tmp_path):
    """Gives rows to a stream, one micro-batch after the other, each run from its checkpoint; returns all it told."""
    schema, told = "file_id string, status string, timestamp timestamp", []

    def give(*batches):
        for rows in batches:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        log = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")

        def take(batch, number):
            told.extend((r["file_id"], r["status"], r["timestamp"].replace(tzinfo=timezone.utc), r["error"]) for r in batch.collect())

        life.run(log, take, f"{tmp_path}/checkpoint", minutes=60).stop()
        return sorted(told, key=lambda r: (r[2], r[0]))

    return give


def test_a_file_that_does_not_end_fails(spark, stream):
    error = "no end within 60 minutes"
    first = stream([("a", "processing", at(0)), ("b", "processing", at(0)), ("a", "processing", at(5)), (None, "x", at(0))], [("b", "completed", at(20))])
    assert first == [("b", "processing", at(0), None), ("a", "processing", at(5), None), ("b", "completed", at(20), None)]
    # The stream stops and goes on; time passes by another file's rows.
    later = stream([("c", "processing", at(70))], [("c", "processing", at(100))])
    assert set(later) - set(first) == {("a", "failed", at(65), error), ("c", "processing", at(70), None), ("c", "processing", at(100), None)}
    # What comes later still counts, and older news does not.
    last = stream([("a", "completed", at(101)), ("c", "pending", at(99))], [("d", "pending", at(300))])
    assert set(last) - set(later) == {("a", "completed", at(101), None), ("d", "pending", at(300), None), ("c", "failed", at(160), error)}
    assert spark.conf.get(life.PROVIDER, None) != life.ROCKS


def test_states_of_a_whole_log(spark):
    rows = [("a", "processing", at(0)), ("b", "processing", at(0)), ("b", "completed", at(9)), ("c", "processing", at(30)), ("d", "processing", at(2)), ("d", "completed", at(2))]
    log = spark.createDataFrame(rows, "file_id string, status string, timestamp timestamp")
    got = {r["file_id"]: (r["status"], r["error"]) for r in life.states(log, at(60), 60).collect()}
    error = "no end within 60 minutes"
    assert got == {"a": ("failed", error), "b": ("completed", None), "c": ("processing", None), "d": ("processing", None)}


def test_a_file_takes_few_exchanges_with_its_state():
    """Each call of a state or timer is an exchange with the JVM."""
    calls, kept = [], []

    class Value:
        def get(self):
            calls.append("get")
            return kept[-1] if kept else None

        def exists(self):
            calls.append("exists")
            return bool(kept)

        def update(self, value):
            calls.append("update")
            kept.append(value)

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, at):
            calls.append(("register", at))

        def deleteTimer(self, at):
            calls.append(("delete", at))

    one = life.FileLife(60, 60)
    one.init(Handle())
    told = list(one.handleInputRows(("a",), iter([Row(at=5, status="processing"), Row(at=7, status="processing")]), None))
    assert [tuple(r) for r in told] == [("a", "processing", 7, None)]
    assert sorted(map(str, calls)) == sorted(map(str, ["get", ("register", 3_600_007), "update"]))
    calls.clear()
    assert list(one.handleInputRows(("a",), iter([Row(at=6, status="completed")]), None)) == [] and calls == ["get"]
    calls.clear()
    list(one.handleInputRows(("a",), iter([Row(at=9, status="completed")]), None))
    assert kept[-1] == ("completed", 9, 3_600_009) and len(calls) == 4


def test_a_state_without_a_time_does_not_count(stream):
    got = stream([("a", "processing", None), ("b", "processing", None), ("b", "processing", at(0))])
    assert got == [("b", "processing", at(0), None)]
