"""Retries on streams: against SQL, in several orders of arrival, over a restart, and against a plain loop."""

import json
import os
from datetime import datetime, timedelta

import duckdb
import pandas as pd
import pytest

from tidewatch.streaming import notifications, retries

DATA = "/root/testdata/sf0.001"
ZERO = datetime(2024, 1, 1)
SCHEMA = "scene long, start timestamp, ts timestamp, analyser string, ok boolean"
#: scene, age in days at the outcome, analyser, whether it succeeded; scene 9 moves the watermark on.
OUTCOMES = [
    (1, 0.1, "a", True), (1, 0.2, "b", False), (1, 2.4, "b", True),
    (2, 0.5, "a", False), (2, 6.9, "a", True), (2, 8.0, "c", True),
    (3, 6.5, "a", True), (3, 6.0, "b", True),
    (4, 33.0, "a", False),
    (5, 0.0, "a", True), (5, 0.0, "b", True), (5, 0.0, "c", True), (5, 0.5, "c", False),
    (6, 1.5, "a", None), (6, 1.2, "other", True), (6, 1.0, "b", True),
    (9, 60.0, "a", True),
]


def wanted(mark, outcomes=OUTCOMES, analysers="abc"):
    """All retries up to the watermark, in days: a loop over each scene's schedule."""
    out = set()
    for scene in {o[0] for o in outcomes}:
        at = min(o[1] for o in outcomes if o[0] == scene)
        while True:
            at = at + 1 if int(at) < 7 else at + 7 if int(at) < 32 else None
            missing = at and ",".join(a for a in analysers if not any(o[0] == scene and o[2] == a and o[3] and o[1] <= at for o in outcomes))
            if not missing or at > mark:
                break
            out.add((scene, round(at, 6), int(at), missing))
    return out


def write(spark, rows, path):
    moment = lambda d: ZERO + timedelta(seconds=round(d * 86400))
    spark.createDataFrame([(s, ZERO, moment(d), a, ok) for s, d, a, ok in rows], SCHEMA).coalesce(1).write.parquet(path)


def found(rows):
    start = int((ZERO - datetime(1970, 1, 1)).total_seconds() * 1000)
    got = [(r.scene, round((r.at - start) / 86_400_000, 6), r.age_days, r.missing) for r in rows.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
def test_stream_equals_sql(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    got = retries.stream_retries(spark, DATA)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    c = duckdb.connect()
    c.execute(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    want = c.execute(retries.ORACLES["stream_retries"])
    names = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall()) != []


@pytest.mark.parametrize("order", [1, -1])
def test_orders_of_arrival(spark, tmp_path, order):
    """Files of two outcomes each, the newest first or last: what is decided is the same, as the watermark waits 61 days."""
    for i, n in enumerate(range(0, len(OUTCOMES), 2)[::order]):
        write(spark, OUTCOMES[n : n + 2], f"{tmp_path}/in/part={i}")
    write(spark, [(9, 125.0, "a", True)], f"{tmp_path}/in/part=99")
    stream = spark.readStream.schema(f"{SCHEMA}, part int").option("maxFilesPerTrigger", 3).parquet(f"{tmp_path}/in")
    with retries.timers(spark):
        got = found(notifications.drained(retries.retries(stream, list("abc"), "61 days"), "append"))
    assert got == wanted(64, [*OUTCOMES, (9, 125.0, "a", True)])
    assert {g[0] for g in got} == {1, 2, 3, 6}


def test_restart_goes_on(spark, tmp_path):
    """Two runs over one checkpoint, with files that come between them, decide each retry once."""
    stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in/*")
    day = sorted(OUTCOMES, key=lambda o: o[1])
    for i, part in enumerate((day[:9], day[9:])):
        write(spark, part, f"{tmp_path}/in/{i}")
        with retries.timers(spark):
            q = retries.retries(stream, list("abc"), "1 hour").writeStream.outputMode("append").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True)
            q.format("parquet").start(f"{tmp_path}/out").awaitTermination()
    assert found(spark.read.schema(retries.RETRIES).parquet(f"{tmp_path}/out")) == wanted(60 - 1 / 24)


def test_rows_without_scene_or_time_and_empty_streams(spark, tmp_path):
    rows = spark.createDataFrame([(None, ZERO, ZERO, "a", True), (1, None, ZERO, "a", True), (1, ZERO, None, "a", True)], SCHEMA)
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    with retries.timers(spark):
        assert notifications.drained(retries.retries(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"), ["a"], "1 day"), "append").count() == 0


def test_schedule():
    day = retries.DAY
    assert [retries.next_retry(0, a * day) for a in (0, 6, 7, 31, 32)] == [day, 7 * day, 14 * day, 38 * day, None]
    assert retries.next_retry(0, 7 * day - 1) == 8 * day - 1 and retries.next_retry(0, 32 * day - 1) == 39 * day - 1


def test_a_scene_is_one_value_read_and_written_once():
    """Each read or write of state is a message to the JVM: one of each for a call, however many analysers succeed."""
    calls = []

    class Value:
        kept = None

        def exists(self):
            calls.append("exists")
            return self.kept is not None

        def get(self):
            calls.append("get")
            return self.kept

        def update(self, value):
            calls.append("update")
            self.kept = value

    class Handle:
        def getValueState(self, *_):
            return Value()

        def getMapState(self, *_):
            pytest.fail("a map of states is a message for each of its keys")

        def registerTimer(self, at):
            calls.append(at)

    r = retries.Retries(["b", "a", "c"])
    r.init(Handle())
    part = pd.DataFrame({"start": [0, 0, 5], "at": [10, 7, 9], "analyser": ["a", "b", None], "ok": [True, True, True]})
    assert list(r.handleInputRows((1,), iter([part, part[part["analyser"] == "a"].assign(at=3)]), None)) == []
    assert calls == ["get", retries.DAY + 3, "update"] and r.scene.kept[:4] == (0, 3, None, retries.DAY + 3)
    assert json.loads(r.scene.kept[4]) == {"a": 3, "b": 7}
