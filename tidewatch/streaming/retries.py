"""Retries of analysers on a stream of their outcomes, by keyed state and event time timers (T3s, F8).

A scene is tried again one day after its first attempt and daily until it is seven days old, then weekly until it is thirty-two. Each retry asks
for those analysers only that haven't succeeded by then. Decisions are about event times alone and are made when the watermark has passed them, so that
neither the order in which outcomes arrive, as far as the watermark waits for it, nor a restart changes them.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.streaming.notifications import drained, event_stream

DAY = 86_400_000
# Days of age up to which a scene is tried again, and the days until then.
SCHEDULE = ((7, 1), (32, 7))
RETRIES = "scene long, at long, age_days long, missing string"


def next_retry(start: int, at: int) -> int | None:
    """The retry after an attempt, in milliseconds like its arguments; None for scenes that are too old. A scene that starts later has an age below 0."""
    age = (at - start) // DAY
    return next((at + days * DAY for below, days in SCHEDULE if age < below), None)


class Retries(StatefulProcessor):
    """For a scene its start, its first attempt, the time up to which retries are decided, and when each analyser first succeeded: one value, that is
    read once and written once for each call, as each of these is a message."""

    def __init__(self, analysers: list[str]):
        self.analysers = sorted(analysers)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.scene = handle.getValueState("scene", "start long, first long, decided long, timer long, done string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        start, first, decided, timer, done = self.scene.get() or (None, None, None, None, "{}")
        done: dict[str, int] = json.loads(done)
        for part in rows:
            at, ok, low = part["at"].to_numpy(), part["ok"].to_numpy(bool), int(part["start"].to_numpy().min())
            start = low if start is None else min(start, low)
            first = int(at.min()) if first is None else min(first, int(at.min()))
            for a, t in zip(part["analyser"].to_numpy()[ok].tolist(), at[ok].tolist(), strict=True):
                if isinstance(a, str):
                    done[a] = min(t, done.get(a, t))
        if decided is None or decided < first:
            # nothing is decided yet, so that an earlier attempt moves the first retry
            at = next_retry(start, first)
            if timer is not None and timer != at:
                self.handle.deleteTimer(timer)
            if at is not None and timer != at:
                self.handle.registerTimer(at)
            timer = at
        self.scene.update((start, first, decided, timer, json.dumps(done)))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at, now = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        start, first, decided, _, known = self.scene.get()
        done = json.loads(known)
        found, last = [], at
        while at is not None and at <= now:
            missing = [a for a in self.analysers if done.get(a, at + 1) > at]
            if not missing:
                at = None
                break
            found.append((key[0], at, (at - start) // DAY, ",".join(missing)))
            last, at = at, next_retry(start, at)
        # what is known of the scene stays, so that outcomes that come later don't start it anew
        self.scene.update((start, first, last, at, known))
        if at is not None:
            self.handle.registerTimer(at)
        if found:
            yield pd.DataFrame(found, columns=["scene", "at", "age_days", "missing"])

    def close(self) -> None:
        pass


def retries(outcomes: DataFrame, analysers: list[str], late: str) -> DataFrame:
    """(scene, at, age_days, missing) for a stream of outcomes (scene, start, ts, analyser, ok): when scenes are tried again, in milliseconds, and
    which analysers. Outcomes may be `late`; older ones are dropped. The store of states has to be one that keeps timers, see `timers`. Rows
    without a scene, time or start are dropped; an analyser that isn't among the wanted ones counts for the first attempt alone."""
    rows = outcomes.withWatermark("ts", late).where("scene is not null and ts is not null and start is not null")
    rows = rows.select("scene", F.unix_millis("start").alias("start"), "ts", F.unix_millis("ts").alias("at"), "analyser", F.coalesce("ok", F.lit(False)).alias("ok"))
    return rows.groupBy("scene").transformWithStateInPandas(Retries(analysers), RETRIES, "Append", "EventTime")


@contextmanager
def timers(spark: SparkSession):
    """The store of states that timers need, for streams that start within."""
    name, wanted = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, wanted)
    try:
        yield
    finally:
        spark.conf.set(name, before)


KINDS = ["click", "error", "purchase", "signup", "view"]


def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3s F8: retries of the scenes whose outcomes the events are."""
    start = F.timestamp_seconds(1_704_067_200 - F.col("user_id") % 40 * 86_400)
    outcomes = event_stream(spark, sf_dir).select(F.col("user_id").cast("long").alias("scene"), start.alias("start"), "ts", F.col("event_type").alias("analyser"), (F.col("value") > 60).alias("ok"))
    with timers(spark):
        return drained(retries(outcomes, KINDS, "2 days"), "append")


QUERIES = {"stream_retries": stream_retries}
ORACLES = {
    "stream_retries": """WITH RECURSIVE e AS (SELECT user_id::BIGINT AS scene, 1000 * (1704067200 - user_id % 40 * 86400)::BIGINT AS start, epoch_us(ts) // 1000 AS t, event_type AS analyser, value > 60 AS ok FROM events),
w AS (SELECT max(t) - 2 * 86400000 AS mark FROM e), d AS (SELECT scene, analyser, min(t) AS done FROM e WHERE ok GROUP BY ALL),
s AS (SELECT scene, start, min(t) AS t FROM e GROUP BY ALL), k AS (SELECT DISTINCT analyser FROM e),
r(scene, start, t) AS (SELECT * FROM s UNION ALL SELECT scene, start, t + CASE WHEN t - start < 7 * 86400000 THEN 1 ELSE 7 END * 86400000 FROM r WHERE t - start < 32::BIGINT * 86400000)
SELECT r.scene, r.t AS "at", (r.t - r.start) // 86400000 AS age_days, string_agg(k.analyser, ',' ORDER BY k.analyser) AS missing
FROM r JOIN s ON r.scene = s.scene AND r.t > s.t CROSS JOIN k LEFT JOIN d ON d.scene = r.scene AND d.analyser = k.analyser WHERE r.t <= (SELECT mark FROM w) AND (done IS NULL OR done > r.t) GROUP BY r.scene, r.t, r.start""",
}
