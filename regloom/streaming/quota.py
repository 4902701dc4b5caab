"""The quota as a stream: a decision per event, or counts per window."""
from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .. import vocab

DECISION = "event_id bigint, user_id bigint, ts timestamp, bucket timestamp, accepted boolean"
STATE_TTL_MS = 2 * 60 * 60 * 1000


class QuotaProcessor(StatefulProcessor):
    """One small counter per (key, hour), gone after two hours. Refused events
    do not count. Inside a batch events are taken in time order."""

    def __init__(self, cap: int, ttl_ms: int | None = STATE_TTL_MS):
        self.cap = cap
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.used = handle.getValueState("used", "n int", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values
                        ) -> Iterator[pd.DataFrame]:
        used = self.used.get()[0] if self.used.exists() else 0
        room, first = self.cap - used, None
        # The earliest events so far are held, at most as many as there is room
        # for; whatever they push out is refused.
        for frame in rows:
            used += len(frame)
            held = frame if first is None else pd.concat([first, frame])
            held = held.sort_values(["ts", "event_id"], kind="stable")[["event_id", "user_id", "ts", "bucket"]]
            first, late = held.iloc[:room], held.iloc[room:]
            if len(late):
                yield late.assign(accepted=False)
        self.used.update((min(self.cap, used),))
        if first is not None and len(first):
            yield first.assign(accepted=True)

    def close(self) -> None:
        pass


def quota_stream(events: DataFrame, cap: int = vocab.REQUEST_QUOTA, unit: str = "hour",
                 ttl_ms: int | None = STATE_TTL_MS) -> DataFrame:
    """Decision per event. ``ts`` must be a timestamp. The state store has to be
    RocksDB; equality with the batch form holds for input in time order."""
    keyed = events.select("event_id", "user_id", "ts",
                          F.date_trunc(unit, "ts").alias("bucket"))
    return keyed.groupBy("user_id", "bucket").transformWithStateInPandas(
        statefulProcessor=QuotaProcessor(cap, ttl_ms), outputStructType=DECISION,
        outputMode="Append", timeMode="ProcessingTime" if ttl_ms else "None")


def quota_windows(events: DataFrame, cap: int = vocab.REQUEST_QUOTA, length: str = "1 hour",
                  lateness: str = "1 hour") -> DataFrame:
    """Accepted and refused events per key and window. Events later than the
    watermark are dropped and show in the state operator's metrics."""
    counted = (events.withWatermark("ts", lateness)
               .groupBy("user_id", F.window("ts", length)).agg(F.count(F.lit(1)).alias("n")))
    return counted.select("user_id", F.col("window.start").alias("bucket"),
                          F.least("n", F.lit(cap)).alias("accepted"),
                          F.greatest(F.col("n") - cap, F.lit(0)).alias("refused"))


class EventTimeQuota(StatefulProcessor):
    """The first ``cap`` events of a (user, bucket) by event time, whatever the order of
    arrival. A key is a bucket and a slot of users, all of which one call handles, since
    a call of its own for each user costs far more than its events. Held are at most ``cap``
    events of a user, the earliest so far: an event pushed out by earlier ones is refused
    at once, for nothing that comes later can change it. When the watermark passes the
    bucket's end, its timer fires: the held ones are accepted and the state goes."""

    def __init__(self, cap: int, bucket_ms: int):
        self.cap, self.bucket_ms = cap, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "user_id bigint, micros bigint, event_id bigint")

    def _rows(self, key, held: pd.DataFrame, accepted: bool) -> pd.DataFrame:
        return held.assign(bucket_ms=int(key[1]), accepted=accepted)[
            ["event_id", "user_id", "micros", "bucket_ms", "accepted"]]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = list(self.held.get())
        if not known:
            self.handle.registerTimer(int(key[1]) + self.bucket_ms)
        first = pd.DataFrame(known, columns=["user_id", "micros", "event_id"], dtype="int64")
        for frame in rows:
            met = pd.concat([first, frame[["user_id", "micros", "event_id"]]]).sort_values(
                ["user_id", "micros", "event_id"], kind="stable")
            early = met.groupby("user_id", sort=False).cumcount() < self.cap
            first, out = met[early], met[~early]
            if len(out):
                yield self._rows(key, out, False)
        self.held.put([(int(u), int(t), int(e)) for u, t, e in first.itertuples(index=False)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = list(self.held.get())
        self.held.clear()
        if known:
            yield self._rows(key, pd.DataFrame(known, columns=["user_id", "micros", "event_id"], dtype="int64"), True)

    def close(self) -> None:
        pass


#: Slots of users in a bucket.
SLOTS = 128
UNIT_MS = {"hour": 3_600_000, "day": 86_400_000}


def quota_by_event_time(events: DataFrame, cap: int = vocab.REQUEST_QUOTA, unit: str = "hour",
                        lateness: str = "1 hour", slots: int = SLOTS) -> DataFrame:
    """Decision per event in order of event time, equal to the batch form for all
    events that are not late. An event is late if its time is not behind the
    watermark, which trails the latest event of former batches by ``lateness``; late
    events get no decision and are counted by the state operator. Events without
    key or time have none either."""
    keyed = (events.filter("user_id IS NOT NULL AND ts IS NOT NULL AND event_id IS NOT NULL")
             .select(F.col("event_id").cast("bigint"), F.col("user_id").cast("bigint"), "ts").withWatermark("ts", lateness)
             .withColumn("micros", F.unix_micros("ts")).withColumn("bucket_ms", F.unix_millis(F.date_trunc(unit, "ts"))))
    keyed = keyed.withColumn("slot", F.pmod(F.xxhash64("user_id"), F.lit(slots)).cast("int"))
    decided = keyed.groupBy("slot", "bucket_ms").transformWithStateInPandas(
        statefulProcessor=EventTimeQuota(cap, UNIT_MS[unit]), outputMode="Append", timeMode="EventTime",
        outputStructType="event_id bigint, user_id bigint, micros bigint, bucket_ms bigint, accepted boolean")
    return decided.select("event_id", "user_id", F.timestamp_micros("micros").alias("ts"),
                          F.timestamp_millis("bucket_ms").alias("bucket"), "accepted")
