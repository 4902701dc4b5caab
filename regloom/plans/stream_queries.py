"""Streams over drops of files: quota by event time, counts of windows, re-sent records."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..session import union
from ..streaming import arrivals, incremental, quota
from .inputs import table
from .registry import query

DROPS = 3
#: Days that an event waits until it is sent, by its number: drops overlap in time.
DELAYED = "date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + event_id * 7919 % 3"
DROP_SQL = f"least(CAST(floor(({DELAYED}) / 11) AS INTEGER), {DROPS - 1})"


def _sent_events(spark, sf):
    """The events in drops of eleven days, up to two days out of order, and behind
    them an event of no one, a year later, which closes all windows."""
    events = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    delayed = F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")) + F.col("event_id") * 7919 % 3
    drop = F.least(F.floor(delayed / 11).cast("int"), F.lit(DROPS - 1))
    last = events.agg((F.max("ts") + F.expr("INTERVAL 365 DAYS")).alias("ts")).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"), "ts")
    return [*[events.filter(drop == i) for i in range(DROPS)], last]


@query("streamed_daily_quota", """
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) <= 2 AS accepted
FROM events""")
def streamed_daily_quota(spark, sf):
    with arrivals.keyed_state(spark):
        rows, _ = arrivals.run_to_table(lambda s: quota.quota_by_event_time(s, cap=2, unit="day", lateness="3 days"),
                                        _sent_events(spark, sf), "quota")
    return rows.filter("event_id >= 0").select("event_id", "user_id", F.col("bucket").cast("date").cast("string").alias("day"), "accepted")


@query("streamed_quota_windows", f"""
WITH e AS (SELECT user_id, CAST(ts AS TIMESTAMP) AS ts, {DROP_SQL} AS drop FROM events),
m AS (SELECT drop, max(ts) AS top FROM e GROUP BY 1),
w AS (SELECT m.drop, (SELECT max(o.top) FROM m o WHERE o.drop < m.drop) - INTERVAL 1 DAY AS mark FROM m),
k AS (SELECT user_id, CAST(ts AS DATE) AS day, coalesce(CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= mark, false) AS late FROM e JOIN w USING (drop)),
c AS (SELECT user_id, day, count(*) AS n FROM k WHERE NOT late GROUP BY 1, 2)
SELECT CAST(day AS VARCHAR) AS day, count(*) AS windows, CAST(sum(least(n, 2)) AS BIGINT) AS accepted, CAST(sum(greatest(n - 2, 0)) AS BIGINT) AS refused,
   CAST(0 AS BIGINT) AS late FROM c GROUP BY 1
UNION ALL SELECT 'late', 0, 0, 0, count(*) FROM k WHERE late""")
def streamed_quota_windows(spark, sf):
    drops = _sent_events(spark, sf)
    rows, progress = arrivals.run_to_table(lambda s: quota.quota_windows(s, cap=2, length="1 day", lateness="1 day"), drops, "windows")
    closed = rows.groupBy(F.col("bucket").cast("date").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("windows"), F.sum("accepted").cast("bigint").alias("accepted"),
        F.sum("refused").cast("bigint").alias("refused"), F.lit(0).cast("bigint").alias("late"))
    # What was read and is in no window was late; the last event stays in its open window.
    read = sum(p["numInputRows"] for p in progress) - 1
    late = rows.agg((F.lit(read) - F.coalesce(F.sum(F.col("accepted") + F.col("refused")), F.lit(0))).cast("bigint").alias("late")).select(
        F.lit("late").alias("day"), *[F.lit(0).cast("bigint").alias(c) for c in ("windows", "accepted", "refused")], "late")
    return union(closed, late)


@query("collected_once", """
SELECT o_orderkey AS number, CAST(o_orderdate AS VARCHAR) AS collected, o_orderstatus AS status FROM orders""")
def collected_once(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_orderdate").cast("timestamp").alias("collected"), F.col("o_orderstatus").alias("status"))
    part = F.least(F.greatest(F.floor(F.datediff("collected", F.lit("1995-01-01").cast("timestamp")) / 800), F.lit(0)), F.lit(2))
    # Each drop sends all that the former one has sent once more.
    drops = [orders.filter((part == i) | (part == i - 1)) for i in range(3)] + [orders.filter(part >= 2)]
    rows, _ = arrivals.run_to_table(lambda s: incremental.once_per_record(s, ["number", "status"], "collected", "10 days"), drops, "records")
    return rows.select("number", F.date_format("collected", "yyyy-MM-dd HH:mm:ss").alias("collected"), "status")
