"""Per-key quota in tumbling windows, as a batch job."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .. import vocab


def quota_decisions(events: DataFrame, cap: int = vocab.REQUEST_QUOTA, key: str = "user_id",
                    ts: str = "ts", event_id: str = "event_id", unit: str = "hour") -> DataFrame:
    """Adds ``bucket`` and ``accepted``: the first ``cap`` events of a key in a
    clock hour pass, the others are refused and do not count.

    Only the cap-th event of a full bucket is ranked for (the ranking keeps at
    most ``cap`` rows of a bucket per task before the shuffle); an event passes
    when it is not later than that one. The limits are one row per full bucket,
    so a hot key is split by the skew join and never sorted in one task.
    """
    marked = events.withColumn("bucket", F.date_trunc(unit, F.col(ts)))
    order = Window.partitionBy(key, "bucket").orderBy(ts, event_id)
    limits = (marked.select(key, "bucket", ts, event_id)
              .withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= cap)
              .filter(F.col("_rn") == cap)
              .select(key, "bucket", F.struct(ts, event_id).alias("_limit")))
    joined = marked.join(limits, [key, "bucket"], "left")
    return joined.select(*events.columns, "bucket", (
        F.col("_limit").isNull() | (F.struct(ts, event_id) <= F.col("_limit"))).alias("accepted"))
