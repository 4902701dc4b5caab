"""Counters of a job, taken in the pass that writes its rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, functions as F


def counted(test: Column) -> Column:
    """Rows for which a test holds; a null test does not hold."""
    return F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("bigint")


def write_counted(rows: DataFrame, path: str, counters: dict[str, Column], keep: Column | None = None,
                  mode: str = "errorifexists") -> dict[str, int]:
    """Write the rows for which ``keep`` holds and return the counters over all of
    them, with ``read`` and ``written``, from one scan. A task that runs twice counts
    once, as counters come with the results of the tasks that ended."""
    seen, kept = Observation(), Observation()
    out = rows.observe(seen, F.count(F.lit(1)).alias("read"), *[c.alias(n) for n, c in counters.items()])
    if keep is not None:
        out = out.filter(keep)
    out = out.observe(kept, F.count(F.lit(1)).alias("written"))
    out.write.mode(mode).parquet(path)
    return {**seen.get, **kept.get}


def log_run(spark, path: str, job: str, run_id: str, figures: dict[str, int], at: dt.datetime | None = None) -> None:
    """Append the figures of a run, one row each, to the run log."""
    at = at or dt.datetime.now(dt.timezone.utc)
    spark.createDataFrame([(job, run_id, at, n, int(v)) for n, v in figures.items()],
                          "job string, run_id string, at timestamp, counter string, n bigint").write.mode("append").parquet(path)
