"""Snapshots rewritten slot by slot; counters from the pass that writes."""
import glob
import os
import re
import uuid

import pytest
from pyspark.sql import functions as F

from regloom.session import checkpoint_dir
from regloom.sources import runlog, snapshots


@pytest.fixture
def stored(spark):
    name = f"snap_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark)}/{name}"
    snapshots.open_snapshot(spark, name, path, "id STRING, status STRING, mined STRING")
    rows = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("id"), F.lit("old").alias("status"), F.concat(
        F.lit("m"), "id").alias("mined"))
    assert snapshots.upsert(rows, name, ["mined"]) == list(range(snapshots.SLOTS))
    yield name, path.removeprefix("file:")
    spark.sql(f"DROP TABLE {name}")


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/slot=*/*.parquet")}


def test_only_touched_slots_are_rewritten(spark, stored):
    name, path = stored
    before = _files(path)
    fresh = spark.createDataFrame([("k5", "new", None), ("k6", "new", "again"), ("added", "new", None)], "id string, status string, mined string")
    touched = snapshots.upsert(fresh, name, ["mined"])
    assert 1 <= len(touched) <= 3
    after = _files(path)
    kept = {f: t for f, t in before.items() if int(re.search(r"slot=(\d+)", f)[1]) not in touched}
    assert kept and all(after.get(f) == t for f, t in kept.items())
    rows = {r["id"]: (r["status"], r["mined"]) for r in spark.table(name).collect()}
    assert len(rows) == 2001 and rows["k5"] == ("new", "m5") and rows["k6"] == ("new", "again") and rows["added"] == ("new", None)
    assert all(rows[f"k{i}"] == ("old", f"m{i}") for i in range(2000) if i not in (5, 6))
    assert snapshots.upsert(fresh, name, ["mined"]) == touched  # a repeated run gives the same table
    assert {r["id"]: (r["status"], r["mined"]) for r in spark.table(name).collect()} == rows
    assert snapshots.upsert(fresh.limit(0), name, ["mined"]) == []


def test_stored_side_is_not_shuffled(spark, stored):
    name, _ = stored
    fresh = spark.range(500).select(F.concat(F.lit("k"), "id").alias("id"), F.lit("new").alias("status"), F.lit(None).cast("string").alias("mined"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows, _ = snapshots.merged(fresh, spark.table(name), ["mined"])
        plan = rows._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    assert len(scans) == 2 and "SortMergeJoin" in plan
    for i in scans:  # from each scan of the snapshot up to its join
        depth = len(re.match(r"[\s:|+-]*", lines[i])[0])
        for line in reversed(lines[:i]):
            at = len(re.match(r"[\s:|+-]*", line)[0])
            if at < depth:
                depth = at
                assert "Exchange" not in line
                if "SortMergeJoin" in line:
                    break


def test_a_reopened_snapshot_has_its_rows(spark, stored):
    name, path = stored
    again = f"{name}_again"
    assert snapshots.open_snapshot(spark, again, path, "id STRING, status STRING, mined STRING").count() == 2000
    spark.sql(f"DROP TABLE {again}")


def test_counters_come_from_the_writing_pass(spark):
    base = f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"
    rows = spark.range(1000).withColumn("source", F.when(F.col("id") < 300, "x").when(F.col("id") < 900, "y"))
    got = runlog.write_counted(rows, f"{base}/a", {"x": runlog.counted(F.col("source") == "x")}, keep=F.col("source") != "x")
    assert got == {"read": 1000, "x": 300, "written": 600}
    empty = runlog.write_counted(rows.limit(0), f"{base}/b", {"x": runlog.counted(F.col("source") == "x")})
    assert empty == {"read": 0, "x": 0, "written": 0}
    runlog.log_run(spark, f"{base}/log", "job", "r1", got)
    runlog.log_run(spark, f"{base}/log", "job", "r2", empty)
    assert spark.read.parquet(f"{base}/log").groupBy("run_id").count().count() == 2
