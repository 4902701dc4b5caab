"""Snapshots rewritten slot by slot, and run logs from the pass that writes."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import runlog, snapshots
from . import inputs
from .inputs import ENTRIES_SQL, table
from .registry import query


@query("upserted_snapshot", """
SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'renewed' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderstatus = 'F' AND o_totalprice < 150000 THEN 'mined again' ELSE o_orderpriority END AS mined FROM orders""")
def upserted_snapshot(spark, sf):
    """All orders stored, then the finished ones collected again: most have nothing mined and keep what was."""
    orders = table(spark, sf, "orders")
    name = f"snapshot_{uuid.uuid4().hex}"
    snapshots.open_snapshot(spark, name, f"{checkpoint_dir(spark)}/regloom-{name}", "id BIGINT, status STRING, mined STRING", buckets=4)
    snapshots.upsert(orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
                                   F.col("o_orderpriority").alias("mined")), name, ["mined"], slots=8)
    again = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id"), F.lit("renewed").alias("status"), F.when(
        F.col("o_totalprice") < 150000, "mined again").alias("mined"))
    snapshots.upsert(again, name, ["mined"], slots=8)
    return spark.table(name).select("id", "status", "mined")


@query("run_log", f"""WITH {ENTRIES_SQL}
SELECT 'read' AS counter, count(*) AS n FROM entries UNION ALL SELECT 'excluded', count(*) FROM entries WHERE source = 'REG-P'
UNION ALL SELECT 'without_laboratory', count(*) FROM entries WHERE expert_laboratory IS NULL
UNION ALL SELECT 'expired', count(*) FROM entries WHERE status = 'expired'
UNION ALL SELECT 'written', count(*) FROM entries WHERE source <> 'REG-P'""")
def run_log(spark, sf):
    base = f"{checkpoint_dir(spark)}/regloom-run-{uuid.uuid4().hex}"
    out = F.col("source") == "REG-P"
    figures = runlog.write_counted(inputs.entries(spark, sf), f"{base}/entries", {
        "excluded": runlog.counted(out), "without_laboratory": runlog.counted(F.col("expert_laboratory").isNull()),
        "expired": runlog.counted(F.col("status") == "expired")}, keep=~out)
    runlog.log_run(spark, f"{base}/log", "catalogue", "1", figures)
    return spark.read.parquet(f"{base}/log").select("counter", "n")
