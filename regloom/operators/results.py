"""Batch results: matching by identifier, outcomes and cost."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions.classify import is_aggregate_row

OUTCOMES = ["written", "no_data", "invalid", "failed"]


def drop_aggregate_rows(rows: DataFrame, category: str = "category"
                        ) -> tuple[DataFrame, DataFrame]:
    """Category rows, and the dropped cross-category rows for the audit."""
    bad = is_aggregate_row(F.col(category))
    return rows.filter(~bad), rows.filter(bad)


def match_results(results: DataFrame, records: DataFrame, n_rows: Column, valid: Column,
                  kind: str = "kind", custom_id: str = "custom_id") -> DataFrame:
    """Results joined to records by identifier, in whatever order they come.
    Unknown identifiers and anything but a success are failed; a result
    without rows is left for a retry; a bad one is invalid.

    Identifiers are unique on the record side after ``split_collisions``.
    """
    side = records.select(custom_id, F.lit(True).alias("_record"),
                          *[c for c in records.columns if c not in results.columns])
    joined = results.join(side, custom_id, "left")
    return joined.withColumn("outcome", F.when(
        F.col("_record").isNull() | ~F.coalesce(F.col(kind) == "succeeded", F.lit(False)), "failed")
        .when(F.coalesce(n_rows, F.lit(0)) == 0, "no_data")
        .when(~F.coalesce(valid, F.lit(False)), "invalid").otherwise("written")).drop("_record")


def has_breakdown(nature: Column, n_quantitative: Column, n_qualitative: Column) -> Column:
    """Whether a record's own branch has category rows."""
    rows = F.when(nature == "quantitative", n_quantitative).otherwise(n_qualitative)
    return F.coalesce(rows > 0, F.lit(False))


def cost(results: DataFrame, backlog: DataFrame, prices=vocab.BATCH_USD_PER_MTOK) -> DataFrame:
    """Token totals, price, price per report and the projection to the backlog."""
    totals = results.agg(F.count(F.lit(1)).alias("results"),
                         F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"),
                         F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"))
    left = backlog.agg(F.count(F.lit(1)).alias("remaining"))
    usd = (F.col("input_tokens") / 1e6 * prices["input"]
           + F.col("output_tokens") / 1e6 * prices["output"])
    # Two single-row aggregates.
    return (totals.join(left, F.lit(True)).withColumn("usd", usd)
            .withColumn("usd_per_report", F.col("usd") / F.greatest("results", F.lit(1)))
            .withColumn("usd_for_remaining", F.col("usd_per_report") * F.col("remaining")))
