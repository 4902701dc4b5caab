"""Mixing sources to target weights by weighted fair queueing.

Sources get targets from their weights, filled up to a cap. Each document gets
a shuffled place in its source, and each of its copies a virtual finish time:
the words of its source up to and including it, divided by the source's target.
All copies are then range-sorted by finish time across the cluster, and the mix
is cut where the running total of words passes the budget. A source with target
T has had T words served at time 1, whatever its size.

Running totals over a source or over the whole order are taken in two levels:
within slots (range partitions of the order, in sources and over all), and over
the small table of slot totals. One source may hold most rows.

Defined cases: null or empty texts have size 0 and are taken 0 times; null is a
source of its own and comes last; equal rows are separate documents; sources
without words have target 0; an empty table gives an empty result; other
columns are ignored by ``mix`` and carried by ``mixed_documents``.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import arrow_text as at
from .staging import materialize, row_key

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def sizes(rows: DataFrame) -> DataFrame:
    """``rows`` without text, with ``size``: words of the whole text."""
    keys = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch):
                kept = part.select(keys)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, pa.array(at.word_counts(at.strings(part.column("text"))).astype(np.int64))],
                    names=[*keys, "size"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in keys) + ", size long")


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) per source.

    Sources by code point, null last, take the weights in turn. With sources in
    order of cap per weight, the level at which all below are capped is found
    from running totals over this table of one row per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", most * F.col("source_size").cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    left = (share * F.sum("source_size").over(whole)
            - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    placed = per.withColumn("level", left / open_weight)
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))
    first = F.first(fits, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (placed.withColumn("level", first)
            .select("source", "source_size", F.least(
                F.col("cap"), F.col("weight") * F.coalesce("level", F.lit(float("inf")))).alias("target")))


def shuffled(doc_id: Column) -> Column:
    """Place of a document in its source: equal in any run and engine."""
    return F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def _before(rows: DataFrame, group: list[str], slot: str, value: str, order: list, name: str) -> DataFrame:
    """Add ``name``: the running total of ``value`` in a group whose slots are
    in order, up to and including the row. Groups may be null."""
    totals = rows.groupBy(*group, slot).agg(F.sum(value).alias("_v"))
    upto = Window.partitionBy(*group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"_{c}") for c in [*group, slot]],
                           F.coalesce(F.sum("_v").over(upto), F.lit(0)).alias("_start"))
    inner = F.sum(value).over(Window.partitionBy(*group, slot).orderBy(*order)
                              .rowsBetween(Window.unboundedPreceding, 0))
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in [*group, slot]]
    return (rows.withColumn(name, inner).join(totals, on).withColumn(name, F.col(name) + F.col("_start"))
            .drop("_start", *[f"_{c}" for c in [*group, slot]]))


def _mix(rows: DataFrame, weights, share: float, most: int) -> DataFrame:
    """``rows``: uid, doc_id, source, key, size, already written."""
    aims = materialize(targets(rows, weights, share, most), "mix-targets")
    # Slots are ranges of the whole order, so neither a hot source nor one repeated or null id makes a large one.
    order = ["_key", "size", "_row_key", "_uid"]
    slotted = materialize(rows.repartitionByRange("source", *order).withColumn("slot", F.spark_partition_id()), "mix-slots")
    placed = _before(slotted, ["source"], "slot", "size", order, "_words")
    named = aims.select(F.col("source").alias("_source"), "source_size", "target")
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "slot")
    copies = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    finish = F.when(F.col("target") > 0, (F.col("_copy") * F.col("source_size") + F.col("_words")) / F.col("target"))
    copies = copies.withColumn("_finish", F.coalesce(finish, F.lit(0.0))).drop("_words")
    order = ["_finish", "_key", "_row_key", "_uid", "_copy"]
    ranged = materialize(copies.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mix-order")
    served = _before(ranged.withColumn("_all", F.lit(0)), ["_all"], "_part", "size", order, "_served")
    budget = aims.agg((share * F.coalesce(F.sum("source_size"), F.lit(0))).alias("_budget"))
    inside = F.col("_served") <= F.col("_budget")
    return (served.crossJoin(F.broadcast(budget)).groupBy("_uid").agg(
        *[F.first(c).alias(c) for c in ("doc_id", "size", "source_size", "target")],
        F.sum(F.when(inside, F.col("size")).otherwise(0)).alias("taken"), F.first("source").alias("source"),
        F.sum(F.when(inside & (F.col("size") > 0), 1).otherwise(0)).alias("copies")))


def _placed(docs: DataFrame, *columns: Column) -> DataFrame:
    """Row number, shuffled place and key of each document, and ``columns``."""
    return docs.select(F.monotonically_increasing_id().alias("_uid"), shuffled(F.col("doc_id")).alias("_key"),
                       row_key(docs).alias("_row_key"), "doc_id", "source", "text", *columns)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies."""
    return _mix(materialize(sizes(_placed(docs)), "mix-sizes"), weights, share, most).drop("_uid")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    rest = [F.struct(*[F.col(f"`{c}`") for c in others]).alias("_rest")] if others else []
    staged = materialize(_placed(docs, *rest), "mix-docs")
    sized = materialize(sizes(staged.select("_uid", "_key", "_row_key", "doc_id", "source", "text")), "mix-sizes")
    taken = _mix(sized, weights, share, most).filter("copies > 0").select("_uid", "copies")
    return (staged.join(taken, "_uid").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select(*[F.col(c if c in ("doc_id", "source", "text") else f"_rest.`{c}`") for c in docs.columns]))
