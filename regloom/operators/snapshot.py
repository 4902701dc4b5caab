"""Carry-forward upserts, validation and merging of mined results.

A job reads the previous snapshot and writes a new path; nothing is written
where it is being read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import blank_to_null
from ..session import union


def carry_forward(new: DataFrame, previous: DataFrame, mined: list[str], key: str = "id",
                  keep_missing: bool = True) -> DataFrame:
    """Fresh fields win; each ``mined`` column comes from the previous row when
    the new value is null. Keys absent from ``new`` stay, as nothing is deleted.

    Only the mined columns of the previous side are read for the join.
    """
    old = previous.select(key, *[F.col(c).alias(f"_old_{c}") for c in mined])
    merged = new.join(old, key, "left").select(*[
        (F.coalesce(F.col(c), F.col(f"_old_{c}")) if c in mined else F.col(c)).alias(c)
        for c in new.columns])
    if not keep_missing:
        return merged
    gone = previous.join(new.select(key), key, "left_anti").select(*new.columns)
    return union(merged, gone)


def preserve_mined_fields(new: DataFrame, previous: DataFrame, keep_missing: bool = True
                          ) -> DataFrame:
    """``carry_forward`` on canonical records: performance, expert laboratory
    and, where the old record has performance, its confidence and notes."""
    perf = F.col("performance")
    old = previous.select(
        "id", perf.alias("_perf"), F.col("study_design.expert_laboratory").alias("_lab"),
        F.when(perf.isNotNull(), F.col("traceability.extraction_confidence")).alias("_conf"),
        F.when(perf.isNotNull(), F.col("traceability.notes")).alias("_notes"))
    tr = F.col("traceability")
    merged = (new.join(old, "id", "left")
              .withColumn("performance", F.coalesce(perf, F.col("_perf")))
              .withColumn("study_design", F.col("study_design").withField(
                  "expert_laboratory",
                  F.coalesce(blank_to_null(F.col("study_design.expert_laboratory")),
                             F.col("_lab"))))
              .withColumn("traceability", tr
                          .withField("extraction_confidence", F.coalesce(blank_to_null(
                              tr["extraction_confidence"]), F.col("_conf")))
                          .withField("notes", F.coalesce(blank_to_null(tr["notes"]),
                                                         F.col("_notes"))))
              .select(*new.columns))
    if not keep_missing:
        return merged
    gone = previous.join(new.select("id"), "id", "left_anti")
    return union(merged, gone.select(*new.columns))


def append_once(notes: Column, addition: Column) -> Column:
    """Add a sentence to the notes unless it is there already."""
    have = F.coalesce(F.trim(notes), F.lit(""))
    more = F.coalesce(addition, F.lit(""))
    return (F.when(F.contains(have, more), notes)
            .otherwise(F.trim(F.concat_ws(" ", have, more))))


def canonical_checks() -> list[tuple[Column, str]]:
    """Conditions a canonical record must not meet, with their messages."""
    perf = F.col("performance")
    return [
        (F.col("id").isNull() | (F.col("id") == ""), "id is empty"),
        (F.col("source").isNull(), "source is missing"),
        (F.col("source_certificate_number").isNull(), "certificate number is missing"),
        (F.col("commercial_name").isNull(), "commercial name is missing"),
        (F.col("method_type.action").isNotNull()
         & ~F.col("method_type.action").isin("detection", "enumeration"), "action is not known"),
        (~F.coalesce(F.col("certification.status"), F.lit(""))
         .isin("active", "expired", "unknown"), "status is not known"),
        (~F.coalesce(F.col("traceability.extraction_confidence"), F.lit(""))
         .isin("high", "medium"), "confidence is not known"),
        (perf.isNotNull() & ~F.coalesce(perf["method_nature"], F.lit(""))
         .isin("quantitative", "qualitative"), "method nature is not known"),
    ]


def validate(df: DataFrame, checks: list[tuple[Column, str]], column: str = "errors") -> DataFrame:
    """Add the array of failed checks, in the order of the list."""
    failed = [F.when(F.coalesce(bad, F.lit(False)), F.lit(message)) for bad, message in checks]
    return df.withColumn(column, F.array_compact(F.array(*failed)))


def split_valid(df: DataFrame, checks: list[tuple[Column, str]]) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejects with the first error as the reason."""
    checked = validate(df, checks)
    return (checked.filter(F.size("errors") == 0).drop("errors"),
            checked.filter(F.size("errors") > 0)
            .withColumn("reason", F.element_at("errors", 1)).drop("errors"))


def merge_performance(records: DataFrame, mined: DataFrame, order: list[str] = ("doc_id",)
                      ) -> tuple[DataFrame, DataFrame]:
    """Put mined performance on the record with the same number. ``mined`` has
    ``certificate_number``, ``performance``, ``mining_notes``; of several
    reports with one number, the last by ``order`` (as far as ``mined`` has these
    columns) wins. Returns the records and the mined rows no record took, with
    the reason."""
    usable = mined.filter(F.col("certificate_number").isNotNull())
    by = [F.col(c) for c in order if c in mined.columns]
    side = usable.groupBy(F.col("certificate_number").alias("_cert")).agg(
        F.max_by(F.struct(F.col("performance").alias("p"), F.col("mining_notes").alias("n")),
                 F.struct(*by, F.coalesce("mining_notes", F.lit("")))).alias("_m"))
    hit = F.col("_m").isNotNull()
    tr = F.col("traceability")
    merged = (records.join(side, records["source_certificate_number"] == side["_cert"], "left")
              .withColumn("performance", F.when(hit, F.col("_m.p")).otherwise(F.col("performance")))
              .withColumn("traceability", F.when(hit, tr.withField(
                  "notes", append_once(tr["notes"], F.col("_m.n")))).otherwise(tr))
              .select(*records.columns))
    known = records.select(F.col("source_certificate_number").alias("certificate_number")).distinct()
    orphans = union(usable.join(known, "certificate_number", "left_anti")
                    .withColumn("reason", F.lit("no record with this number")),
                    mined.filter(F.col("certificate_number").isNull())
                    .withColumn("reason", F.lit("no number on the cover page")))
    return merged, orphans
