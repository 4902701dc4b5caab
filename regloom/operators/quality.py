"""Calibration of one extraction against another."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab

QUANTITATIVE_FIELDS = ["bias_log", "sd_log", "lower_limit_95", "upper_limit_95"]
QUALITATIVE_FIELDS = ["sensitivity_alternative_pct", "sensitivity_reference_pct",
                      "relative_trueness_pct"]


def category_key(c):
    return F.lower(F.trim(c))


def last_per_category(rows: DataFrame, fields: list[str], key: str, category: str, order: str
                      ) -> DataFrame:
    """A later row of the same category replaces an earlier one."""
    best = rows.groupBy(key, category_key(F.col(category)).alias("category")).agg(
        F.max_by(F.struct(*fields), order).alias("_r"))
    return best.select(key, "category", "_r.*")


def compare(truth: DataFrame, other: DataFrame, fields: list[str], key: str = "doc_id",
            category: str = "category", order: str = "row_no",
            tolerance: float = vocab.TOLERANCE) -> DataFrame:
    """(key, category, field, truth, other, verdict) for every category of the
    truth. Both null is a match, one null is not; equal within the tolerance.
    Categories the other side lacks give the verdict ``missing``."""

    left = last_per_category(truth, fields, key, category, order)
    right = last_per_category(other, fields, key, category, order).select(
        key, "category", *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_seen"))
    # Joined on the aggregates' own keys; only then one row per field.
    joined = left.join(right, [key, "category"], "left").select(
        key, "category", "_seen", F.explode(F.array(*[F.struct(
            F.lit(f).alias("field"), F.col(f).cast("double").alias("truth"), F.col(f"_{f}").cast("double").alias("other"))
            for f in fields])).alias("f")).select(key, "category", "_seen", "f.*")
    a, b = F.col("truth"), F.col("other")
    match = F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False) \
        .otherwise(F.abs(a - b) <= tolerance)
    return joined.select(key, "category", "field", "truth", "other", F.when(
        F.col("_seen").isNull(), "missing").when(match, "match").otherwise("mismatch")
        .alias("verdict"))


def agreement(verdicts: DataFrame, keys: list[str], fields: int) -> DataFrame:
    """Matched and compared fields; missing categories are counted apart. A
    missing category is missing in each of its ``fields``."""
    return verdicts.groupBy(*keys).agg(
        F.count_if(F.col("verdict") != "missing").alias("total_fields"),
        F.count_if(F.col("verdict") == "match").alias("matched_fields"),
        (F.count_if(F.col("verdict") == "missing") / fields).cast("bigint").alias("missing_categories"))


def record_outcomes(truth: DataFrame, other: DataFrame, key: str = "doc_id",
                    nature: str = "method_nature", n_rows: str = "n_rows") -> DataFrame:
    """Class of each calibrated record. Both sides hold one row per record."""
    side = other.select(key, F.col(nature).alias("_nature"), F.col(n_rows).alias("_n"),
                        F.lit(True).alias("_seen"))
    joined = truth.join(side, key, "left")
    return joined.select(key, F.when(
        F.col("_seen").isNull() | F.col("_nature").isNull(), "no_data")
        .when(F.col("_nature") != F.col(nature), "nature_mismatch")
        .when(F.coalesce("_n", F.lit(0)) == 0, "zero_rows").otherwise("compared")
        .alias("outcome"))


def sample(candidates: DataFrame, key: str, n: int) -> DataFrame:
    """The first n by key."""
    return candidates.orderBy(key).limit(n)


def named_sample(candidates: DataFrame, wanted: DataFrame, key: str
                 ) -> tuple[DataFrame, DataFrame]:
    """The named candidates, and the names that are no candidate."""
    names = wanted.select(key).distinct()
    return (candidates.join(names, key, "left_semi"),
            names.join(candidates.select(key).distinct(), key, "left_anti"))
