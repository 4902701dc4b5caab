"""Ordered substring rules kept as rows of a table.

A rule (priority, needle, label) applies to values that contain its needle; of all
rules that apply, the one of least priority gives the label, as in the chains of
``functions.rules``. Thousands of rules are matched without trying each on each
value: a value is cut into the windows of ``GRAM`` characters that begin at each of
its places, a needle is sought by one window, and so values and rules meet in an
equi-join; ``contains`` confirms what met. Only distinct values take part.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

GRAM = 4


def _grams(c: Column, width: int) -> Column:
    """Distinct substrings of a width, found in one walk over the text."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{width}}}))"), F.lit(1)))


def _windows(values: DataFrame, width: int) -> DataFrame:
    """(window): the windows of each value, those at its end filled up, so that
    a needle shorter than a window is the beginning of one."""
    filled = F.concat("value", F.lit("\0" * (width - 1)))
    return values.select(F.explode_outer(_grams(filled, width)).alias("window")).filter("window IS NOT NULL")


def sought(rules: DataFrame, windows: DataFrame, width: int = GRAM) -> DataFrame:
    """Rules with the windows they are sought by: a needle shorter than ``width`` all
    that begin with it, any other that of its own which the fewest values hold.
    ``windows``: (window, often). Rules none of whose windows any value holds go."""
    short, long = rules.filter(F.length("needle") < width), rules.filter(F.length("needle") >= width)
    begins = windows.select("window", F.explode(F.array(*[F.substring("window", 1, n) for n in range(1, width)])).alias("needle"))
    asked = long.select("needle", F.explode(_grams(F.col("needle"), width)).alias("window"))
    rarest = asked.join(windows, "window", "left").groupBy("needle").agg(
        F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), F.col("window"))).alias("least")).filter("least.often > 0")
    return (short.join(begins, "needle").select("needle", "best", "window")
            .unionByName(long.join(rarest.select("needle", "least.window"), "needle")))


def first_rule(values: DataFrame, rules: DataFrame, width: int = GRAM) -> DataFrame:
    """(value, label) of the distinct values of ``values`` (column ``value``) to which a
    rule of ``rules`` (priority, needle, label) applies; equal priorities are decided
    by the needle, then the label. Rules with a null or empty needle never apply."""
    usable = rules.filter("length(needle) > 0").groupBy("needle").agg(F.min(F.struct("priority", "label")).alias("best"))
    distinct = materialize(values.select("value").filter("value IS NOT NULL").distinct(), "rule-values")
    counted = materialize(_windows(distinct, width).groupBy("window").agg(F.count(F.lit(1)).alias("often")), "rule-windows")
    # Rules are numbered in their order and written, so that their size is known when they meet the values: few rules
    # come to where the values lie, whose windows then do not move. What meets is confirmed there, and the least number kept.
    ranked = materialize(usable.orderBy("best.priority", "needle").select(
        "needle", F.monotonically_increasing_id().alias("best"), F.col("best.label").alias("label")), "rule-order")
    asked = materialize(sought(ranked.select("needle", "best"), counted, width), "rule-sought")
    filled = F.concat("value", F.lit("\0" * (width - 1)))
    met = distinct.select("value", F.explode_outer(_grams(filled, width)).alias("window")).join(asked, "window")
    least = met.filter(F.contains("value", "needle")).groupBy("value").agg(F.min("best").alias("best"))
    return least.join(ranked.select("best", "label"), "best").select("value", "label")


def apply_rules(df: DataFrame, column: str, rules: DataFrame, label: str = "label", key: Column | None = None,
                default: Column | None = None) -> DataFrame:
    """``df`` with the label of each value of ``column``; ``key`` is what the rules are
    matched with (the value itself if none). A rule's label is found once per
    distinct key, and rows meet it in an outer join, so no row is lost."""
    keyed = df.withColumn("_key", F.col(column) if key is None else key)
    found = first_rule(keyed.select(F.col("_key").alias("value")), rules).select(
        F.col("value").alias("_key"), F.col("label").alias("_label"))
    chosen = F.col("_label") if default is None else F.coalesce("_label", default)
    return keyed.join(found, "_key", "left").withColumn(label, chosen).drop("_key", *([] if label == "_label" else ["_label"]))


def chain_as_table(spark, rules) -> DataFrame:
    """(priority, needle, label) of a chain's ``(label, [needles])`` list."""
    rows = [(i, needle, label) for i, (label, needles) in enumerate(rules) for needle in needles]
    return spark.createDataFrame(rows, "priority int, needle string, label string")
