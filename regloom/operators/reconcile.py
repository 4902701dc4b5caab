"""Keys, latest copies, and the join of independent collectors."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import name_key


def latest_per_key(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row per key: the greatest by ``order``. ``max_by`` is combined
    before the shuffle, so a hot key costs one row per task. ``order`` should
    end in columns that make it total."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order_cols)).alias("_r"))
    return best.select(*keys, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns)


def latest_rows(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """As ``latest_per_key``, for wide rows: columns that nobody reads later are dropped
    before the sort and the shuffle, which a struct of the whole row would keep. Spark limits the
    groups of each task to one row before the shuffle, so a hot key costs one row per task here too."""
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[o.desc() for o in order_cols]))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def unique_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """``(_name, _by_name)`` for names carried by exactly one key."""
    return (df.groupBy(name_key(F.col(name)).alias("_name"))
            .agg(F.count_distinct(key).alias("_n"), F.min(key).alias("_by_name"))
            .filter("_n = 1").select("_name", "_by_name"))


def _settle(rows: DataFrame, boot: DataFrame, claimed: DataFrame | None, key: str, name: str
            ) -> DataFrame:
    """Add ``resolved_key`` and ``resolution`` to rows that carry ``_name``.
    Two left joins with one-row-per-key sides."""
    known = boot.select(F.col(key).alias("_known")).distinct()
    candidates = boot if claimed is None else boot.join(claimed, key, "left_anti")
    names = unique_names(candidates, key, name)
    hit = F.col("_known").isNotNull()
    return (rows.join(known, F.col(key) == F.col("_known"), "left").join(names, "_name", "left")
            .withColumn("resolved_key", F.when(hit, F.col(key))
                        .otherwise(F.coalesce("_by_name", key)))
            .withColumn("resolution", F.when(hit, "exact")
                        .when(F.col("_by_name").isNotNull(), "by_name")
                        .when(F.col(key).isNotNull(), "unmatched").otherwise("unresolved"))
            .drop("_known", "_by_name"))


def resolve_keys(pages: DataFrame, boot: DataFrame, key: str = "certificate_number",
                 name: str = "commercial_name", exclude_claimed: bool = False) -> DataFrame:
    """Settle each page row's key: its own when the other side knows it, else
    the one key with the same name, else its own. Adds ``resolved_key`` and
    ``resolution`` (exact / by_name / unmatched / unresolved).

    The (key, name) pairs are settled once each, so copies of one certificate
    do not meet in one task; the answer goes back by the same pair.
    """
    rows = pages.withColumn("_name", name_key(F.col(name)))
    claimed = pages.select(key).distinct() if exclude_claimed else None
    pairs = rows.select(key, "_name").distinct()
    settled = _settle(pairs, boot, claimed, key, name).select(
        F.col(key).alias("_k"), F.col("_name").alias("_nm"), "resolved_key", "resolution")
    return (rows.join(settled, rows[key].eqNullSafe(settled["_k"])
                      & (rows["_name"] == settled["_nm"]), "left")
            .select(*pages.columns, "resolved_key", "resolution"))


def latest_resolved(pages: DataFrame, boot: DataFrame, order: list[str | Column],
                    key: str = "certificate_number", name: str = "commercial_name",
                    exclude_claimed: bool = False) -> tuple[DataFrame, DataFrame]:
    """Latest page row per settled key, and the rows no key could be found for.

    Reduced twice by the same order: first per (own key, name), which shrinks
    hot keys before any join, then per settled key. Only (key, name) pairs meet the other side; those
    that get another key, few as a rule, come back to the rows where these lie after the first reduction.
    """
    named = pages.withColumn("_name", name_key(F.col(name)))
    # Never null, so that rows and pairs can be joined by plain equality.
    own = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit(""))
    slim = latest_rows(named.withColumn("_own", own), ["_own", "_name"], order)
    claimed = pages.select(key).distinct() if exclude_claimed else None
    candidates = boot if claimed is None else boot.join(claimed, key, "left_anti")
    known = boot.select(F.col(key).alias("_known"))
    moved = (named.select(key, "_name").distinct().join(known, F.col(key) == F.col("_known"), "left_anti")
             .join(unique_names(candidates, key, name), "_name").select(own.alias("_own"), "_name", "_by_name"))
    lost = resolve_keys(pages.filter(F.col(key).isNull()), boot, key, name, exclude_claimed)
    quarantine = (lost.filter("resolution = 'unresolved'").drop("resolved_key", "resolution")
                  .withColumn("reason", F.lit("no certificate number and no unique name")))
    # Whatever the sizes are guessed to be, rows stay partitioned by (own key, name) and are not sent again.
    good = (slim.join(moved.hint("merge"), ["_own", "_name"], "left").withColumn(key, F.coalesce("_by_name", key))
            .filter(F.col(key).isNotNull()))
    return latest_rows(good.select(*pages.columns), [key], order), quarantine


def match_sources(left: DataFrame, right: DataFrame, key: str = "certificate_number",
                  left_name: str = "boot", right_name: str = "page") -> DataFrame:
    """Full outer join of two one-row-per-key tables on the key. Gives the key,
    each side as a struct, ``outcome`` and ``confidence``. Rows without a key
    must have left before."""
    a = left.select(key, F.struct(*left.columns).alias(left_name))
    b = right.select(key, F.struct(*right.columns).alias(right_name))
    has_a, has_b = F.col(left_name).isNotNull(), F.col(right_name).isNotNull()
    return (a.join(b, key, "full_outer")
            .withColumn("outcome", F.when(has_a & has_b, "both")
                        .when(has_a, f"{left_name}_only").otherwise(f"{right_name}_only"))
            .withColumn("confidence", F.when(has_a & has_b, "high").otherwise("medium")))


def outcome_counts(df: DataFrame, column: str = "outcome") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def attach_details(rows: DataFrame, details: DataFrame, template: str,
                   key: str = "certificate_number", link: str = "detail_page_url",
                   detail_url: str = "url") -> DataFrame:
    """List rows left joined with their detail page, found by the row's own
    link or else by the link built from the number. Detail fields overwrite."""
    before, after = template.split("{}")
    fields = [c for c in details.columns if c != detail_url]
    side = details.select(F.col(detail_url).alias("_url"), F.lit(True).alias("_fetched"),
                          *[F.col(c).alias(f"_d_{c}") for c in fields])
    target = F.when(F.col(key).isNotNull(),
                    F.coalesce(F.col(link), F.concat(F.lit(before), F.col(key), F.lit(after))))
    joined = rows.withColumn("_target", target).join(side, F.col("_target") == F.col("_url"), "left")
    kept = [c for c in rows.columns if c not in fields]
    return joined.select(*kept, *[
        (F.when(F.col("_fetched"), F.col(f"_d_{c}")).otherwise(F.col(c)) if c in rows.columns
         else F.col(f"_d_{c}")).alias(c) for c in fields])


def split_collisions(df: DataFrame, api_id: str, order: str) -> DataFrame:
    """Mark the first record of each identifier ``kept`` and later ones
    ``collides``. The first is found by a partial ``min_by``; the flag then
    comes from a comparison, not from ranking the whole group."""
    first = df.groupBy(api_id).agg(F.min(order).alias("_first"))
    return (df.join(first, api_id)
            .withColumn("outcome", F.when(F.col(order) == F.col("_first"), "kept")
                        .otherwise("collides")).drop("_first"))


def combine_sources(*frames: DataFrame) -> DataFrame:
    """Bag union of the canonical sources by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
