"""Catalogue entries, facet vocabularies and the organism by category grid."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions import classify, values
from ..functions.text import fold_key, present
from ..session import union

FACETS = {"organisms": "organism", "manufacturers": "manufacturer_name",
          "expert_laboratories": "expert_laboratory", "method_categories": "method_category",
          "sources": "source"}


def drop_sources(records: DataFrame, excluded=vocab.EXCLUDED_SOURCES, source: str = "source"
                 ) -> tuple[DataFrame, DataFrame]:
    """Records kept, and the number skipped per excluded source."""
    out = F.col(source).isin(*excluded)
    skipped = records.filter(out).groupBy(source).agg(F.count(F.lit(1)).alias("skipped"))
    return records.filter(F.coalesce(~out, F.lit(True))), skipped


def raw_categories(record_nature: Column, quantitative: Column, qualitative: Column,
                   matrices: Column) -> Column:
    """Mined category names by nature; only if there are none, the matrices."""
    empty = F.array().cast("array<string>")
    named = F.coalesce(F.when(record_nature == "quantitative", quantitative)
                       .when(record_nature == "qualitative", qualitative), empty)
    mined = F.filter(named, present)
    return F.when(F.size(mined) > 0, mined).otherwise(F.coalesce(matrices, empty))


def tested_categories(raw: Column) -> Column:
    """Distinct fixed categories of an array of raw names, in their own order.
    At most 18 entries, worked out inside the row."""
    mapped = F.transform(F.transform(raw, F.lower), lambda x: classify.food_category(x, key=x))
    known = F.filter(mapped, lambda x: x.isNotNull())
    ids = [cid for cid, _ in vocab.FOOD_CATEGORIES]
    labels = [label for _, label in vocab.FOOD_CATEGORIES]
    return F.array_compact(F.array(*[F.when(F.array_contains(known, cid), F.lit(label))
                                     for cid, label in zip(ids, labels)]))


def tested_categories_by_key(rows: DataFrame, key: str, raw: str) -> DataFrame:
    """The same from a long table (key, raw name): one row per key and fixed
    category. The rules run once per distinct name, and the names are joined
    back, so a row costs no rule."""
    names = rows.select(raw).distinct().withColumn("category", classify.food_category(F.col(raw))).filter("category IS NOT NULL")
    return (rows.select(key, raw).join(names, raw).select(key, "category").distinct()
            .withColumn("ord", classify.food_order(F.col("category")))
            .withColumn("label", classify.food_label(F.col("category"))))


def residual(rows: DataFrame, raw: str, label: Column, n: str = "n") -> DataFrame:
    """Values no rule knows, with counts; sort for a report with ``top``."""
    return (rows.filter(label.isNull() & F.col(raw).isNotNull())
            .groupBy(raw).agg(F.count(F.lit(1)).alias(n)))


def top(counts: DataFrame, raw: str, n: str = "n", limit: int | None = None) -> DataFrame:
    ordered = counts.orderBy(F.desc(n), raw)
    return ordered if limit is None else ordered.limit(limit)


def build_entries(records: DataFrame) -> DataFrame:
    """Canonical records to flat catalogue entries; map-only. The keys of the
    rule chains are staged first, see ``classify``."""
    maker, lab = F.col("manufacturer.name"), F.col("study_design.expert_laboratory")
    target = F.col("target_organism.normalized")
    records = records.withColumns({
        "_maker_key": fold_key(maker), "_organism_key": fold_key(target),
        "_lab_key": fold_key(lab), "_name_key": F.lower("commercial_name")})
    records = records.withColumns({
        "_technology": classify.technology(F.col("method_type.category"), F.col("commercial_name"),
                                           key=F.col("_name_key")),
        "_organism": classify.organism(target, key=F.col("_organism_key"))})
    category = F.col("_technology")
    perf = F.col("performance")
    raw = raw_categories(
        perf["method_nature"],
        perf["quantitative"]["relative_trueness_by_category"]["category"],
        perf["qualitative"]["method_comparison_by_category"]["category"],
        F.col("validation_scope.matrices"))
    tr = F.col("traceability")
    return records.select(
        "id", "source", "source_certificate_number", "commercial_name",
        classify.manufacturer(maker, key=F.col("_maker_key")).alias("manufacturer_name"),
        F.coalesce("_organism", F.lit("Unknown")).alias("organism"),
        category.isNull().alias("technology_unknown"),
        F.coalesce(category, F.lit("other")).alias("method_category"),
        classify.technology_label(F.coalesce(category, F.lit("other")))
        .alias("method_category_label"),
        F.col("method_type.action").alias("action"),
        classify.expert_lab(lab, key=F.col("_lab_key")).alias("expert_laboratory"),
        F.col("reference_method.standard").alias("reference_method"),
        F.coalesce("certification.status", F.lit("unknown")).alias("status"),
        F.col("certification.current_expiry").alias("current_expiry"),
        raw.alias("raw_categories"), tested_categories(raw).alias("tested_categories"),
        perf.isNotNull().alias("has_performance_data"),
        values.links(F.col("source"), tr["summary_report_pdf_url"], tr["certificate_pdf_url"],
                     tr["source_document_url"]).alias("links"))


def facet_rows(entries: DataFrame, facets: dict[str, str] = FACETS) -> DataFrame:
    """Unpivot of the facet columns to (facet, value); empty values drop out."""
    pairs = F.array(*[F.struct(F.lit(f).alias("facet"), F.col(c).cast("string").alias("value"))
                      for f, c in facets.items()])
    return (entries.select(F.explode_outer(pairs).alias("p")).select("p.facet", "p.value")
            .filter(present(F.col("value"))))


def facet_counts(entries: DataFrame, facets: dict[str, str] = FACETS) -> DataFrame:
    """Counts per facet value over the whole table, whatever is selected."""
    return facet_rows(entries, facets).groupBy("facet", "value").agg(
        F.count(F.lit(1)).alias("n"))


def facet_vocabulary(entries: DataFrame, facets: dict[str, str] = FACETS) -> DataFrame:
    """Distinct values; ``ordered`` gives the printed order."""
    return facet_counts(entries, facets).select("facet", "value")


def ordered_vocabulary(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.orderBy("facet", F.lower("value"), "value")


def collapsed_facets(counts: DataFrame, selected: DataFrame | None = None,
                     shown: int = vocab.COLLAPSED_FACET) -> DataFrame:
    """The most frequent values of each facet, any selected one, and how many
    stay hidden. The ranking is cut before the shuffle."""
    order = Window.partitionBy("facet").orderBy(F.desc("n"), "value")
    head = (counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= shown)
            .select("facet", "value", "n"))
    if selected is not None:
        head = union(head, counts.join(
            selected.select("facet", "value"), ["facet", "value"], "left_semi")).distinct()
    sizes = counts.groupBy("facet").agg(F.count(F.lit(1)).alias("_total"))
    seen = head.groupBy("facet").agg(F.count(F.lit(1)).alias("_seen"))
    return (head.join(sizes, "facet").join(seen, "facet")
            .withColumn("hidden", F.col("_total") - F.col("_seen")).drop("_total", "_seen"))


def grid_rows(entries: DataFrame, axis: str = "tested_categories") -> DataFrame:
    """One row per entry and category of the axis; an entry without tested
    categories counts under the not-mined column. ``first`` marks one row of
    each entry."""
    if not dict(entries.dtypes)[axis].startswith("array"):
        return entries.withColumn("category", F.col(axis)).withColumn("first", F.lit(True))
    cats = F.when(F.size(axis) > 0, F.col(axis)).otherwise(F.array(F.lit(vocab.NOT_MINED)))
    kept = [c for c in entries.columns if c != axis]
    return (entries.select(*kept, axis, F.posexplode_outer(cats).alias("_at", "category"))
            .withColumn("first", F.col("_at") == 0).drop("_at"))


def grid_counts(rows: DataFrame, organism: str = "organism") -> DataFrame:
    return rows.groupBy(organism, "category").agg(F.count(F.lit(1)).alias("n"))


def heatmap(entries: DataFrame, columns: list[str], axis: str = "tested_categories",
            organism: str = "organism") -> DataFrame:
    """Long grid over a fixed list of columns, zeros included, with the heat
    level and the organism's own count, which counts every entry once. One pass
    over the entries: counts per cell first, then one row per organism."""
    cells = grid_rows(entries, axis).groupBy(organism, "category").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("first").alias("_entries"))
    wide = cells.groupBy(organism).agg(F.sum("_entries").alias("organism_total"), *[
        F.sum(F.when(F.col("category") == c, F.col("n"))).alias(f"_n{i}")
        for i, c in enumerate(columns)])
    pairs = F.array(*[F.struct(F.lit(i + 1).alias("col_order"), F.lit(c).alias("category"),
                               F.coalesce(F.col(f"_n{i}"), F.lit(0)).alias("n"))
                      for i, c in enumerate(columns)])
    return (wide.select(organism, "organism_total", F.explode_outer(pairs).alias("p"))
            .select(organism, "organism_total", "p.*")
            .withColumn("heat", values.heat_level(F.col("n"))))


def fixed_columns() -> list[str]:
    return [label for _, label in vocab.FOOD_CATEGORIES] + [vocab.NOT_MINED]


def drill_down(rows: DataFrame, organism_value: str, category_value: str,
               organism: str = "organism") -> DataFrame:
    """Members of one cell, as a filter; no list is collected per cell."""
    return rows.filter((F.col(organism) == organism_value) & (F.col("category") == category_value))


def coverage(entries: DataFrame, flag: str = "has_performance_data") -> DataFrame:
    """Mined entries, all entries and the rounded percentage (0 when empty)."""
    agg = entries.agg(F.count_if(F.col(flag)).alias("mined"), F.count(F.lit(1)).alias("total"))
    return agg.withColumn("pct", F.when(F.col("total") == 0, 0).otherwise(
        F.floor(F.col("mined") * 100 / F.col("total") + 0.5)).cast("long"))
