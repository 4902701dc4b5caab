"""Whole jobs: from raw tables to a snapshot, and from a snapshot to a catalogue."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions import values
from ..operators import canonical, catalogue, cells, evidence, pages, reconcile, report, snapshot
from ..session import materialize


def reconcile_registry(page_records: DataFrame, bootstrap: DataFrame, today,
                       previous: DataFrame | None = None) -> dict[str, DataFrame]:
    """Two collectors of one registry to a new snapshot. ``page_records`` needs
    ``file`` beside the raw page schema. Gives ``records``, ``rejected``,
    ``unresolved`` and ``outcomes``."""
    derived = (page_records.withColumn("certificate_number", values.certificate_from_url(
        F.col("traceability.certificate_pdf_url")))
        .withColumn("_date", values.french_date(F.col("organism_page_last_updated_raw"))))
    boot = reconcile.latest_rows(bootstrap, ["certificate_number"],
                                 ["file"] if "file" in bootstrap.columns else ["raw_block"])
    latest, unresolved = reconcile.latest_resolved(derived, boot, ["_date", "file"])
    matched = reconcile.match_sources(boot, latest)
    records = canonical.from_list_and_pages(matched, today)
    outcomes = reconcile.outcome_counts(records)
    fresh = records.drop("outcome")
    if previous is not None:
        fresh = snapshot.preserve_mined_fields(fresh, previous)
    good, bad = snapshot.split_valid(fresh, snapshot.canonical_checks())
    return {"records": good, "rejected": bad, "unresolved": unresolved, "outcomes": outcomes}


def build_catalogue(records: DataFrame, excluded=vocab.EXCLUDED_SOURCES) -> dict[str, DataFrame]:
    """Canonical records to the catalogue and its reports. Write ``entries``
    with ``sources.registry.write_catalogue`` before serving from it."""
    kept, skipped = catalogue.drop_sources(records, excluded)
    entries = catalogue.build_entries(kept)
    mentions = entries.select(F.explode_outer("raw_categories").alias("raw")).filter("raw IS NOT NULL")
    from ..functions.classify import food_category
    return {
        "entries": entries, "skipped": skipped,
        "facets": catalogue.facet_counts(entries),
        "heatmap": catalogue.heatmap(entries, catalogue.fixed_columns()),
        "coverage": catalogue.coverage(entries),
        "unknown_categories": catalogue.residual(mentions, "raw", food_category(F.col("raw"))),
        "unknown_technology": entries.filter("technology_unknown").groupBy("commercial_name")
        .agg(F.count(F.lit(1)).alias("n")),
    }


def mine_reports(report_pages: DataFrame, report_cells: DataFrame) -> DataFrame:
    """Pages and cells to mined performance, one row per report of a known
    nature: (doc_id, certificate_number, method_nature, performance,
    mining_notes). One answer for a report of any length."""
    cover = materialize(report.cover_metadata(report_pages), "cover")
    told = materialize(report.prose(report_pages), "told")
    table_rows = cells.table_rows(report_cells)
    trueness = cells.relative_trueness(table_rows)
    profile = report.accuracy_profile(trueness, report.repeatability_lines(report_pages))
    mined = report.quantitative_performance(cover, trueness, profile, told).unionByName(
        report.qualitative_performance(cover, cells.method_comparison(table_rows), told))
    return mined.withColumn("mining_notes", F.concat(
        F.lit("Mined from report "), F.col("doc_id").cast("string"), F.lit(".")))


def merge_mined(records: DataFrame, report_pages: DataFrame, report_cells: DataFrame
                ) -> dict[str, DataFrame]:
    """Mine reports and put what is found on the records with the same number.
    Gives ``records``, ``rejected`` (records a merge made invalid), and
    ``outcomes``: one row (doc_id, certificate_number, outcome) per report:
    merged, superseded (a later report has the number), invalid, no_record,
    no_number or no_nature."""
    mined = materialize(mine_reports(report_pages, report_cells), "mined")
    merged, _ = snapshot.merge_performance(records, mined)
    good, bad = snapshot.split_valid(merged, snapshot.canonical_checks())
    reports = report_pages.select("doc_id").distinct().join(mined.select("doc_id", "certificate_number", "method_nature"), "doc_id", "left")
    winners = (mined.filter("certificate_number IS NOT NULL").groupBy("certificate_number")
               .agg(F.max("doc_id").alias("_last")))
    known = records.groupBy(F.col("source_certificate_number").alias("certificate_number")).agg(F.lit(True).alias("_known"))
    spoilt = bad.groupBy(F.col("source_certificate_number").alias("certificate_number")).agg(F.lit(True).alias("_bad"))
    judged = reports.join(winners, "certificate_number", "left").join(known, "certificate_number", "left").join(
        spoilt, "certificate_number", "left")
    outcome = (F.when(F.col("method_nature").isNull(), "no_nature").when(F.col("certificate_number").isNull(), "no_number")
               .when(F.col("_known").isNull(), "no_record").when(F.col("doc_id") != F.col("_last"), "superseded")
               .when(F.col("_bad"), "invalid").otherwise("merged"))
    return {"records": good, "rejected": bad, "outcomes": judged.select("doc_id", "certificate_number", outcome.alias("outcome"))}


def read_evidence(report_pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Laboratory and technology evidence from the opening pages."""
    opening = evidence.opening_pages(report_pages)
    return evidence.find_expert_lab(opening), evidence.text_technology(opening)


def pages_to_send(report_pages: DataFrame, budget: int = vocab.PAGE_BUDGET) -> DataFrame:
    """Selected pages with their text. Only (document, page, score) shuffles
    before the choice; text is joined back for the chosen pages alone."""
    chosen = pages.select_pages(pages.score_pages(report_pages), budget)
    return report_pages.join(chosen, ["doc_id", "page_no"], "left_semi")
