"""Canonical records of the three registries as nested projections."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas, vocab
from ..functions import classify, values
from ..functions.text import (blank_to_null, find, record_id, split_list)


def _null(kind="string") -> Column:
    return F.lit(None).cast(kind)


def _strings() -> Column:
    return F.array().cast("array<string>")


def _typed(df: DataFrame, *extra: str) -> DataFrame:
    """Cast every canonical column to its declared type."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                       for f in schemas.CANONICAL.fields], *extra)


def renewal_and_extension(block: Column) -> tuple[Column, Column]:
    """Dates under the renewal and the extension label, in either order."""
    renewal = find(block, vocab.RENEWAL_DATES)
    extension = find(block, vocab.EXTENSION_DATES)
    return (F.coalesce(values.dotted_dates(renewal), _strings()),
            F.coalesce(values.dotted_dates(extension), _strings()))


def _study(protocol: str, study_type: Column | None = None, labs: Column | None = None) -> Column:
    return F.struct(
        F.lit(protocol).alias("protocol_standard"),
        (F.lit("unknown") if study_type is None else study_type).alias("study_type"),
        (_null("int") if labs is None else labs).alias("number_of_labs"),
        _null("int").alias("number_of_samples"), _null().alias("expert_laboratory"))


def _scope(raw: Column, matrices: Column | None = None) -> Column:
    return F.struct(raw.alias("raw"), (_strings() if matrices is None else matrices).alias("matrices"),
                    _strings().alias("excluded_matrices"), _null("double").alias("max_test_portion_g"))


def from_list_and_pages(matched: DataFrame, today, key: str = "certificate_number") -> DataFrame:
    """Records of the registry with two collectors. The live page wins, except
    for scope text, dates and address, which only the list has. Input is
    ``match_sources``; columns ``boot`` and ``page`` follow the raw schemas."""
    boot, page = F.col("boot"), F.col("page")
    has_boot, has_page = boot.isNotNull(), page.isNotNull()
    holder = boot["company_holder_raw"]
    renewals, extensions = renewal_and_extension(F.coalesce(boot["raw_block"], F.lit("")))
    expiry = F.try_to_date(boot["end_of_validity"], "yyyy-MM-dd")
    note = F.when(~has_page, vocab.NOTE_NO_PAGE).when(~has_boot, vocab.NOTE_NO_LIST)
    target = F.when(has_page, page["target_organism"]).when(
        blank_to_null(boot["target_organism"]).isNotNull(),
        F.struct(boot["target_organism"].alias("normalized"),
                 boot["aim_of_method_raw"].alias("raw")))
    link = page["traceability"]
    out = matched.select(
        record_id(F.lit("nf-validation"), F.col(key)).alias("id"),
        F.lit("NF-VALIDATION").alias("source"),
        F.col(key).alias("source_certificate_number"),
        F.coalesce(blank_to_null(page["commercial_name"]), blank_to_null(boot["commercial_name"]),
                   F.lit("UNKNOWN")).alias("commercial_name"),
        F.struct(
            F.coalesce(blank_to_null(page["manufacturer"]["name"]), F.trim(find(holder, vocab.HOLDER_NAME))).alias("name"),
            blank_to_null(holder).alias("address_raw"),
            _null().alias("represented_in_europe"),
            _null().alias("site_of_production")).alias("manufacturer"),
        F.struct(F.when(has_page, page["method_type"]["action"]).otherwise(boot["action"])
                 .alias("action"),
                 page["method_type"]["category"].alias("category")).alias("method_type"),
        F.struct(target["normalized"].alias("normalized"),
                 target["raw"].alias("raw")).alias("target_organism"),
        F.struct(page["reference_method"]["standard"].alias("standard"),
                 page["reference_method"]["raw"].alias("raw")).alias("reference_method"),
        _scope(F.coalesce(blank_to_null(boot["validation_scope_raw"]),
                          F.when(has_page, vocab.MISSING_SCOPE["page"]), F.lit("")))
        .alias("validation_scope"),
        _study(vocab.STUDY_PROTOCOL["NF-VALIDATION"]).alias("study_design"),
        F.struct(F.try_to_date(boot["certification_date"], "yyyy-MM-dd").alias("original_date"),
                 renewals.alias("renewal_dates"), extensions.alias("extension_dates"),
                 expiry.alias("current_expiry"),
                 values.status_from_expiry(expiry, today).alias("status")).alias("certification"),
        _null(schemas.PERFORMANCE).alias("performance"),
        F.struct(F.when(has_page, "live_web_page").otherwise("certificate_list_pdf")
                 .alias("source_document_type"),
                 link["source_document_url"].alias("source_document_url"),
                 link["certificate_pdf_url"].alias("certificate_pdf_url"),
                 link["summary_report_pdf_url"].alias("summary_report_pdf_url"),
                 page["organism_page_last_updated_raw"].alias("organism_page_last_updated_raw"),
                 _null().alias("extraction_date"),
                 F.when(has_page & has_boot, "high").otherwise("medium")
                 .alias("extraction_confidence"),
                 note.alias("notes")).alias("traceability"),
        F.col("outcome"))
    return _typed(out, "outcome")


def from_list_rows(raw: DataFrame, today) -> DataFrame:
    """Records of the list-and-detail registry."""
    expiry = values.day_month_year(F.col("expiry_date_raw"))
    out = raw.select(
        record_id(F.lit("microval"), F.col("certificate_number")).alias("id"),
        F.lit("MICROVAL").alias("source"),
        F.col("certificate_number").alias("source_certificate_number"),
        F.col("commercial_name"),
        F.struct(F.col("manufacturer_raw").alias("name"), _null().alias("address_raw"),
                 _null().alias("represented_in_europe"),
                 _null().alias("site_of_production")).alias("manufacturer"),
        F.struct(_null().alias("action"),
                 classify.technology_from_list_name(F.col("commercial_name")).alias("category"))
        .alias("method_type"),
        F.struct(classify.analyte(F.col("analyte_raw")).alias("normalized"),
                 F.col("analyte_raw").alias("raw")).alias("target_organism"),
        F.struct(F.col("reference_method_raw").alias("standard"),
                 F.col("reference_method_raw").alias("raw")).alias("reference_method"),
        _scope(F.coalesce(blank_to_null(F.col("matrices_raw")),
                          F.lit(vocab.MISSING_SCOPE["list"])),
               split_list(F.col("matrices_raw"))).alias("validation_scope"),
        _study(vocab.STUDY_PROTOCOL["MICROVAL"]).alias("study_design"),
        F.struct(values.day_month_year(F.col("first_approval_date_raw")).alias("original_date"),
                 _strings().alias("renewal_dates"), _strings().alias("extension_dates"),
                 expiry.alias("current_expiry"),
                 values.status_as_stated(F.col("status_raw"), expiry, today).alias("status"))
        .alias("certification"),
        _null(schemas.PERFORMANCE).alias("performance"),
        F.struct(F.lit("live_web_page").alias("source_document_type"),
                 F.col("source_page_url").alias("source_document_url"),
                 _null().alias("certificate_pdf_url"),
                 F.col("summary_report_pdf_url").alias("summary_report_pdf_url"),
                 _null().alias("organism_page_last_updated_raw"),
                 _null().alias("extraction_date"),
                 F.lit("high").alias("extraction_confidence"),
                 values.list_note(F.col("label"), F.col("status_raw"), F.col("expiry_date_raw"),
                                  F.col("certificate_pdf_url"), F.col("summary_report_pdf_url"))
                 .alias("notes")).alias("traceability"))
    return _typed(out)


def from_certificates(raw: DataFrame, today, notes: str = vocab.NOTE_CERTIFICATE) -> DataFrame:
    """Records of the registry that prints one certificate per method. There is
    performance only when a strain panel was counted."""
    incl, excl = F.col("inclusivity"), F.col("exclusivity")
    counted = incl["n_tested"].isNotNull() | excl["n_tested"].isNotNull()
    independent = blank_to_null(F.col("independent_laboratory_raw")).isNotNull()
    expiry = F.try_to_date(F.col("expiration_date").cast("string"), "yyyy-MM-dd")
    performance = F.when(counted, F.struct(
        F.lit("qualitative").alias("method_nature"),
        _null(schemas.PERFORMANCE["quantitative"].dataType).alias("quantitative"),
        F.struct(
            F.from_json(F.lit("[]"), schemas.T.ArrayType(schemas.QUALITATIVE_ROW))
            .alias("method_comparison_by_category"),
            F.when(incl["n_tested"].isNotNull(), incl).alias("inclusivity"),
            F.when(excl["n_tested"].isNotNull(), excl).alias("exclusivity")).alias("qualitative")))
    out = raw.select(
        record_id(F.lit("aoac-ri"), F.col("certificate_number")).alias("id"),
        F.lit("AOAC-RI").alias("source"),
        F.col("certificate_number").alias("source_certificate_number"),
        F.coalesce(blank_to_null(F.col("method_name")), F.lit("UNKNOWN")).alias("commercial_name"),
        F.struct(F.col("manufacturer_name").alias("name"),
                 F.col("manufacturer_address_raw").alias("address_raw"),
                 _null().alias("represented_in_europe"),
                 _null().alias("site_of_production")).alias("manufacturer"),
        F.struct(F.lit("detection").alias("action"), F.col("category_guess").alias("category"))
        .alias("method_type"),
        F.struct(F.col("target_organism").alias("normalized"),
                 F.col("target_organism_raw").alias("raw")).alias("target_organism"),
        F.struct(_null().alias("standard"), F.col("reference_method_raw").alias("raw"))
        .alias("reference_method"),
        _scope(F.coalesce(blank_to_null(F.col("matrices_raw")),
                          F.lit(vocab.MISSING_SCOPE["certificate"])),
               F.coalesce(F.col("matrices"), _strings())).alias("validation_scope"),
        _study(vocab.STUDY_PROTOCOL["AOAC-RI"],
               F.when(independent, "multi-lab").otherwise("unknown"),
               F.when(independent, 2)).alias("study_design"),
        F.struct(F.try_to_date(F.col("original_certification_date").cast("string"), "yyyy-MM-dd")
                 .alias("original_date"),
                 _strings().alias("renewal_dates"), _strings().alias("extension_dates"),
                 expiry.alias("current_expiry"),
                 values.status_from_expiry(expiry, today).alias("status")).alias("certification"),
        performance.alias("performance"),
        F.struct(F.lit("certificate_pdf").alias("source_document_type"),
                 _null().alias("source_document_url"), _null().alias("certificate_pdf_url"),
                 _null().alias("summary_report_pdf_url"),
                 _null().alias("organism_page_last_updated_raw"),
                 _null().alias("extraction_date"), F.lit("medium").alias("extraction_confidence"),
                 F.lit(notes).cast("string").alias("notes")).alias("traceability"))
    return _typed(out)
