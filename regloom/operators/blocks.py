"""Certificate blocks of a registry's list document (one row per page)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import vocab
from ..functions import classify, values
from ..functions.text import find, squeeze, strip

ANY_DATE = r"\b\d{2}[./]\d{2}[./]\d{4}\b"


def split_blocks(pages: DataFrame, anchor: str = vocab.BLOCK_ANCHOR, doc: str = "doc_id",
                 page: str = "page_no", text: str = "text", carry=()) -> DataFrame:
    """Cut each page at lines that start with an anchor; text before the first
    anchor belongs to no block. Map-only. ``pos`` orders blocks in a page."""
    cut = F.split(F.col(text), rf"(?mU)(?=^(?:{anchor}))")
    return (pages.select(doc, page, *carry, F.posexplode_outer(cut).alias("pos", "block"))
            .withColumn("block_id", find(F.col("block"), rf"(?U)^({anchor})"))
            .filter("block_id IS NOT NULL"))


def first_blocks(blocks: DataFrame, scope: list[str] | None = None, page: str = "page_no",
                 ) -> DataFrame:
    """The first block of each identifier, in page order."""
    keys = [*(scope or []), "block_id"]
    rest = [c for c in blocks.columns if c not in keys]
    best = blocks.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(page, "pos")).alias("_b"))
    return best.select(*keys, "_b.*").select(*blocks.columns)


def with_company(pages: DataFrame, text: str = "text", width: int = 600) -> DataFrame:
    """Page-level company header between its two cues."""
    raw = F.regexp_extract(F.col(text), vocab.COMPANY_HEADER, 1)
    found = F.col(text).rlike(vocab.COMPANY_HEADER)
    return pages.withColumn("company_holder_raw",
                            F.when(found, F.substring(squeeze(raw), 1, width)))


def list_dates(pages: DataFrame, doc: str = "doc_id", page: str = "page_no", text: str = "text",
               first_page: int = 0) -> DataFrame:
    """Validity date printed on the first page: one row per document."""
    printed = find(F.col(text), vocab.LIST_DATE)
    return (pages.filter(F.col(page) == first_page)
            .select(doc, F.concat_ws("-", F.substring(printed, 7, 4), F.substring(printed, 4, 2),
                                     F.substring(printed, 1, 2)).alias("_d"), printed.alias("_p"))
            .filter("_p IS NOT NULL").groupBy(doc).agg(F.min("_d").alias("pdf_list_valid_on")))


def block_fields(blocks: DataFrame) -> DataFrame:
    """Fields of one certificate block, as the bootstrap record has them."""
    block = strip(F.col("block"))
    body = strip(F.substr(F.col("_block"), F.length("block_id") + 1))
    at = F.regexp_instr(F.col("_body"), F.lit(vocab.AIM_WORD))
    rest = F.when(at > 0, F.substr(F.col("_body"), at))
    cue = F.regexp_instr(F.col("_rest"), F.lit(vocab.SCOPE_WORD))
    after = F.when(cue > 0, F.substr(F.col("_rest"), cue))
    date_at = F.regexp_instr(F.col("_after"), F.lit(ANY_DATE))
    aim = F.when(cue > 0, F.substr(F.col("_rest"), F.lit(1), cue - 1)).otherwise(F.col("_rest"))
    scope = F.when(date_at > 0, F.substr(F.col("_after"), F.lit(1), date_at - 1)) \
        .otherwise(F.col("_after"))

    def capped(c, n):
        return F.nullif(F.substring(squeeze(c), 1, n), F.lit(""))

    staged = (blocks.withColumn("_block", block).withColumn("_body", body)
              .withColumn("_rest", rest).withColumn("_after", after)
              .withColumn("_aim", aim).withColumn("_scope", scope)
              .withColumn("_at", at).withColumn("_dates", values.dotted_dates(F.col("_block"))))
    subject = F.coalesce(F.nullif(F.trim("_aim"), F.lit("")), F.col("_block"))
    name = F.when(F.col("_at") > 0,
                  F.nullif(squeeze(F.substr(F.col("_body"), F.lit(1), F.col("_at") - 1)),
                           F.lit("")))
    carried = [c for c in blocks.columns if c not in ("block", "pos", "block_id")]
    return staged.select(
        *carried,
        F.col("block_id").alias("certificate_number"), F.lit("NF-VALIDATION").alias("source"),
        name.alias("commercial_name"), capped(F.col("_aim"), 500).alias("aim_of_method_raw"),
        classify.target_of_list(subject).alias("target_organism"),
        classify.action(subject).alias("action"),
        capped(F.col("_scope"), 1000).alias("validation_scope_raw"),
        F.try_element_at("_dates", F.lit(1)).alias("certification_date"),
        F.try_element_at("_dates", F.lit(-1)).alias("end_of_validity"),
        F.col("_dates").alias("all_dates_found"),
        F.substring(squeeze(F.col("_block")), 1, 2000).alias("raw_block"))


def bootstrap_records(pages: DataFrame, last_page: int | None = None, doc: str = "doc_id",
                      page: str = "page_no", text: str = "text") -> DataFrame:
    """The whole list document to bootstrap records. ``last_page`` bounds the
    pages that hold records and is pushed into the scan."""
    body = pages if last_page is None else pages.filter(F.col(page) < last_page)
    blocks = split_blocks(with_company(body, text), doc=doc, page=page, text=text,
                          carry=["company_holder_raw"])
    fields = block_fields(first_blocks(blocks, [doc], page))
    return (fields.join(list_dates(pages, doc, page, text), doc, "left")
            .withColumn("source_page", F.col(page) + 1)
            .withColumn("provenance", F.struct(
                F.lit("bootstrap_pdf_import").alias("source_type"),
                F.lit(None).cast("string").alias("note"),
                F.col("pdf_list_valid_on"))).drop("pdf_list_valid_on", page))
