"""Certificates whose text holds everything: sections, header, strain panels.

A row is one certificate text. All arrays are cut from that text inside the
row, so nothing is shuffled.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions import classify, values
from ..functions.text import blank_to_null, find, split_list, squeeze, strip


def _needle(pattern: str) -> str:
    """Upper-case text that every match of a heading contains."""
    branches = [re.sub(r".\?|\\[a-z]\*?|\\d\+|[.*+?:]", "\n", b.replace(r"\.", "\n"))
                for b in pattern.split("|")]
    fixed = {max(b.split("\n"), key=len).upper() for b in branches}
    if len(fixed) != 1:
        raise ValueError(f"no common text in {pattern!r}")
    return fixed.pop()


#: Characters beside the two cases that Java takes for a letter when case is ignored.
_ALIKE = {"i": "\u0131\u0130", "k": "\u212a", "s": "\u017f"}


def _searched(pattern: str) -> str:
    """The heading in any case. The first letter is looked at, in a plain class, before the word
    boundary and the folding of case, which are dear to try at every place."""
    def first(m: re.Match) -> str:
        letter = m[3].lower()
        return rf"{m[1]}(?-i:(?=[{letter.upper()}{letter}{_ALIKE.get(letter, '')}])){m[2] or ''}{m[3]}"

    return "(?iU)" + re.sub(r"(^|\|)(\\b)?([A-Za-z])", first, pattern)


def _size(text: Column, pattern: str) -> Column:
    """Length of the first match. That of plain words is known without another search."""
    words = re.sub(r"^\\b|\\b$", "", pattern)
    return F.lit(len(words)) if re.fullmatch("[A-Za-z ]+", words) else F.length(F.regexp_substr(text, F.lit(_searched(pattern))))


def with_sections(docs: DataFrame, name: str, text: str = "text",
                  headings=vocab.SECTION_HEADINGS) -> DataFrame:
    """Add an array of (section, text): each heading's first hit, up to the
    next hit.

    A plain substring test picks the headings a text has at all, and only those
    are searched by regular expression. Each heading is a branch with a fixed pattern,
    which is compiled once a task: as data of a loop, patterns would be compiled for every
    text. The branches stand in a filter's array, which keeps them out of generated methods.
    """
    def hit(key: str, pattern: str) -> Column:
        return F.when(F.contains("_upper", F.lit(_needle(pattern))), F.struct(
            F.regexp_instr(text, F.lit(_searched(pattern))).alias("start"), _size(F.col(text), pattern).alias("size"), F.lit(key).alias("name")))

    hits = F.filter(F.array(*[hit(key, p) for key, p in headings]), lambda h: h["start"] > 0)
    staged = docs.withColumn("_upper", F.upper(text)).withColumn("_found", F.array_sort(hits)).drop("_upper")
    found = F.col("_found")

    def cut(hit: Column, i: Column) -> Column:
        begin = hit["start"] + hit["size"]
        follow = F.try_element_at(found, (i + 2).cast("int"))
        stop = F.coalesce(follow["start"], F.length(text) + 1)
        return F.struct(hit["name"].alias("section"), squeeze(
            F.substr(F.col(text), begin, F.greatest(stop - begin, F.lit(0)))).alias("text"))

    return staged.withColumn(name, F.transform(found, cut)).drop("_found")


def sections(docs: DataFrame, doc: str = "doc_id", text: str = "text",
             headings=vocab.SECTION_HEADINGS) -> DataFrame:
    """Long form: (document, section, text)."""
    return (with_sections(docs.select(doc, text), "_s", text, headings)
            .select(doc, F.explode_outer("_s").alias("s")).filter("s IS NOT NULL").select(doc, "s.section", "s.text"))


def section_of(array: Column, name: str) -> Column:
    hit = F.filter(array, lambda s: s["section"] == name)
    return F.try_element_at(hit, F.lit(1))["text"]


def header_fields(text: Column, maker: Column) -> Column:
    """Header of a certificate. ``maker`` is the staged maker passage: its first
    line is the company, the rest the address."""
    lines = F.filter(F.transform(F.split(maker, "\n"), strip), lambda x: x != "")
    day = r"([A-Za-z]+ \d{1,2},?\s*\d{4})"
    return F.struct(
        find(text, vocab.CERTIFICATE_NUMBER).alias("certificate_number"),
        F.nullif(squeeze(find(
            text, vocab.CERTIFICATE_NAME)),
            F.lit("")).alias("method_name"),
        squeeze(maker).alias("manufacturer_raw"),
        F.try_element_at(lines, F.lit(1)).alias("manufacturer_name"),
        F.when(F.size(lines) > 1, F.array_join(
            F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0))), ", "))
        .alias("manufacturer_address_raw"),
        values.english_date(find(text, r"(?U)Issue Date\s+" + day)).alias("issue_date"),
        values.english_date(find(text, r"(?U)Expiration Date\s+" + day)).alias("expiration_date"))


def applicability(section: Column) -> tuple[Column, Column]:
    """Target organisms and matrices as stated, without the final full stop."""
    target = find(section, vocab.TARGET_CLAIM)
    matrices = find(section, vocab.MATRIX_CLAIM)

    def clean(c: Column) -> Column:
        return F.rtrim(F.trim(c), F.lit("."))

    return clean(target), clean(matrices)


def matrix_column(text: Column) -> Column:
    """Distinct sorted values of a printed matrix column, the fallback."""
    found = F.regexp_extract_all(
        text, F.lit(vocab.MATRIX_COLUMN), 1)
    return F.array_sort(F.array_distinct(F.transform(found, lambda x: F.trim(x))))


def panel_table(text: Column, panel: str) -> Column:
    """Text of the table named ``panel``, up to the next numbered table."""
    return F.regexp_extract(
        text, rf"(?sU)(?=[Tt])(?i:Table\s*\d+\.\s*{panel})(.*?)(?:\bTable\s*\d+\.|\z)", 1)


def strain_matches(table: Column) -> Column:
    """Array of the printed rows of a strain table. A symbol may carry footnote
    letters; rows without a symbol are not rows."""
    return F.regexp_extract_all(table, F.lit(vocab.STRAIN_ROW), 0)


def strain_row(printed: Column) -> Column:
    """(strain, symbol) of one printed row."""
    return F.struct(squeeze(F.regexp_extract(printed, vocab.STRAIN_ROW, 1)).alias("strain"),
                    F.regexp_extract(printed, vocab.STRAIN_ROW, 2).alias("symbol"))


def strain_rows(text: Column, panel: str) -> Column:
    """Array of (strain, symbol) of the table named ``panel``."""
    return F.transform(strain_matches(panel_table(text, panel)), strain_row)


def _panel(tested, correct, discrepancies) -> Column:
    none = F.array().cast("array<struct<strain:string,note:string>>")
    return F.struct(tested.cast("int").alias("n_tested"),
                    correct.cast("int").alias("n_correctly_detected"),
                    F.coalesce(discrepancies, none).alias("discrepancies"))


def panels(story: Column, table: Column, incl_rows: Column, excl_rows: Column
           ) -> tuple[Column, Column, Column]:
    """Inclusivity, exclusivity and the text they came from. Takes the
    discussion, the selectivity table and the two arrays of strain rows.

    Counts come from the narrative, else from the strain rows, else (when
    neither panel was counted) from the compact selectivity table. Exceptions
    always come from the strain rows. For exclusivity, correct means not
    detected."""
    incl_re, excl_re = vocab.INCLUSIVITY_STORY, vocab.EXCLUSIVITY_STORY

    def number(c: Column) -> Column:
        return c.try_cast("int")

    def group(pattern: str, i: int) -> Column:
        return find(story, pattern, i)

    incl_told, excl_told = story.rlike(incl_re), story.rlike(excl_re)
    incl_n = number(group(incl_re, 1))
    incl_ok = F.when(incl_told, F.coalesce(number(group(incl_re, 3)), F.lit(0)))
    excl_n = number(group(excl_re, 1))
    excl_ok = excl_n - F.coalesce(number(group(excl_re, 3)), F.lit(0))

    def from_rows(rows: Column, good: str, note: str):
        bad = F.transform(F.filter(rows, lambda r: r["symbol"] != good), lambda r: F.struct(
            r["strain"].alias("strain"),
            F.concat(F.lit(note), r["symbol"], F.lit(")")).alias("note")))
        ok = F.size(F.filter(rows, lambda r: r["symbol"] == good))
        has = F.size(rows) > 0
        return has, F.when(has, F.size(rows)), F.when(has, ok), F.when(has, bad)

    i_has, i_rows, i_ok, i_bad = from_rows(incl_rows, "+", vocab.NOTE_MISSED)
    e_has, e_rows, e_ok, e_bad = from_rows(excl_rows, "-",
                                           vocab.NOTE_CROSS)
    compact = vocab.SELECTIVITY_ROW
    use_compact = (~incl_told & ~excl_told & ~i_has & ~e_has & table.rlike(compact))

    def cell(i: int) -> Column:
        return F.when(use_compact, number(find(table, compact, i)))

    incl = _panel(F.coalesce(F.when(incl_told, incl_n), i_rows, cell(1)),
                  F.when(incl_told, incl_ok).otherwise(F.coalesce(i_ok, cell(2))), i_bad)
    excl = _panel(F.coalesce(F.when(excl_told, excl_n), e_rows, cell(3)),
                  F.when(excl_told, excl_ok).otherwise(F.coalesce(e_ok, cell(3) - cell(4))), e_bad)
    source = (F.when(incl_told | excl_told, F.substring(story, 1, 600))
              .when(use_compact, F.substring(table, 1, 400))
              .when(i_has | e_has, vocab.NOTE_COUNTED))
    return incl, excl, source


def strain_table(docs: DataFrame, doc: str = "doc_id", text: str = "text",
                 panel_names=("Inclusivity", "Exclusivity")) -> DataFrame:
    """Long form: (document, panel, strain, symbol). Tables are cut in a projection
    of their own and their rows exploded as printed, so each is searched once."""
    cut = docs.select(doc, *[panel_table(F.col(text), p).alias(f"_{p}") for p in panel_names])
    tables = cut.select(doc, F.explode(F.array(*[F.struct(
        F.lit(p.lower()).alias("panel"), F.col(f"_{p}").alias("table")) for p in panel_names])).alias("t"))
    printed = tables.select(doc, "t.panel", F.explode(strain_matches(F.col("t.table"))).alias("_row"))
    return printed.select(doc, "panel", strain_row(F.col("_row")).alias("r")).select(doc, "panel", "r.*")


def certificate_records(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Certificate texts to raw certificate records, in one map-only stage."""
    t = F.col(text)
    s = F.col("_s")
    # Staged so that each text is searched once per pattern.
    staged = (with_sections(docs.select(doc, text), "_s", text)
              .withColumn("_maker", find(t, vocab.CERTIFICATE_MAKER))
              .withColumns({"_h": header_fields(t, F.col("_maker")), "_incl": strain_rows(t, "Inclusivity"),
                            "_excl": strain_rows(t, "Exclusivity"),
                            "_story": F.coalesce(section_of(s, "discussion"), F.lit("")),
                            "_table": F.coalesce(section_of(s, "method_selectivity_table"),
                                                 F.lit("")),
                            "_scope": section_of(s, "applicability")}))
    target, matrices = applicability(F.col("_scope"))
    staged = staged.withColumns({"_target": target, "_matrices": matrices}).withColumn(
        "_listed", split_list(F.col("_matrices"), on_and=True))
    target_raw, matrices_raw, listed = F.col("_target"), F.col("_matrices"), F.col("_listed")
    incl, excl, source = panels(F.col("_story"), F.col("_table"), F.col("_incl"), F.col("_excl"))
    # One projection per panel keeps each generated method short enough to be compiled.
    staged = (staged.withColumn("_inclusivity", incl).withColumn("_exclusivity", excl)
              .withColumn("_source", source))
    claim = section_of(s, "certified_claim_statement")
    name = F.col("_h.method_name")

    def sec(key: str, alias: str) -> Column:
        return blank_to_null(section_of(s, key)).alias(alias)

    return staged.select(
        doc, F.lit("AOAC-RI").alias("source"), "_h.*",
        sec("authors", "authors_raw"), sec("submitting_company", "submitting_company_raw"),
        sec("independent_laboratory", "independent_laboratory_raw"),
        sec("catalog_numbers", "catalog_numbers_raw"),
        target_raw.alias("target_organism_raw"),
        classify.target_of_certificate(target_raw, claim, name).alias("target_organism"),
        classify.technology_from_sections(section_of(s, "principle"), name, claim)
        .alias("category_guess"),
        matrices_raw.alias("matrices_raw"),
        F.when(F.size(listed) > 0, listed).otherwise(matrix_column(t)).alias("matrices"),
        sec("reference_method", "reference_method_raw"),
        values.english_date(section_of(s, "original_certification_date"))
        .alias("original_certification_date"),
        sec("certification_renewal_record", "certification_renewal_record_raw"),
        F.col("_inclusivity").alias("inclusivity"), F.col("_exclusivity").alias("exclusivity"),
        F.col("_source").alias("inclusivity_exclusivity_source_text"))
