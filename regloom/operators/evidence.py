"""Laboratory names, technology evidence and evidence lines from report pages."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import vocab
from ..functions import classify
from ..functions.text import find, strip
from ..session import union
from . import stitch


def opening_pages(pages: DataFrame, n: int | None = vocab.OPENING_PAGES,
                  page: str = "page_no") -> DataFrame:
    """The first pages of each report; the bound is pushed into the scan."""
    return pages if n is None else pages.filter(F.col(page) < n)


def keyword_hits(pages: DataFrame, classes=vocab.TEXT_TECHNOLOGY, doc: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Distinct keywords of each class per document, over all its pages.

    One boolean maximum per keyword, combined before the shuffle: a document
    sends one row of flags per task however many pages it has.
    """
    low = pages.select(doc, F.lower(F.col(text)).alias("_t"))
    flags = [F.max(F.contains(F.col("_t"), F.lit(word))).alias(f"_k{i}_{j}")
             for i, (_, words) in enumerate(classes) for j, word in enumerate(words)]
    agg = low.groupBy(doc).agg(*flags)
    return agg.select(doc, *[
        sum((F.coalesce(F.col(f"_k{i}_{j}"), F.lit(False)).cast("int") for j in range(len(words))),
            F.lit(0)).alias(name)
        for i, (name, words) in enumerate(classes)])


def text_technology(pages: DataFrame, classes=vocab.TEXT_TECHNOLOGY, least: int = vocab.MIN_EVIDENCE,
                    doc: str = "doc_id", text: str = "text") -> DataFrame:
    """First class in order with ``least`` distinct keywords, else null."""
    hits = keyword_hits(pages, classes, doc, text)
    chain = None
    for name, _ in classes:
        test = F.col(name) >= least
        chain = F.when(test, name) if chain is None else chain.when(test, name)
    return hits.select(doc, chain.alias("evidence"))


def trim_capture(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, "(?U)" + vocab.LAB_CAPTURE_TAIL, ""))


def find_expert_lab(pages: DataFrame, tokens=vocab.KNOWN_LAB_TOKENS, sentences=vocab.LAB_SENTENCES,
                    patterns=vocab.EXPERT_LAB_PATTERNS, doc: str = "doc_id",
                    page: str = "page_no", text: str = "text", stopwords=vocab.LAB_STOPWORDS) -> DataFrame:
    """Known names anywhere in the text first, in list order; else the first
    sentence pattern whose capture is acceptable. Sentences may run over page
    breaks: what begins on one page and ends on a later one is found where they
    meet, and of each pattern the first match in the document counts."""
    low = F.lower(F.col(text))
    rank = None
    for i, token in enumerate(tokens):
        test = F.contains(low, F.lit(token.lower()))
        rank = F.when(test, i) if rank is None else rank.when(test, i)
    captures = [trim_capture(find(F.col(text), "(?U)" + s)) for s in sentences]
    inside = pages.select(doc, page, F.lit(0).alias("_part"), rank.alias("_rank"),
                          *[c.alias(f"_c{i}") for i, c in enumerate(captures)])
    meeting = stitch.seams(stitch.forms(pages, doc, page, text, ("lined",)), doc, page, ("lined",))
    over = [F.try_element_at(stitch.crossing(F.col("lined"), F.col("lined_cut"), "(?U)" + s), F.lit(1)) for s in sentences]
    across = meeting.select(doc, page, F.lit(1).alias("_part"), F.lit(None).cast("int").alias("_rank"), *[
        trim_capture(find(m, "(?U)" + s)).alias(f"_c{i}") for i, (m, s) in enumerate(zip(over, sentences))])
    rows = union(inside, across)
    # Of each pattern only its first match counts, whether acceptable or not.
    agg = rows.groupBy(doc).agg(
        F.min("_rank").alias("_rank"),
        *[F.min_by(f"_c{i}", F.when(F.col(f"_c{i}").isNotNull(), F.struct(page, "_part"))).alias(f"_c{i}")
          for i in range(len(captures))])
    named = None
    for i, token in enumerate(tokens):
        test = F.col("_rank") == i
        named = F.when(test, token) if named is None else named.when(test, token)
    from_sentence = F.coalesce(*[classify.expert_lab(F.col(f"_c{i}"), patterns, stopwords=stopwords)
                                 for i in range(len(captures))])
    return agg.select(doc, F.coalesce(classify.expert_lab(named, patterns), from_sentence)
                      .alias("expert_laboratory"))


def apply_evidence(records: DataFrame, labs: DataFrame, evidence: DataFrame, key: str = "id",
                   category: str = "category", name: str = "commercial_name",
                   lab: str = "expert_laboratory") -> DataFrame:
    """Set laboratory and technology only where the report changes them;
    technology only when unknown or ``other``. ``changed`` marks moved rows."""
    joined = (records.join(labs.select(key, F.col(lab).alias("_lab")), key, "left")
              .join(evidence.select(key, F.col("evidence").alias("_ev")), key, "left"))
    open_category = F.col(category).isNull() | (F.col(category) == "other")
    resolved = classify.technology(F.col(category), F.col(name), F.col("_ev"))
    new_lab = F.coalesce(F.col("_lab"), F.col(lab))
    new_category = F.when(open_category, resolved).otherwise(F.col(category))
    return (joined.withColumn("_nl", new_lab).withColumn("_nc", new_category)
            .withColumn("changed", ~(F.col("_nl").eqNullSafe(F.col(lab))
                                     & F.col("_nc").eqNullSafe(F.col(category))))
            .withColumn(lab, F.col("_nl")).withColumn(category, F.col("_nc"))
            .select(*records.columns, "changed"))


def evidence_lines(pages: DataFrame, hints=vocab.EVIDENCE_HINTS, most: int = 25, opening: int = 15,
                   width: int = 200, doc: str = "doc_id", page: str = "page_no",
                   text: str = "text") -> DataFrame:
    """Lines a person should read: the first ``most`` with a hint, else the
    first ``opening`` lines, and a mark for documents without any text.
    Columns: document, kind, rank, line. The ranking keeps only the leading
    rows of each document before it shuffles."""
    lines = (pages.select(doc, page, F.posexplode_outer(F.split(F.col(text), r"\r\n|[\n\r]")).alias(
        "line_no", "line")).withColumn("line", strip(F.col("line")))
        .filter(F.col("line") != ""))
    low = F.lower(F.col("line"))
    test = None
    for hint in hints:
        hit = F.contains(low, F.lit(hint))
        test = hit if test is None else test | hit
    # Lines with and without a hint are ranked apart: where no line has one, the
    # second ranking is that of all lines. One pass serves both kinds.
    order = Window.partitionBy(doc, "hit").orderBy(page, "line_no")
    ranked = (lines.withColumn("hit", F.coalesce(test, F.lit(False))).withColumn("rank", F.row_number().over(order))
              .filter(F.col("rank") <= max(most, opening))
              .withColumn("_any", F.max("hit").over(Window.partitionBy(doc))))
    shown = (ranked.filter((F.col("hit") & (F.col("rank") <= most)) | (~F.col("_any") & (F.col("rank") <= opening)))
             .select(doc, F.when(F.col("hit"), "hint").otherwise("opening").alias("kind"), "rank",
                     F.substring("line", 1, width).alias("line")))
    silent = (pages.groupBy(doc).agg(F.max(F.col(text).rlike(r"(?U)\S")).alias("_any"))
              .filter(~F.coalesce("_any", F.lit(False)))
              .select(doc, F.lit("no_text").alias("kind"), F.lit(0).alias("rank"),
                      F.lit(None).cast("string").alias("line")))
    return union(shown, silent)


def search_pages(pages: DataFrame, pattern: str = vocab.TABLE_WORDS, excerpt: int = 400,
                 page: str = "page_no", text: str = "text") -> DataFrame:
    """Pages that mention the pattern, with the opening of their text.
    Page numbers are printed from 1."""
    return (pages.filter(F.col(text).rlike(pattern))
            .withColumn("page_label", F.col(page) + 1)
            .withColumn("excerpt", F.substring(text, 1, excerpt)).drop(text))


def page_profile(pages: DataFrame, first: int = 3, doc: str = "doc_id", page: str = "page_no",
                 text: str = "text") -> DataFrame:
    """Pages per document and text length of each of the first pages."""
    size = F.coalesce(F.length(text), F.lit(0))
    return pages.groupBy(doc).agg(
        F.count(F.lit(1)).alias("num_pages"),
        *[F.max(F.when(F.col(page) == i, size)).alias(f"chars_page_{i + 1}")
          for i in range(first)])
