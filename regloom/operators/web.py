"""Registry web pages: segments, fields, rows, links and page kinds.

Tags are scanned with regular expressions inside the row, as real pages leave
tags open. A page is one row, so nothing is shuffled.
"""
from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .. import vocab
from ..functions import classify
from ..functions.staged import bound, once
from ..functions.text import INLINE, blank_to_null, find, squeeze

_TAG = r"(?s)<[^>]*>"
_BREAK = r"<[bB][rR]\b[^>]*>"
# An anchor's attributes, and what follows up to its end, the next anchor or the end.
_ANCHOR = r"(?is)<a\b([^>]*)>(.*?)(?=</a\b|<a\b|\z)"
# One group for all three kinds of quotes: an opening quote is passed only where it is closed.
_VALUE = r"""\s*=\s*(?:"(?=[^"]*")|'(?=[^']*'))?+((?<=")[^"]*|(?<=')[^']*|(?<!["'])[^\s"'>]+)"""
_HREF = r"(?is)(?:^|[\s\"'/])href" + _VALUE
_REL = r"(?is)(?:^|[\s\"'/])rel" + _VALUE
_UPDATED_LINE = "(?i)[mM]" + f"{INLINE}+".join("ise à jour et publiée le".split(" "))
# A line of the maker, in the words that ``lower`` makes equal to these.
_MAKER = "(?:[tT][iI][tT][uU][lL][aA][iI][rR][eE]|[sS][oO][cC][iI][éÉ][tT][éÉ])"
_ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
             ("&amp;", "&")]


def unescape(c: Column) -> Column:
    def plain(x: Column) -> Column:
        out = x
        for entity, char in _ENTITIES:
            out = F.replace(out, F.lit(entity), F.lit(char))
        return F.when(F.contains(x, F.lit("&")), out).otherwise(x)

    return bound(c, plain)


def visible(html: Column) -> Column:
    """Markup without scripts, styles and comments."""
    return F.regexp_replace(
        html, r"(?is)<(?:script\b.*?</script>|style\b.*?</style>|!--.*?-->)", "")


def text_of(html: Column, gap: str = " ") -> Column:
    """Text with tags replaced by ``gap``, squeezed."""
    return squeeze(unescape(F.regexp_replace(html, _TAG, gap)))


def line_array(html: Column) -> Column:
    """Non-blank squeezed lines; a line break tag ends a line."""
    return F.filter(F.split(_lines_text(html), "\n"), lambda x: x != "")


def _lines_text(html: Column) -> Column:
    """Text of ``line_array``: it begins with its first line, lines behind may be blank."""
    broken = F.regexp_replace(html, _BREAK, "\n")
    # Blanks are squeezed in the whole text, not line by line.
    return _squeezed_lines(unescape(F.regexp_replace(broken, _TAG, "")))


def _squeezed_lines(text: Column) -> Column:
    """Text in which each line is squeezed. A lone blank is no match, as most blanks are."""
    single = F.regexp_replace(text, f"{INLINE}(?:{INLINE}+|(?<! ))", " ")
    bare = F.replace(F.replace(single, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n"))
    return F.btrim(bare, F.lit(" \n"))


def link_array(html: Column) -> Column:
    """Array of (href, label) in document order. Anchors are searched once; a tag ends at its first ``>``."""
    found = F.regexp_extract_all(html, F.lit(_ANCHOR), 0)
    anchors = F.transform(found, lambda x: F.struct(
        F.substring_index(x, ">", 1).alias("tag"), F.substr(x, F.instr(x, ">") + 1).alias("label")))
    linked = F.filter(anchors, lambda x: F.substr(x["tag"], F.lit(3)).rlike(_HREF))
    return F.transform(linked, lambda x: F.struct(
        unescape(attribute(F.substr(x["tag"], F.lit(3)), _HREF)).alias("href"), text_of(x["label"]).alias("label")))


def attribute(attrs: Column, pattern: str) -> Column:
    """Value of an attribute, in double, single or no quotes; '' if it has none."""
    return F.regexp_extract(attrs, pattern, 1)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form of a link on a page."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][\w+.\-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][\w+.\-]*:)", 1)
    plain = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substr(plain, F.length(origin) + 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    return (F.when(href.rlike(r"^[a-zA-Z][\w+.\-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, href))
            .when(href.startswith("/"), F.concat(origin, href))
            .when(href == "", base)
            .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
            .when(href.startswith("?"), F.concat(plain, href))
            .otherwise(F.concat(origin, folder, href)))


def url_slug(url: Column) -> Column:
    """Last path segment of a URL."""
    path = F.regexp_replace(F.regexp_replace(url, r"^[a-z]+://[^/]*", ""), r"[?#].*$", "")
    return F.element_at(F.split(F.btrim(path, F.lit("/")), "/"), -1)


def _inside(element: Column, tag: str) -> Column:
    """What follows the tag an element begins with, up to its closing tag or the end; '' if the tag has no end."""
    close = F.instr(element, ">")
    rest = F.substr(element, close + 1)
    return F.when(close > 0, F.regexp_replace(rest, rf"(?s)</(?i:{tag})>.*", "")).otherwise("")


def page_blocks(pages: DataFrame, heading: str = "h2", block: str = "p", page_id: str = "page_id",
                url: str = "url", html: str = "html", is_visible: bool = False,
                of_heading: Callable[[Column], Column] | None = None) -> DataFrame:
    """Blocks under each heading: (page, url, heading_no, heading, block_no,
    block). A block runs to its closing tag, the next block or the heading.
    ``is_visible`` says that scripts, styles and comments are gone already;
    ``of_heading`` is put in the heading's place."""
    body = F.col(html) if is_visible else visible(F.col(html))
    sections = F.split(body, rf"(?=<(?i:{heading})\b)")
    # Only the first piece may begin otherwise.
    parts = (pages.select(page_id, url, F.posexplode_outer(sections).alias("heading_no", "_sec"))
             .filter((F.col("heading_no") > 0) | F.col("_sec").rlike(rf"(?i)^<{heading}\b")))
    title = text_of(_inside(F.col("_sec"), heading))
    blocks = F.split(F.col("_sec"), rf"(?=<(?i:{block})\b)")
    # The heading is read once a section, not once a block.
    return (once(parts, {"heading": title if of_heading is None else bound(title, of_heading)})
            .select(page_id, url, "heading_no", "heading", F.posexplode_outer(blocks).alias("block_no", "_b"))
            .filter((F.col("block_no") > 0) | F.col("_b").rlike(rf"(?i)^<{block}\b"))
            .withColumn("block", _inside(F.col("_b"), block))
            .drop("_b"))


def block_fields(blocks: DataFrame, standards: str | None = None) -> DataFrame:
    """Name, maker, aim, standard and the two document links of each block;
    blocks with neither maker nor link are navigation and are dropped."""
    # Lines are sought in the block's text, whose first line is the name; labels come in lower case once a link.
    links = F.transform(link_array(F.col("block")), lambda x: F.struct(x["href"].alias("href"), F.lower(x["label"]).alias("label")))
    staged = once(blocks, {"_text": _lines_text(F.col("block")), "_links": links})
    maker_line = find(F.col("_text"), rf"(?s)^.*\n({_MAKER}[^\n]*)")
    maker = bound(maker_line, lambda x: F.trim(F.ltrim(F.trim(F.substr(x, F.instr(x, ":") + 1)), F.lit(":"))))
    aim = find(F.col("_text"), rf"\n((?!{_MAKER})[^\n]*?[dD](?i:[EÉé]TECTION|[EÉé]NOMBREMENT)[^\n]*)")

    def words(x: Column, *needles: str) -> Column:
        return functools.reduce(Column.__or__, [F.contains(x["label"], F.lit(n)) for n in needles])

    is_certificate = (lambda x: words(x, "certificat", "attestation"))
    certificate = F.try_element_at(F.filter("_links", is_certificate), F.lit(-1))["href"]
    report = F.try_element_at(F.filter(
        "_links", lambda x: words(x, "synth", "rapport") & ~is_certificate(x)), F.lit(-1))["href"]
    page_standard = F.col(standards) if standards else F.lit(None).cast("string")
    kept = [c for c in blocks.columns if c not in ("block", standards)]
    # Blocks are dropped by fields that are read once for the test and the result.
    return (once(staged, {"manufacturer": maker, "aim_raw": aim, "certificate_url": certificate,
                          "summary_report_url": report})
            .filter((F.coalesce("manufacturer", F.lit("")) != "")
                    | F.col("certificate_url").isNotNull()
                    | F.col("summary_report_url").isNotNull())
            .select(*kept, F.nullif(F.substring_index("_text", "\n", 1), F.lit("")).alias("commercial_name"),
                    "manufacturer", "aim_raw", classify.action(F.col("aim_raw")).alias("action"),
                    F.coalesce(F.trim(find(F.col("aim_raw"), vocab.PAGE_STANDARD)),
                               page_standard).alias("reference_standard"),
                    "certificate_url", "summary_report_url",
                    F.when((F.coalesce("manufacturer", F.lit("")) != "")
                           & F.col("aim_raw").isNotNull(), "high").otherwise("medium")
                    .alias("extraction_confidence"))
            .filter("commercial_name IS NOT NULL"))


def page_standards(html: Column, heading: str = "h2", shop: str = vocab.STANDARDS_SHOP) -> Column:
    """Standards linked before the first heading, in page order, else null."""
    return _standards_of(html, visible(html), heading, shop)


def _standards_of(html: Column, body: Column, heading: str = "h2", shop: str = vocab.STANDARDS_SHOP) -> Column:
    before = F.regexp_replace(body, rf"(?s)<(?i:{heading})\b.*", "")
    has = html.rlike(rf"<(?i:{heading})\b")
    named = F.filter(link_array(before), lambda x: F.contains(x["href"], F.lit(shop))
                     | x["label"].rlike(r"^(NF\s|ISO\s|EN\s)"))
    joined = F.array_join(F.transform(named, lambda x: x["label"]), "; ")
    return F.when(has, F.nullif(joined, F.lit("")))


def last_updated(html: Column) -> Column:
    """Text of the page's own date line."""
    return _updated_of(_date_text(visible(html)))


def _date_text(body: Column) -> Column:
    """Text in lines, among which the page's date line is sought."""
    ended = F.regexp_replace(body, r"</(?i:p|div|h\d|li)>|" + _BREAK, "\n")
    return unescape(F.regexp_replace(ended, _TAG, ""))


def _updated_of(text: Column) -> Column:
    """Takes ``_date_text``; only the first line that has the words is cut out and squeezed."""
    def line(found: Column) -> Column:
        # Place and text travel together, so that neither is worked out again.
        at, t = found["at"], found["text"]
        cut = F.concat(F.substring_index(F.substr(t, F.lit(1), at - 1), "\n", -1), F.substring_index(F.substr(t, at), "\n", 1))
        return F.when(at > 0, F.trim(find(squeeze(cut), vocab.PAGE_UPDATED)))

    return bound(text, lambda t: bound(F.struct(F.regexp_instr(t, F.lit(_UPDATED_LINE)).alias("at"), t.alias("text")), line))


def organism_page_records(pages: DataFrame, page_id: str = "page_id", url: str = "url",
                          html: str = "html") -> DataFrame:
    """Organism pages to raw page records, in one map-only stage."""
    h1 = F.nullif(text_of(F.regexp_extract(F.col(html), r"(?is)<h1\b[^>]*>(.*?)</h1>", 1)),
                  F.lit(""))
    # What is one per page is read before its blocks are unrolled, what is one per section in ``page_blocks``.
    body = once(pages.select(page_id, url, html), {"_body": visible(F.col(html))})
    head = once(body, {"_raw": h1, "_std": _standards_of(F.col(html), F.col("_body")), "_dated": _date_text(F.col("_body")),
                       "_slug": url_slug(F.col(url))})
    named = once(head, {"_upd": _updated_of(F.col("_dated")), "_organism": classify.organism_of_slug(F.col("_slug"), F.col("_raw"))})
    carried = named.select(page_id, F.struct(F.col(url).alias("url"), "_raw", "_std", "_upd", "_organism").alias(url),
                           F.col("_body").alias(html))
    blocks = page_blocks(carried, page_id=page_id, url=url, html=html, is_visible=True, of_heading=classify.technology_from_heading)
    flat = blocks.select(page_id, F.col("heading").alias("_category"), "block_no", "heading_no", "block",
                         *[F.col(url)[c].alias(c) for c in ("url", "_raw", "_std", "_upd", "_organism")])
    f = block_fields(flat, standards="_std")
    none = F.lit(None).cast("string")
    return f.select(
        F.lit("NF-VALIDATION").alias("source"), "commercial_name",
        F.struct(F.col("manufacturer").alias("name"), none.alias("address_raw"),
                 none.alias("represented_in_europe"), none.alias("site_of_production"))
        .alias("manufacturer"),
        F.struct("action", F.col("_category").alias("category"))
        .alias("method_type"),
        F.struct(F.col("_organism").alias("normalized"), F.col("_raw").alias("raw")).alias("target_organism"),
        F.struct(F.col("reference_standard").alias("standard"), F.col("aim_raw").alias("raw"))
        .alias("reference_method"),
        F.struct(F.lit("live_web_page").alias("source_document_type"),
                 F.col("url").alias("source_document_url"),
                 F.col("certificate_url").alias("certificate_pdf_url"),
                 F.col("summary_report_url").alias("summary_report_pdf_url"),
                 "extraction_confidence").alias("traceability"),
        F.col("_upd").alias("organism_page_last_updated_raw"))


def row_cells(pages: DataFrame, row: str = "tr", cell: str = "t[hd]", page_id: str = "page_id",
              html: str = "html") -> DataFrame:
    """Every row element with its cells: (page, row_no, row_html, cells)."""
    rows = F.split(visible(F.col(html)), rf"(?i)(?=<{row}\b)")
    inner = F.regexp_extract_all(F.col("row_html"),
                                 F.lit(rf"(?is)<{cell}\b[^>]*>(.*?)</{cell}>"), 1)
    return (pages.select(page_id, F.posexplode_outer(rows).alias("row_no", "_r"))
            .filter(F.col("_r").rlike(rf"(?i)^<{row}\b"))
            .select(page_id, "row_no", _inside(F.col("_r"), row).alias("row_html"))
            .withColumn("cell_html", inner)
            .withColumn("cells", F.transform("cell_html", lambda x: text_of(x))))


def generic_rows(pages: DataFrame, **kw) -> DataFrame:
    """Non-empty rows as lists of cells, without a header."""
    return (row_cells(pages, **kw).filter(text_of(F.col("row_html"), "") != "")
            .drop("row_html", "cell_html"))


def list_rows(pages: DataFrame, key_column: str = "Certificate number",
              expected=vocab.LIST_COLUMNS, fields=vocab.LIST_FIELDS, page_id: str = "page_id",
              html: str = "html", **kw) -> DataFrame:
    """Rows under the first row as header. Rows of the expected width give the
    named fields and the key column's link, others one ``unparsed_row``.
    ``header_ok`` flags drift of the printed header."""
    rows = row_cells(pages, page_id=page_id, html=html, **kw)
    header = rows.groupBy(page_id).agg(F.min_by("cells", "row_no").alias("header"),
                                       F.min("row_no").alias("_first"))
    body = (rows.join(header, page_id).filter(F.col("row_no") > F.col("_first"))
            .filter(F.exists("cells", lambda x: x != "")))
    fits = (F.size("cells") == F.size("header")) & (F.size("cells") == len(fields))
    place = F.array_position("header", F.lit(key_column)).cast("int")
    link = F.when(fits & (place > 0), F.try_element_at(
        link_array(F.try_element_at("cell_html", F.greatest(place, F.lit(1)))), F.lit(1))["href"])
    return body.select(
        page_id, "row_no",
        *[F.when(fits, F.try_element_at("cells", F.lit(i))).alias(f)
          for i, f in enumerate(fields, 1)],
        F.when(~fits & (F.size("cells") == F.size("header")), F.try_element_at("cells", F.lit(1)))
        .when(~fits, text_of(F.col("row_html"))).alias("unparsed_row"),
        link.alias("row_link"),
        F.col("header").eqNullSafe(F.array(*[F.lit(e) for e in expected])).alias("header_ok"))


def header_drift(rows: DataFrame, source: str = "source") -> DataFrame:
    """Rows and drifted rows per source."""
    return rows.groupBy(source).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_if(~F.col("header_ok")).alias("n_drifted"))


def detail_fields(pages: DataFrame, labels=vocab.DETAIL_LABELS, page_id: str = "page_id",
                  html: str = "html", **kw) -> DataFrame:
    """Key/value rows of a detail page: known labels, the two documents, and
    which labels are missing. Only two-cell rows count; a later row wins."""
    pairs = (row_cells(pages, page_id=page_id, html=html, **kw).filter(F.size("cells") == 2)
             .withColumn("label", F.element_at("cells", 1))
             .withColumn("value", F.element_at("cells", 2))
             .withColumn("link", F.try_element_at(link_array(F.element_at("cell_html", 2)),
                                                  F.lit(1))["href"]))

    def last(test: Column, value: str) -> Column:
        return F.max_by(value, F.when(test, F.col("row_no")))

    link_known = F.col("link").isNotNull()
    wide = pairs.groupBy(page_id).agg(
        *[last(F.col("label") == name, "value").alias(name) for name in labels],
        last((F.col("label") == "Certificate") & link_known, "link").alias("certificate_pdf_url"),
        last((F.col("label") == "Study report") & link_known, "link")
        .alias("summary_report_pdf_url"))
    missing = F.array_compact(F.array(*[F.when(F.col(f"`{n}`").isNull(), F.lit(n))
                                        for n in labels]))
    return wide.withColumn("missing_labels", missing)


def pdf_links(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              pattern: str = r"(?i)\.pdf$|certificate") -> DataFrame:
    """Distinct absolute links that are PDFs or mention a certificate.
    Made distinct inside the row, so the page's links never shuffle."""
    hrefs = F.array_distinct(F.transform(F.filter(
        link_array(F.col(html)), lambda x: x["href"].rlike(pattern)),
        lambda x: resolve_url(F.col(url), x["href"])))
    return pages.select(page_id, F.explode_outer(F.array_sort(hrefs)).alias("link")).filter("link IS NOT NULL")


def next_page(html: Column, url: Column, word: str = "next") -> Column:
    """Link marked ``rel=next``, else one labelled with the word; null when it
    leads to the page itself."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<a\b([^>]*)>"), 1)
    rel = F.try_element_at(F.filter(tags, lambda t: attribute(t, _REL).rlike(r"(?i)(?:^|\s)next(?:\s|$)")), F.lit(1))
    by_rel = blank_to_null(unescape(attribute(rel, _HREF)))
    by_word = F.try_element_at(F.filter(
        link_array(html), lambda x: F.lower(F.trim(x["label"])) == word), F.lit(1))["href"]
    target = resolve_url(url, F.when(rel.isNotNull(), by_rel).otherwise(by_word))
    return F.nullif(target, url)


def is_login_wall(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit('type="password"'))


def is_script_shell(html: Column) -> Column:
    """A body with almost no text and no links, rows or items."""
    body = F.regexp_extract(html, r"(?is)<body\b[^>]*>(.*)", 1)
    text = text_of(F.regexp_replace(body, r"(?s)<!--.*?-->", ""), "")
    return (~html.rlike(r"(?i)<body\b")) | (
        (F.length(text) < 50) & (F.regexp_count(body, F.lit(r"(?i)<(a|td|li|tr)\b")) == 0))


def page_kinds(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    return pages.select(page_id, is_login_wall(F.col(html)).alias("login_wall"),
                        is_script_shell(F.col(html)).alias("script_shell"))
