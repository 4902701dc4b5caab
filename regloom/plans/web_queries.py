"""Web pages: the driver's pages, and registry pages written from its tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import web
from .inputs import LINE_ORDER, phrase, spread, table
from .registry import query


def _pages(spark, sf):
    return table(spark, sf, "pages")


# Visible markup, as the Spark side sees it.
VISIBLE_SQL = r"""
v AS (SELECT page_id, url, html, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') AS body FROM pages)"""
TEXT_SQL = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '(?s)<[^>]*>', ' ', 'g'),
  '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query("page_blocks", rf"""WITH {VISIBLE_SQL},
secs AS (SELECT page_id, unnest(string_split(body, '<h1>')) AS sec, generate_subscripts(string_split(body, '<h1>'), 1) AS h FROM v),
parts AS (SELECT page_id, h - 1 AS heading_no, {TEXT_SQL.format("split_part(sec, '</h1>', 1)")} AS heading,
    unnest(string_split(sec, '<p>')) AS blk, generate_subscripts(string_split(sec, '<p>'), 1) AS b FROM secs WHERE h > 1)
SELECT page_id, heading_no, heading, b - 1 AS block_no, md5({TEXT_SQL.format("split_part(blk, '</p>', 1)")}) AS block_md5 FROM parts WHERE b > 1""")
def page_blocks(spark, sf):
    b = web.page_blocks(_pages(spark, sf), heading="h1")
    return b.select("page_id", F.col("heading_no").cast("bigint").alias("heading_no"), "heading",
                    F.col("block_no").cast("bigint").alias("block_no"),
                    F.md5(web.text_of(F.col("block"))).alias("block_md5"))


# Anchors as real pages have them: some are not closed, some values not quoted.
LOOSE_SQL = r"""
loose AS (SELECT page_id, url, CASE page_id % 3 WHEN 1 THEN replace(html, '</a>', '')
   WHEN 2 THEN regexp_replace(html, 'href="([^"\s>]*)"', 'href=\1', 'g') ELSE html END AS html FROM pages)"""


def _loose_pages(spark, sf):
    html = F.col("html")
    return _pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 3 == 1, F.replace(html, F.lit("</a>"), F.lit("")))
                                        .when(F.col("page_id") % 3 == 2, F.regexp_replace(html, r'href="([^"\s>]*)"', "href=$1"))
                                        .otherwise(html))


LINKS_SQL = r"""
hrefs AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]*)', 1)) AS href FROM loose),
links AS (SELECT DISTINCT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
   ELSE regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || href END AS link, href FROM hrefs)"""


@query("page_links", f"WITH {LOOSE_SQL}, {LINKS_SQL} SELECT page_id, link FROM links")
def page_links(spark, sf):
    return web.pdf_links(_loose_pages(spark, sf), pattern="")


@query("certificate_links", f"""WITH {LOOSE_SQL}, {LINKS_SQL}
SELECT page_id, link FROM links WHERE regexp_matches(href, '(?i)\\.pdf$|certificate')
UNION ALL SELECT page_id, regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/file' || page_id || '.PDF' FROM pages""")
def certificate_links(spark, sf):
    pages = _loose_pages(spark, sf).withColumn("html", F.concat("html", F.lit("<a href=/file"), F.col("page_id"), F.lit(".PDF>x")))
    return web.pdf_links(pages)


@query("next_pages", r"""
WITH l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>[^<]*</a>', 0)) AS a,
  generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["''][^>]*>[^<]*</a>', 0), 1) AS i FROM pages),
n AS (SELECT page_id, min_by(a, i) AS a FROM l WHERE lower(trim(regexp_extract(a, '>([^<]*)</a>$', 1))) = 'the' GROUP BY 1)
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || '/rel' || page_id
   WHEN a IS NOT NULL THEN regexp_extract(url, '^([a-zA-Z]+://[^/?#]*)', 1) || regexp_extract(a, 'href="([^"]*)"', 1) END AS next_page
FROM pages LEFT JOIN n USING (page_id)""")
def next_pages(spark, sf):
    marked = F.concat("html", F.lit("<a href=/rel"), F.col("page_id"), F.lit(" rel='nofollow NEXT'>further"))
    pages = _pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 4 == 0, marked).otherwise(F.col("html")))
    return pages.select("page_id", web.next_page(F.col("html"), F.col("url"), "the").alias("next_page"))


@query("page_kinds", """
WITH p AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '<html><body><div id="app"></div><script>load()</script></body></html>'
   WHEN page_id % 5 = 0 THEN html || '<INPUT type="PASSWORD">' ELSE html END AS html FROM pages),
b AS (SELECT *, regexp_extract(html, '(?is)<body[^>]*>(.*)', 1) AS body FROM p)
SELECT page_id, contains(lower(html), 'type="password"') AS login_wall,
   length(trim(regexp_replace(regexp_replace(body, '(?s)<!--.*?-->|<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))) < 50
     AND NOT regexp_matches(body, '(?i)<(a|td|li|tr)\\b') AS script_shell FROM b""")
def page_kinds(spark, sf):
    shell = F.lit('<html><body><div id="app"></div><script>load()</script></body></html>')
    pages = _pages(spark, sf).withColumn("html", F.when(F.col("page_id") % 7 == 0, shell).when(
        F.col("page_id") % 5 == 0, F.concat("html", F.lit('<INPUT type="PASSWORD">'))).otherwise(F.col("html")))
    return web.page_kinds(pages)


@query("item_rows", rf"""WITH {VISIBLE_SQL},
r AS (SELECT page_id, unnest(string_split(body, '<li>')) AS item, generate_subscripts(string_split(body, '<li>'), 1) AS i FROM v)
SELECT page_id, i - 1 AS row_no, {TEXT_SQL.format("regexp_extract(item, '<a[^>]*>([^<]*)</a>', 1)")} AS cells
FROM r WHERE i > 1 AND {TEXT_SQL.format("split_part(item, '</li>', 1)")} <> ''""")
def item_rows(spark, sf):
    rows = web.generic_rows(_pages(spark, sf), row="li", cell="a")
    return rows.select("page_id", F.col("row_no").cast("bigint").alias("row_no"),
                       F.array_join("cells", "|").alias("cells"))


# --- Registry pages written from the tables ----------------------------------

def _list_pages(spark, sf):
    """A list page per customer: a header row and a row per order. Some rows
    are one cell short, some blank; customers of one segment print another
    header."""
    row = F.when(F.col("o_orderstatus") == "P", F.concat(
        F.lit("<tr><td>five</td><td>"), F.col("o_orderkey"), F.lit("</td></tr>"))).otherwise(F.concat(
            F.lit("<tr><td>Listeria<br>spp</td><td><a class='x' href=\"/d/"), F.col("o_orderkey"),
            F.lit("\">LR"), F.col("o_orderkey"), F.lit("</a></td><td>Kit &amp; co</td><td>M "),
            F.col("o_orderpriority"), F.lit("</td><td>01-02-2003</td><td>Valid</td></tr><tr><td> </td></tr>")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", row.alias("r")))),
                                    lambda x: x["r"]), "\n")
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(body.alias("body"))
    header = F.when(F.col("c_mktsegment") == "BUILDING", "Test kit").otherwise("Test kit name")
    return (orders.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_custkey").alias("page_id"), F.col("c_mktsegment").alias("source"), F.concat(
                F.lit("<table><tr><th>Analyte</th><th>Certificate number</th><th>"), header,
                F.lit("</th><th>Supplier - manufacturer</th><th>Expiry date</th><th>Status</th></tr>"),
                F.col("body"), F.lit("</table>")).alias("html")))


@query("list_rows", """
SELECT o_custkey AS page_id, CASE WHEN o_orderstatus <> 'P' THEN 'Listeria spp' END AS analyte_raw, CASE WHEN o_orderstatus <> 'P' THEN 'LR' || o_orderkey END AS certificate_number,
  CASE WHEN o_orderstatus <> 'P' THEN 'Kit & co' END AS commercial_name, CASE WHEN o_orderstatus <> 'P' THEN 'M ' || o_orderpriority END AS manufacturer_raw,
  CASE WHEN o_orderstatus = 'P' THEN 'five ' || o_orderkey END AS unparsed_row, CASE WHEN o_orderstatus <> 'P' THEN '/d/' || o_orderkey END AS row_link,
  c_mktsegment <> 'BUILDING' AS header_ok FROM orders JOIN customer ON o_custkey = c_custkey""")
def list_rows(spark, sf):
    return web.list_rows(_list_pages(spark, sf)).select(
        "page_id", "analyte_raw", "certificate_number", "commercial_name", "manufacturer_raw",
        "unparsed_row", "row_link", "header_ok")


@query("header_drift", """
SELECT c_mktsegment AS source, count(*) AS n_rows, count(*) FILTER (c_mktsegment = 'BUILDING') AS n_drifted
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def header_drift(spark, sf):
    pages = _list_pages(spark, sf)
    rows = web.list_rows(pages).join(pages.select("page_id", "source"), "page_id")
    return web.header_drift(rows)


@query("detail_fields", """
SELECT c_custkey AS page_id, 'raw milk, ' || lower(c_mktsegment) AS matrices, CASE WHEN c_acctbal > 0 THEN c_name END AS maker,
  'https://example.org/c' || c_custkey || '.pdf' AS certificate_pdf_url,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN '/r.pdf' END AS summary_report_pdf_url,
  CASE WHEN c_acctbal > 0 THEN 0 ELSE 1 END + 7 AS n_missing FROM customer""")
def detail_fields(spark, sf):
    html = F.concat(
        F.lit("<table><tr><th>one</th></tr><tr><td>Test kit name</td><td>Kit <b>one</b></td></tr>"
              "<tr><td>Matrices</td><td>old</td></tr><tr><td>Matrices</td><td>raw&nbsp;milk, "),
        F.lower("c_mktsegment"), F.lit("</td></tr><tr><td>Certificate</td><td><a href='https://example.org/c"),
        F.col("c_custkey"), F.lit(".pdf'>Download</a></td></tr>"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("<tr><td>Supplier - manufacturer</td><td>"), F.col("c_name"),
                                               F.lit("</td></tr>"))).otherwise(""),
        F.when(F.col("c_mktsegment") == "MACHINERY",
               "<tr><td>Study report</td><td><a href=\"/r.pdf\">Download</a></td></tr>")
        .otherwise("<tr><td>Study report</td><td>none</td></tr>"), F.lit("</table>"))
    # A page is a row of a small file: dealt out, or one task reads and parses all of them.
    pages = spread(table(spark, sf, "customer"), "c_custkey").select(F.col("c_custkey").alias("page_id"), html.alias("html"))
    d = web.detail_fields(pages)
    return d.select("page_id", F.col("Matrices").alias("matrices"),
                    F.col("Supplier - manufacturer").alias("maker"), "certificate_pdf_url",
                    "summary_report_pdf_url", F.size("missing_labels").cast("bigint").alias("n_missing"))


HEADINGS = {"F": "Milieux de culture", "O": "Méthodes moléculaires", "P": "Autre chose"}


def _organism_pages(spark, sf):
    """A registry page per order: a standards link, a heading, a block per
    order line and a navigation block."""
    block = F.concat(
        F.lit("<p>Kit  "), F.col("l_partkey"), F.lit("<br/>"),
        F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Titulaire : Maker "), F.col("l_suppkey"), F.lit("<br>"))).otherwise(""),
        F.when(F.col("l_linestatus") == "F", "Type : DÉTECTION des coliformes (selon ISO 77)<br>")
        .otherwise("Dénombrement<br>"),
        F.when(F.col("l_quantity") > 25, F.concat(
            F.lit("<a href=\"https://example.org/c"), F.col("l_partkey"),
            F.lit(".pdf\">Certificat</a> <a href='/r.pdf'>Rapport de synthèse</a>"))).otherwise(""), F.lit("</p>"))
    blocks = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(*LINE_ORDER, block.alias("b")))), lambda x: x["b"]), "\n").alias("blocks"))
    heading = phrase(F.col("o_orderstatus"), HEADINGS)
    slug = phrase(F.col("o_orderstatus"), {"F": "coliformes", "O": "page-e-coli-o157-x", "P": "unknown"})
    return (table(spark, sf, "orders").join(blocks, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(F.col("o_orderkey").alias("page_id"),
                    F.concat(F.lit("https://example.org/food/"), slug, F.lit("/")).alias("url"), F.concat(
                        F.lit("<body><h1>The <i>organism</i></h1><a href='https://boutique.afnor.org/1'>NF ISO 1</a>"
                              "<a href='/x'>ISO 2</a><a href='/y'>other</a><p>mise à jour et publiée le 3 mai "),
                        F.year("o_orderdate"), F.lit("</p><h2>"), heading, F.lit("</h2>"), F.col("blocks"),
                        F.lit("<p>Retour à la liste</p></body>")).alias("html")))


@query("organism_page_records", """
SELECT o_orderkey AS page_id, 'Kit ' || l_partkey AS commercial_name, CASE WHEN l_returnflag <> 'N' THEN 'Maker ' || l_suppkey END AS manufacturer,
  CASE l_linestatus WHEN 'F' THEN 'detection' ELSE 'enumeration' END AS action,
  CASE o_orderstatus WHEN 'F' THEN 'culture_media' WHEN 'O' THEN 'molecular_pcr' ELSE 'other' END AS category,
  CASE o_orderstatus WHEN 'F' THEN 'Coliforms' WHEN 'O' THEN 'E. coli O157' ELSE 'The organism' END AS organism,
  CASE l_linestatus WHEN 'F' THEN 'ISO 77' ELSE 'NF ISO 1; ISO 2' END AS standard,
  CASE WHEN l_quantity > 25 THEN 'https://example.org/c' || l_partkey || '.pdf' END AS certificate_url,
  CASE WHEN l_quantity > 25 THEN '/r.pdf' END AS report_url,
  CASE WHEN l_returnflag <> 'N' THEN 'high' ELSE 'medium' END AS confidence, '3 mai ' || year(o_orderdate) AS updated, count(*) AS n
FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag <> 'N' OR l_quantity > 25 GROUP BY ALL""")
def organism_page_records(spark, sf):
    pages = _organism_pages(spark, sf)
    # The page id rides in the URL's place for the check only.
    tagged = pages.withColumn("url", F.concat("url", F.lit("?"), F.col("page_id")))
    r = web.organism_page_records(tagged)
    t = F.col("traceability")
    out = r.select(
        F.regexp_extract(t["source_document_url"], r"\?(\d+)$", 1).cast("bigint").alias("page_id"),
        "commercial_name", F.col("manufacturer.name").alias("manufacturer"),
        F.col("method_type.action").alias("action"), F.col("method_type.category").alias("category"),
        F.col("target_organism.normalized").alias("organism"),
        F.col("reference_method.standard").alias("standard"),
        t["certificate_pdf_url"].alias("certificate_url"), t["summary_report_pdf_url"].alias("report_url"),
        t["extraction_confidence"].alias("confidence"), F.col("organism_page_last_updated_raw").alias("updated"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))
