"""Keys, copies, collectors, snapshots and batch results."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import values
from ..functions.text import api_id
from ..operators import canonical, quality, reconcile, results, snapshot
from ..sources import registry as raw
from . import build, inputs
from .inputs import LINE_ORDER, TODAY, table
from .registry import query

ORDER_SQL = ", ".join(LINE_ORDER)


@query("latest_copy", f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
                 l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def latest_copy(spark, sf):
    rows = reconcile.latest_per_key(
        table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"])
    return rows.select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"),
                       "l_partkey", "l_suppkey", "l_quantity", "l_returnflag",
                       F.col("l_shipdate").cast("date").cast("string").alias("shipped"))


# Orders before 1996 get numbers that no line has: both sides keep all their rows.
SHIFTED_SQL = "CASE WHEN o_orderdate >= '1996-01-01' THEN o_orderkey ELSE o_orderkey + 50000000 END"


def _shifted_orders(spark, sf):
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").withColumn("o_orderkey", F.when(F.col("o_orderdate") >= "1996-01-01", key).otherwise(key + 50_000_000))


def _two_sides(spark, sf):
    orders = _shifted_orders(spark, sf).select(F.col("o_orderkey").alias("certificate_number"), "o_orderstatus")
    lines = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("certificate_number"))
             .agg(F.count("*").alias("n_lines")))
    return reconcile.match_sources(orders, lines, left_name="list", right_name="pages")


MATCH_SQL = f"""
matched AS (
  SELECT COALESCE(o_orderkey, l_orderkey) AS certificate_number, o_orderstatus, n_lines,
         CASE WHEN o_orderkey IS NULL THEN 'pages_only' WHEN l_orderkey IS NULL THEN 'list_only' ELSE 'both' END AS outcome
  FROM (SELECT {SHIFTED_SQL} AS o_orderkey, o_orderstatus FROM orders)
  FULL JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey)"""


@query("matched_sources", f"""WITH {MATCH_SQL}
SELECT certificate_number, outcome, CASE outcome WHEN 'both' THEN 'high' ELSE 'medium' END AS confidence,
       o_orderstatus, COALESCE(n_lines, 0) AS n_lines FROM matched""")
def matched_sources(spark, sf):
    return _two_sides(spark, sf).select(
        "certificate_number", "outcome", "confidence", F.col("list.o_orderstatus"),
        F.coalesce("pages.n_lines", F.lit(0)).alias("n_lines"))


@query("match_outcomes", f"WITH {MATCH_SQL} SELECT outcome, count(*) AS n FROM matched GROUP BY 1")
def match_outcomes(spark, sf):
    return reconcile.outcome_counts(_two_sides(spark, sf))


KEYS_SQL = """
boot AS (SELECT CASE WHEN p_size <= 25 THEN 'P' ELSE 'Q' END || p_partkey AS cert, upper(p_name || p_brand) AS raw_name FROM part),
names AS (SELECT regexp_replace(raw_name, '[^A-Z0-9]+', '', 'g') AS nm, min(cert) AS by_name
          FROM boot {claimed} GROUP BY 1 HAVING count(DISTINCT cert) = 1),
pages_side AS (SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN NULL WHEN 'ECONOMY' THEN 'X' || p_partkey ELSE 'P' || p_partkey END AS cert,
               regexp_replace(upper(p_name || ' ' || p_brand), '[^A-Z0-9]+', '', 'g') AS nm FROM part)
SELECT p_partkey, CASE WHEN b.cert IS NOT NULL THEN b.cert WHEN by_name IS NOT NULL THEN by_name ELSE p.cert END AS resolved_key,
       CASE WHEN b.cert IS NOT NULL THEN 'exact' WHEN by_name IS NOT NULL THEN 'by_name'
            WHEN p.cert IS NOT NULL THEN 'unmatched' ELSE 'unresolved' END AS resolution
FROM pages_side p LEFT JOIN boot b ON p.cert = b.cert LEFT JOIN names USING (nm)"""


def _keys(spark, sf, exclude):
    part = table(spark, sf, "part")
    number = F.concat(F.lit("P"), F.col("p_partkey"))
    boot = part.select(
        F.concat(F.when(F.col("p_size") <= 25, "P").otherwise("Q"), F.col("p_partkey")).alias("certificate_number"),
        F.concat_ws(" ", "p_name", "p_brand").alias("commercial_name"))
    pages = part.select("p_partkey", F.when(F.col("p_type") == "PROMO", None)
                        .when(F.col("p_type") == "ECONOMY", F.concat(F.lit("X"), F.col("p_partkey")))
                        .otherwise(number).alias("certificate_number"),
                        F.concat_ws(" ", "p_name", "p_brand").alias("commercial_name"))
    return reconcile.resolve_keys(pages, boot, exclude_claimed=exclude).select(
        "p_partkey", "resolved_key", "resolution")


@query("resolved_keys", "WITH " + KEYS_SQL.format(claimed=""))
def resolved_keys(spark, sf):
    return _keys(spark, sf, False)


@query("resolved_keys_unclaimed", "WITH " + KEYS_SQL.format(
    claimed="""WHERE cert NOT IN (SELECT 'P' || p_partkey FROM part WHERE p_type NOT IN ('PROMO', 'ECONOMY'))"""))
def resolved_keys_unclaimed(spark, sf):
    return _keys(spark, sf, True)


# --- The two-collector registry: orders as the list, order lines as live pages

DIGITS = "lpad(CAST({} AS VARCHAR), 8, '0')"
FRENCH = ("CASE month({d}) WHEN 1 THEN 'janvier' WHEN 2 THEN 'février' WHEN 3 THEN 'mars' WHEN 4 THEN 'avril' "
          "WHEN 5 THEN 'mai' WHEN 6 THEN 'juin' WHEN 7 THEN 'juillet' WHEN 8 THEN 'août' WHEN 9 THEN 'septembre' "
          "WHEN 10 THEN 'octobre' WHEN 11 THEN 'novembre' ELSE 'décembre' END")


def _digits(key):
    return F.lpad(F.col(key).cast("string"), 8, "0")


def _number(key):
    d = _digits(key)
    return F.concat(F.lit("ORD "), F.substring(d, 1, 2), F.lit("/"), F.substring(d, 3, 2), F.lit("-"),
                    F.substring(d, 5, 2), F.lit("/"), F.substring(d, 7, 2))


def list_records(spark, sf):
    """Bootstrap records: the orders, those before 1996 under other numbers."""
    day = F.date_format("o_orderdate", "dd.MM.yyyy")
    later = F.date_format(F.col("o_orderdate").cast("date") + F.expr("INTERVAL 1 YEAR"), "dd/MM/yyyy")
    none = F.lit(None).cast("string")
    return _shifted_orders(spark, sf).select(
        _number("o_orderkey").alias("certificate_number"), F.lit("NF-VALIDATION").alias("source"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("commercial_name"),
        none.alias("aim_of_method_raw"),
        F.when(F.col("o_orderstatus") == "F", "Salmonella spp.").alias("target_organism"),
        F.when(F.col("o_orderstatus") == "O", "detection").alias("action"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("validation_scope_raw"),
        F.col("o_orderdate").cast("date").cast("string").alias("certification_date"),
        F.when(F.col("o_totalprice") > 60000, F.date_add(F.col("o_orderdate").cast("date"), 400)
               .cast("string")).alias("end_of_validity"),
        F.array().cast("array<string>").alias("all_dates_found"),
        F.when(F.col("o_orderstatus") == "F", F.concat(
            F.lit("RECONDUCTION/RENEWAL: "), day, F.lit(" EXTENSION: "), later, F.lit(" "), later))
        .when(F.col("o_orderstatus") == "O", F.concat(
            F.lit("EXTENSION: "), day, F.lit(" RECONDUCTION/RENEWAL: "), later))
        .otherwise("none").alias("raw_block"),
        F.concat(F.lit("certification : Maker "), F.col("o_custkey"), F.lit(";")).alias(
            "company_holder_raw"))


def page_records(spark, sf):
    """Live page records: one per order line, several per certificate."""
    d = _digits("l_orderkey")
    url = F.concat(F.lit("https://example.org/up/ORD-"), F.substring(d, 1, 2), F.lit("-"),
                   F.substring(d, 3, 2), F.lit("-"), F.substring(d, 5, 2), F.lit("-"),
                   F.substring(d, 7, 2), F.lit("_fr.pdf"))
    none = F.lit(None).cast("string")
    from .. import vocab
    month = F.element_at(F.array(*[F.lit(m) for m in vocab.FRENCH_MONTHS]), F.month("l_shipdate"))
    return inputs.table(spark, sf, "lineitem").select(
        F.lit("NF-VALIDATION").alias("source"),
        F.concat(F.lit("Kit "), F.col("l_partkey")).alias("commercial_name"),
        F.struct(F.when(F.col("l_returnflag") != "N", F.concat(F.lit("Supplier "), F.col("l_suppkey")))
                 .alias("name"), none.alias("address_raw"), none.alias("represented_in_europe"),
                 none.alias("site_of_production")).alias("manufacturer"),
        F.struct(F.when(F.col("l_linestatus") == "F", "detection").otherwise("enumeration").alias("action"),
                 F.lit("culture_media").alias("category")).alias("method_type"),
        F.struct(F.lit("Coliforms").alias("normalized"), F.lit("Coliformes").alias("raw"))
        .alias("target_organism"),
        F.struct(F.lit("ISO 4832").alias("standard"), none.alias("raw")).alias("reference_method"),
        F.struct(F.lit("live_web_page").alias("source_document_type"),
                 F.lit("https://example.org/coliformes/").alias("source_document_url"),
                 url.alias("certificate_pdf_url"), none.alias("summary_report_pdf_url"),
                 F.lit("high").alias("extraction_confidence")).alias("traceability"),
        F.concat_ws(" ", F.dayofmonth("l_shipdate"), month, F.year("l_shipdate"))
        .alias("organism_page_last_updated_raw"),
        F.concat_ws("|", *[F.lpad(F.col(c).cast("string"), 12, "0") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    "l_returnflag", "l_linestatus").alias("file"))


REGISTRY_SQL = f"""
boot AS (SELECT *, {DIGITS.format('o_orderkey')} AS d FROM (SELECT * REPLACE ({SHIFTED_SQL} AS o_orderkey) FROM orders)),
pg AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC,
         l_suppkey DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem),
page AS (SELECT *, {DIGITS.format('l_orderkey')} AS pd FROM pg WHERE rn = 1),
j AS (SELECT *, COALESCE(d, pd) AS k, d IS NOT NULL AS hb, pd IS NOT NULL AS hp FROM boot FULL JOIN page ON d = pd),
r AS (SELECT 'ORD ' || substr(k, 1, 2) || '/' || substr(k, 3, 2) || '-' || substr(k, 5, 2) || '/' || substr(k, 7, 2) AS source_certificate_number,
  'nf-validation--ord-' || substr(k, 1, 2) || '-' || substr(k, 3, 2) || '-' || substr(k, 5, 2) || '-' || substr(k, 7, 2) AS id,
  CASE WHEN hp THEN 'Kit ' || l_partkey ELSE 'Order ' || o_orderkey END AS commercial_name,
  COALESCE(CASE WHEN l_returnflag <> 'N' THEN 'Supplier ' || l_suppkey END, 'Maker ' || o_custkey) AS manufacturer,
  CASE WHEN hp THEN CASE l_linestatus WHEN 'F' THEN 'detection' ELSE 'enumeration' END WHEN o_orderstatus = 'O' THEN 'detection' END AS action,
  CASE WHEN hp THEN 'Coliforms' WHEN o_orderstatus = 'F' THEN 'Salmonella spp.' END AS organism,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority WHEN hp THEN '(not published on the organism listing page; see certificate PDF)' ELSE '' END AS scope,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS original_date,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderstatus = 'O' THEN strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%d') ELSE '' END AS renewals,
  CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%d') || ',' || strftime(o_orderdate + INTERVAL 1 YEAR, '%Y-%m-%d') ELSE '' END AS extensions,
  CAST(CASE WHEN o_totalprice > 60000 THEN CAST(o_orderdate AS DATE) + 400 END AS VARCHAR) AS current_expiry,
  CASE WHEN o_totalprice > 60000 THEN CASE WHEN CAST(o_orderdate AS DATE) + 400 >= DATE '{TODAY}' THEN 'active' ELSE 'expired' END ELSE 'unknown' END AS status,
  CASE WHEN hb AND hp THEN 'high' ELSE 'medium' END AS confidence,
  CASE WHEN hp THEN day(l_shipdate) || ' ' || {FRENCH.format(d='l_shipdate')} || ' ' || year(l_shipdate) END AS page_date
  FROM j)"""


@query("reconciled_records", f"WITH {REGISTRY_SQL} SELECT * FROM r")
def reconciled_records(spark, sf):
    out = build.reconcile_registry(page_records(spark, sf), list_records(spark, sf), TODAY)
    return out["records"].select(
        "source_certificate_number", "id", "commercial_name",
        F.col("manufacturer.name").alias("manufacturer"),
        F.col("method_type.action").alias("action"),
        F.col("target_organism.normalized").alias("organism"),
        F.col("validation_scope.raw").alias("scope"),
        F.col("certification.original_date").cast("string").alias("original_date"),
        F.array_join("certification.renewal_dates", ",").alias("renewals"),
        F.array_join("certification.extension_dates", ",").alias("extensions"),
        F.col("certification.current_expiry").cast("string").alias("current_expiry"),
        F.col("certification.status").alias("status"),
        F.col("traceability.extraction_confidence").alias("confidence"),
        F.col("traceability.organism_page_last_updated_raw").alias("page_date"))


@query("certificate_numbers", """
SELECT l_orderkey, CASE l_returnflag
   WHEN 'A' THEN 'ORD ' || substr(d, 1, 2) || '/' || substr(d, 3, 2) || '-' || substr(d, 5, 2) || '/' || substr(d, 7, 2) || ' ' || l_linestatus
   WHEN 'R' THEN 'ORD ' || substr(d, 1, 2) || '/' || substr(d, 3, 2) || '-' || substr(d, 5, 2) || '/' || substr(d, 7, 2) END AS certificate_number,
   count(*) AS n
FROM (SELECT *, lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS d FROM lineitem) GROUP BY 1, 2""")
def certificate_numbers(spark, sf):
    d = _digits("l_orderkey")
    stem = F.concat(F.substring(d, 1, 2), F.lit("-"), F.substring(d, 3, 2), F.lit("_"),
                    F.substring(d, 5, 2), F.lit("-"), F.substring(d, 7, 2))
    url = (F.when(F.col("l_returnflag") == "A", F.concat(
        F.lit("https://x.org/a/ORD-"), stem, F.lit("-"), F.col("l_linestatus"), F.lit("_fr.docx-2.pdf")))
        .when(F.col("l_returnflag") == "R", F.concat(
            F.lit("https://x.org/AB-01-02-03-04/ORD-"), stem, F.lit("-"), F.col("l_linestatus"),
            F.lit("xtra.pdf")))
        .otherwise("https://x.org/AB-01-02-03-04/unnamed.pdf"))
    return (table(spark, sf, "lineitem")
            .select("l_orderkey", values.certificate_from_url(url).alias("certificate_number"))
            .groupBy("l_orderkey", "certificate_number").agg(F.count("*").alias("n")))


# --- Snapshots ---------------------------------------------------------------

@query("carried_forward", """
WITH new AS (SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'n' ELSE 'c' END || c_custkey AS id, c_name, CAST(NULL AS VARCHAR) AS performance,
                    CASE WHEN c_acctbal > 5000 THEN 'new lab' END AS lab FROM customer),
prev AS (SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN 'p' ELSE 'c' END || c_custkey AS id, lower(c_name) AS c_name,
                CASE WHEN c_acctbal > 0 THEN 'mined ' || c_nationkey END AS performance, 'old lab' AS lab FROM customer)
SELECT COALESCE(n.id, p.id) AS id, COALESCE(n.c_name, p.c_name) AS c_name,
       COALESCE(n.performance, p.performance) AS performance, COALESCE(n.lab, p.lab) AS lab
FROM new n FULL JOIN prev p ON n.id = p.id""")
def carried_forward(spark, sf):
    c = table(spark, sf, "customer")

    def key(segment: str, other: str):
        return F.concat(F.when(F.col("c_mktsegment") == segment, other).otherwise("c"), F.col("c_custkey")).alias("id")

    new = c.select(
        key("BUILDING", "n"), "c_name", F.lit(None).cast("string").alias("performance"),
        F.when(F.col("c_acctbal") > 5000, "new lab").alias("lab"))
    prev = c.select(
        key("MACHINERY", "p"), F.lower("c_name").alias("c_name"),
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("mined "), F.col("c_nationkey")))
        .alias("performance"), F.lit("old lab").alias("lab"))
    return snapshot.carry_forward(new, prev, ["performance", "lab"])


def _checks():
    return [(F.col("o_totalprice") < 20000, "price too low"),
            (F.col("o_orderdate").isNull() | (F.col("o_orderdate") < "1995-03-01"), "date too early"),
            (~F.col("o_orderstatus").isin("F", "O"), "status is not known")]


CHECK_SQL = """CASE WHEN o_totalprice < 20000 THEN 'price too low' WHEN o_orderdate < '1995-03-01' THEN 'date too early'
  WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status is not known' END"""


@query("rejected_records", f"""SELECT o_orderkey, reason FROM (SELECT o_orderkey, {CHECK_SQL} AS reason FROM orders)
WHERE reason IS NOT NULL""")
def rejected_records(spark, sf):
    return snapshot.split_valid(table(spark, sf, "orders"), _checks())[1].select("o_orderkey", "reason")


@query("validation_counts", f"""SELECT COALESCE({CHECK_SQL}, 'valid') AS outcome, count(*) AS n FROM orders GROUP BY 1""")
def validation_counts(spark, sf):
    checked = snapshot.validate(table(spark, sf, "orders"), _checks())
    return reconcile.outcome_counts(checked.withColumn(
        "outcome", F.coalesce(F.try_element_at("errors", F.lit(1)), F.lit("valid"))))


# --- The list-and-detail registry: parts as certificates ---------------------

TECH_NAMES = {"anvil": "Petrifilm", "bolt": "Compact Dry XY", "gear": "MALDI thing", "gizmo": "real PCR kit",
              "plate": "ELISA reader", "ring": "plain", "rod": "Soleris vial", "widget": "Brilliance agar"}
TECH_EXPECTED = {"anvil": "culture_media", "bolt": "culture_media", "gear": "biochemical",
                 "gizmo": "molecular_pcr", "plate": "immunological_elisa", "rod": "biochemical",
                 "widget": "chromogenic_agar"}
ANALYTES = {"anvil": " Bacillus cereus group ", "bolt": "Listeria spp.; Listeria monocytogenes",
            "gear": "Salmonella spp.; typing of 106 serovars.", "gizmo": "Total viable count "}
ANALYTES_EXPECTED = {"anvil": "Bacillus cereus", "bolt": "Listeria spp. and L. monocytogenes",
                     "gear": "Salmonella spp.", "gizmo": "Total viable count"}


def list_rows(spark, sf):
    part = table(spark, sf, "part")
    n = inputs.noun(F.col("p_name"))
    none = F.lit(None).cast("string")
    return part.select(
        inputs.phrase(n, ANALYTES).alias("analyte_raw"),
        F.concat(F.lit("2020LR"), F.col("p_partkey")).alias("certificate_number"),
        inputs.phrase(n, TECH_NAMES).alias("commercial_name"), F.col("p_brand").alias("manufacturer_raw"),
        F.when(F.col("p_size") <= 28, F.concat(F.lpad(F.col("p_size").cast("string"), 2, "0"),
                                               F.lit("-02-1999 (est.)")))
        .when(F.col("p_size") <= 31, F.concat(F.col("p_size"), F.lit("-02-1998")))
        .when(F.col("p_size") <= 45, "01-01-1998").alias("expiry_date_raw"),
        inputs.phrase(F.col("p_type"), {"PROMO": "Valid", "ECONOMY": " VALID ", "SMALL": "Not renewed",
                                        "LARGE": "Withdrawn", "MEDIUM": "Pending"}).alias("status_raw"),
        F.lit("list").alias("label"), F.lit("https://example.org/list").alias("source_page_url"),
        F.when(F.col("p_size") > 10, F.concat_ws(", ", F.lit("raw milk"), "p_type", F.lit(" cheese")))
        .alias("matrices_raw"), F.lit("ISO 4833").alias("reference_method_raw"),
        none.alias("first_approval_date_raw"),
        F.when(F.col("p_type") != "PROMO", "https://example.org/c.pdf").alias("certificate_pdf_url"),
        F.when(F.col("p_type") == "SMALL", "https://example.org/r.pdf").alias("summary_report_pdf_url"))


SHOWN = "COALESCE('''' || {} || '''', 'None')"
LIST_SQL = f"""
raw AS (SELECT *, split_part(p_name, ' ', 2) AS noun,
   CASE WHEN p_size <= 28 THEN lpad(CAST(p_size AS VARCHAR), 2, '0') || '-02-1999 (est.)' WHEN p_size <= 31 THEN p_size || '-02-1998' WHEN p_size <= 45 THEN '01-01-1998' END AS exp_raw,
   CASE WHEN p_size <= 28 THEN DATE '1999-02-01' + (p_size - 1) WHEN p_size <= 31 THEN NULL WHEN p_size <= 45 THEN DATE '1998-01-01' END AS exp,
   CASE p_type WHEN 'PROMO' THEN 'Valid' WHEN 'ECONOMY' THEN ' VALID ' WHEN 'SMALL' THEN 'Not renewed' WHEN 'LARGE' THEN 'Withdrawn' WHEN 'MEDIUM' THEN 'Pending' END AS st FROM part),
recs AS (SELECT 'microval--2020lr' || p_partkey AS id,
   {inputs.sql_phrase('noun', TECH_EXPECTED)} AS category, {inputs.sql_phrase('noun', ANALYTES_EXPECTED)} AS organism,
   CAST(exp AS VARCHAR) AS current_expiry,
   CASE WHEN st IN ('Valid', ' VALID ') THEN CASE WHEN exp < DATE '{TODAY}' THEN 'expired' ELSE 'active' END
        WHEN st IN ('Not renewed', 'Withdrawn') THEN 'expired' ELSE 'unknown' END AS status,
   CASE WHEN p_size > 10 THEN 'raw milk|' || p_type || '|cheese' ELSE '' END AS matrices,
   'MicroVal listing page label: ''list''. Raw status text: ' || {SHOWN.format('st')} || ', raw expiry text: ' || {SHOWN.format('exp_raw')} || '.' ||
   CASE WHEN p_type = 'PROMO' THEN '' WHEN p_type = 'SMALL' THEN ' Study report available for further mining.'
        ELSE ' Study report not published on MicroVal''s certificate detail page.' END AS notes FROM raw)"""


@query("list_registry_records", f"WITH {LIST_SQL} SELECT * FROM recs")
def list_registry_records(spark, sf):
    rec = canonical.from_list_rows(list_rows(spark, sf), TODAY)
    return rec.select(
        "id", F.col("method_type.category").alias("category"),
        F.col("target_organism.normalized").alias("organism"),
        F.col("certification.current_expiry").cast("string").alias("current_expiry"),
        F.col("certification.status").alias("status"),
        F.array_join("validation_scope.matrices", "|").alias("matrices"),
        F.col("traceability.notes").alias("notes"))


@query("guarded_rows", f"""SELECT COALESCE(CASE WHEN noun = 'ring' THEN 'no commercial_name' END, 'ok') AS reason, count(*) AS n
FROM (SELECT split_part(p_name, ' ', 2) AS noun FROM part) GROUP BY 1""")
def guarded_rows(spark, sf):
    rows = list_rows(spark, sf).withColumn(
        "commercial_name", F.nullif("commercial_name", F.lit("plain")))
    good, bad = raw.guard(rows, ["certificate_number", "commercial_name"])
    both = good.select(F.lit("ok").alias("reason")).unionByName(bad.select("reason"))
    return reconcile.outcome_counts(both, "reason")


@query("merged_performance", f"""WITH {LIST_SQL},
mined AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_quantity > 45 GROUP BY 1)
SELECT r.id, n IS NOT NULL AS has_performance,
       CASE WHEN n IS NOT NULL THEN notes || ' Mined from ' || n || ' lines.' ELSE notes END AS notes
FROM recs r LEFT JOIN mined ON r.id = 'microval--2020lr' || l_partkey""")
def merged_performance(spark, sf):
    from .. import schemas
    records = canonical.from_list_rows(list_rows(spark, sf), TODAY)
    n = F.col("n")
    mined = (table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.count_if((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_quantity") > 45)).alias("n")).select(
        F.concat(F.when(n > 0, "2020LR").otherwise("unknown "), F.col("l_partkey")).alias("certificate_number"),
        F.struct(F.lit("quantitative").alias("method_nature"),
                 F.lit(None).cast(schemas.PERFORMANCE["quantitative"].dataType).alias("quantitative"),
                 F.lit(None).cast(schemas.PERFORMANCE["qualitative"].dataType).alias("qualitative"))
        .alias("performance"),
        F.concat(F.lit("Mined from "), n, F.lit(" lines.")).alias("mining_notes")))
    merged, _ = snapshot.merge_performance(records, mined)
    return merged.select("id", F.col("performance").isNotNull().alias("has_performance"),
                         F.col("traceability.notes").alias("notes"))


@query("detail_pages", """
SELECT o_orderkey, CASE WHEN n IS NOT NULL THEN 'matrices ' || n END AS matrices_raw, o_orderpriority AS status_raw
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
  AND o_orderstatus <> 'P'""")
def detail_pages(spark, sf):
    own = F.concat(F.lit("https://example.org/own/"), F.col("o_orderkey"))
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("certificate_number"),
        F.col("o_orderpriority").alias("status_raw"),
        F.when(F.col("o_orderstatus") == "F", own).when(F.col("o_orderstatus") == "P", "https://example.org/gone")
        .alias("detail_page_url"), F.lit(None).cast("string").alias("matrices_raw"))
    counted = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    status = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    details = counted.join(status, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("https://example.org/own/"), F.col("l_orderkey")))
        .otherwise(F.concat(F.lit("https://example.org/?cert="), F.col("l_orderkey"), F.lit("&v=1")))
        .alias("url"), F.concat(F.lit("matrices "), F.col("n")).alias("matrices_raw"))
    return reconcile.attach_details(rows, details, "https://example.org/?cert={}&v=1").select(
        "o_orderkey", "matrices_raw", "status_raw")


# --- Batch results -----------------------------------------------------------

@query("identifier_collisions", """
SELECT custom_id, CASE WHEN rn = 1 THEN 'kept' ELSE 'collides' END AS outcome, count(*) AS n
FROM (SELECT substr(regexp_replace(p_name || '/' || p_brand || '.' || p_type, '[^A-Za-z0-9_-]', '-', 'g'), 1, 16) AS custom_id,
             row_number() OVER (PARTITION BY substr(regexp_replace(p_name || '/' || p_brand || '.' || p_type, '[^A-Za-z0-9_-]', '-', 'g'), 1, 16) ORDER BY p_partkey) AS rn FROM part)
GROUP BY 1, 2""")
def identifier_collisions(spark, sf):
    name = F.concat(F.col("p_name"), F.lit("/"), F.col("p_brand"), F.lit("."), F.col("p_type"))
    parts = table(spark, sf, "part").select("p_partkey", api_id(name, 16).alias("custom_id"))
    return (reconcile.split_collisions(parts, "custom_id", "p_partkey")
            .groupBy("custom_id", "outcome").agg(F.count("*").alias("n")))


RESULT_SQL = """
results AS (SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'N' THEN 'errored' ELSE 'succeeded' END AS kind,
    CASE WHEN l_discount < 0.03 THEN 0 ELSE 3 END AS n_rows, l_tax < 0.06 AS valid,
    CAST(l_quantity AS BIGINT) * 1000 AS input_tokens, CAST(l_linenumber AS BIGINT) * 100 AS output_tokens FROM lineitem),
judged AS (SELECT r.*, CASE WHEN o_orderkey IS NULL OR kind <> 'succeeded' THEN 'failed' WHEN n_rows = 0 THEN 'no_data'
    WHEN NOT valid THEN 'invalid' ELSE 'written' END AS outcome
  FROM results r LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey)"""


def _results(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("r-"), F.col("l_orderkey")).alias("custom_id"),
        F.when(F.col("l_returnflag") == "N", "errored").otherwise("succeeded").alias("kind"),
        F.when(F.col("l_discount") < 0.03, 0).otherwise(3).alias("n_rows"),
        (F.col("l_tax") < 0.06).alias("valid"),
        (F.col("l_quantity").cast("bigint") * 1000).alias("input_tokens"),
        (F.col("l_linenumber").cast("bigint") * 100).alias("output_tokens"))
    records = table(spark, sf, "orders").filter("o_orderstatus <> 'P'").select(
        F.concat(F.lit("r-"), F.col("o_orderkey")).alias("custom_id"))
    return results.match_results(lines, records, F.col("n_rows"), F.col("valid"))


@query("result_outcomes", f"WITH {RESULT_SQL} SELECT outcome, count(*) AS n FROM judged GROUP BY 1")
def result_outcomes(spark, sf):
    return reconcile.outcome_counts(_results(spark, sf))


@query("batch_cost", f"""WITH {RESULT_SQL},
t AS (SELECT count(*) AS results, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens FROM judged),
b AS (SELECT count(*) AS remaining FROM orders WHERE o_orderstatus = 'P')
SELECT results, input_tokens, output_tokens, remaining,
       CAST(round((input_tokens + 5 * output_tokens) / 1e6 * 100) AS BIGINT) AS usd_cents,
       CAST(round((input_tokens + 5 * output_tokens) / 1e6 / results * remaining * 100) AS BIGINT) AS remaining_cents FROM t, b""")
def batch_cost(spark, sf):
    backlog = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    c = results.cost(_results(spark, sf), backlog)
    return c.select("results", "input_tokens", "output_tokens", "remaining",
                    F.round(F.col("usd") * 100).cast("bigint").alias("usd_cents"),
                    F.round(F.col("usd_for_remaining") * 100).cast("bigint").alias("remaining_cents"))


AGGREGATES = {"anvil": "All categories", "bolt": "  total counts", "gear": "Totally fine", "gizmo": "Overall",
              "plate": "global results", "ring": "all matrices", "rod": "All good", "widget": "Meat"}


@query("dropped_aggregate_rows", f"""
SELECT category, count(*) AS n FROM (SELECT {inputs.sql_phrase("split_part(p_name, ' ', 2)", AGGREGATES)} AS category
  FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE category NOT IN ('Totally fine', 'All good', 'Meat') GROUP BY 1""")
def dropped_aggregate_rows(spark, sf):
    rows = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).select(
        inputs.phrase(inputs.noun(F.col("p_name")), AGGREGATES).alias("category"))
    return results.drop_aggregate_rows(rows)[1].groupBy("category").agg(F.count("*").alias("n"))


@query("breakdown_flags", """
SELECT o_orderstatus, q.n IS NOT NULL AND ((o_orderstatus = 'F' AND nr > 0) OR (o_orderstatus <> 'F' AND nf > 0)) AS has_breakdown, count(*) AS n
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS nr,
   count(*) FILTER (l_linestatus = 'F') AS nf FROM lineitem GROUP BY 1) q ON o_orderkey = l_orderkey GROUP BY 1, 2""")
def breakdown_flags(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("quant"), F.count_if(F.col("l_linestatus") == "F").alias("qual"))
    nature = F.when(F.col("o_orderstatus") == "F", "quantitative").otherwise("qualitative")
    joined = table(spark, sf, "orders").join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return (joined.select("o_orderstatus", results.has_breakdown(
        nature, F.col("quant"), F.col("qual")).alias("has_breakdown"))
        .groupBy("o_orderstatus", "has_breakdown").agg(F.count("*").alias("n")))


TARGET_SQL = """FROM orders WHERE o_totalprice > 30000 AND o_orderstatus <> 'P'
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""


def _targets(spark, sf, **kw):
    records = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("source"),
        F.lower("o_orderpriority").alias("category"),
        F.when(F.col("o_totalprice") > 30000, "https://example.org/r.pdf").otherwise("")
        .alias("summary_report_url"))
    mined = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id"))
    return raw.mining_targets(records, mined, excluded=["P"], **kw).select("id", "source")


@query("mining_targets", f"SELECT o_orderkey AS id, o_orderstatus AS source {TARGET_SQL}")
def mining_targets(spark, sf):
    return _targets(spark, sf)


@query("next_mining_targets", f"SELECT o_orderkey AS id, o_orderstatus AS source {TARGET_SQL} ORDER BY id LIMIT 25")
def next_mining_targets(spark, sf):
    return _targets(spark, sf, limit=25)


# --- Calibration -------------------------------------------------------------

CALIBRATION_SQL = """
base AS (SELECT l_orderkey AS doc_id, l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice, l_returnflag, p_type,
   CASE WHEN l_returnflag <> 'N' THEN l_discount END AS t_bias, CASE WHEN l_linestatus = 'F' THEN l_tax END AS t_sd,
   CASE WHEN l_returnflag = 'A' THEN l_discount + l_tax WHEN l_returnflag = 'R' THEN l_discount END AS o_bias,
   CASE WHEN l_quantity > 10 THEN l_tax + 0.01 END AS o_sd
   FROM lineitem JOIN part ON l_partkey = p_partkey),
truth AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p_type ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM base) WHERE rn = 1),
other AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, p_type ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM base WHERE l_returnflag <> 'R') WHERE rn = 1),
pairs AS (SELECT t.doc_id, t.p_type, 'bias_log' AS field, t.t_bias AS a, o.o_bias AS b, o.doc_id IS NULL AS gone FROM truth t LEFT JOIN other o USING (doc_id, p_type)
  UNION ALL SELECT t.doc_id, t.p_type, 'sd_log', t.t_sd, o.o_sd, o.doc_id IS NULL FROM truth t LEFT JOIN other o USING (doc_id, p_type)),
verdicts AS (SELECT *, CASE WHEN gone THEN 'missing' WHEN a IS NULL AND b IS NULL THEN 'match' WHEN a IS NULL OR b IS NULL THEN 'mismatch'
  WHEN abs(a - b) <= 0.05 THEN 'match' ELSE 'mismatch' END AS verdict FROM pairs)"""


CALIBRATED = ["bias_log", "sd_log"]


def _verdicts(spark, sf):
    lines = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    flag = F.col("l_returnflag")
    truth = lines.select(
        F.col("l_orderkey").alias("doc_id"), F.concat(F.lit(" "), F.col("p_type")).alias("category"),
        order.alias("row_no"), F.when(flag != "N", F.col("l_discount")).alias("bias_log"),
        F.when(F.col("l_linestatus") == "F", F.col("l_tax")).alias("sd_log"))
    other = lines.filter(flag != "R").select(
        F.col("l_orderkey").alias("doc_id"), F.lower("p_type").alias("category"),
        order.alias("row_no"),
        F.when(flag == "A", F.col("l_discount") + F.col("l_tax"))
        .when(flag == "R", F.col("l_discount")).alias("bias_log"),
        F.when(F.col("l_quantity") > 10, F.col("l_tax") + 0.01).alias("sd_log"))
    return quality.compare(truth, other, CALIBRATED)


@query("calibration_verdicts", f"""WITH {CALIBRATION_SQL}
SELECT field, verdict, count(*) AS n FROM verdicts GROUP BY 1, 2""")
def calibration_verdicts(spark, sf):
    return _verdicts(spark, sf).groupBy("field", "verdict").agg(F.count("*").alias("n"))


@query("calibration_agreement", f"""WITH {CALIBRATION_SQL}
SELECT doc_id, count(*) FILTER (verdict <> 'missing') AS total_fields, count(*) FILTER (verdict = 'match') AS matched_fields,
       count(DISTINCT CASE WHEN verdict = 'missing' THEN p_type END) AS missing_categories FROM verdicts GROUP BY 1""")
def calibration_agreement(spark, sf):
    return quality.agreement(_verdicts(spark, sf), ["doc_id"], fields=len(CALIBRATED))


@query("calibration_outcomes", """
SELECT CASE WHEN n IS NULL THEN 'no_data' WHEN flag <> CASE WHEN o_orderstatus = 'F' THEN 'R' ELSE 'A' END THEN 'nature_mismatch'
            WHEN n = 0 THEN 'zero_rows' ELSE 'compared' END AS outcome, count(*) AS n_records
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_returnflag) AS flag, count(*) FILTER (l_linestatus = 'F') AS n FROM lineitem GROUP BY 1)
  ON o_orderkey = l_orderkey GROUP BY 1""")
def calibration_outcomes(spark, sf):
    truth = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.when(F.col("o_orderstatus") == "F", "R").otherwise("A").alias("method_nature"))
    other = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(
        F.min("l_returnflag").alias("method_nature"),
        F.count_if(F.col("l_linestatus") == "F").alias("n_rows"))
    return (quality.record_outcomes(truth, other).groupBy("outcome")
            .agg(F.count("*").alias("n_records")))


@query("calibration_sample", """
SELECT o_orderkey AS doc_id FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) ORDER BY 1 LIMIT 10""")
def calibration_sample(spark, sf):
    known = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    candidates = table(spark, sf, "orders").join(known, "o_orderkey", "left_semi")
    return quality.sample(candidates, "o_orderkey", 10).select(F.col("o_orderkey").alias("doc_id"))


@query("missing_sample_names", """
SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def missing_sample_names(spark, sf):
    candidates = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return quality.named_sample(candidates, table(spark, sf, "orders"), "o_orderkey")[1]


@query("collector_index", """
SELECT source, count(*) AS count, count(DISTINCT text) AS keys FROM documents GROUP BY 1""")
def collector_index(spark, sf):
    return raw.index_of(table(spark, sf, "documents"), "text")
