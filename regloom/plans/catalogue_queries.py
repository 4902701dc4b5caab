"""Catalogue, facets, grid, filters and summaries."""
from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions import classify, values
from ..operators import browse, catalogue, reconcile
from . import inputs
from .inputs import ENTRIES_SQL, FOOD_ID_SQL, MENTIONS_SQL, TODAY, table
from .registry import query

FACET_SQL = """
facet_rows AS (
  SELECT 'organisms' AS facet, organism AS value FROM entries
  UNION ALL SELECT 'manufacturers', manufacturer_name FROM entries
  UNION ALL SELECT 'expert_laboratories', expert_laboratory FROM entries
  UNION ALL SELECT 'method_categories', method_category FROM entries
  UNION ALL SELECT 'sources', source FROM entries),
facets AS (
  SELECT facet, value, count(*) AS n FROM facet_rows
  WHERE value IS NOT NULL AND value <> '' GROUP BY 1, 2)"""
WITH_FACETS = f"WITH {ENTRIES_SQL}, {FACET_SQL}"
FOOD_VALUES = ", ".join("({}, '{}', '{}')".format(i, cid, label) for i, (cid, label)
                        in enumerate(vocab.FOOD_CATEGORIES, 1))
FOOD_DIM = f"food(ord, cid, label) AS (VALUES {FOOD_VALUES})"


@query("status_counts", f"""WITH {ENTRIES_SQL}
SELECT source, status, count(*) AS n FROM entries GROUP BY 1, 2""")
def status_counts(spark, sf):
    return inputs.entries(spark, sf).groupBy("source", "status").agg(F.count("*").alias("n"))


@query("facet_counts", f"{WITH_FACETS} SELECT facet, value, n FROM facets")
def facet_counts(spark, sf):
    return catalogue.facet_counts(inputs.entries(spark, sf))


@query("facet_vocabulary", f"{WITH_FACETS} SELECT facet, value FROM facets")
def facet_vocabulary(spark, sf):
    return catalogue.facet_vocabulary(inputs.entries(spark, sf))


@query("collapsed_facets", f"""{WITH_FACETS},
ranked AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY n DESC, value) AS rn,
                  count(*) OVER (PARTITION BY facet) AS total FROM facets),
shown AS (SELECT * FROM ranked WHERE rn <= 8 OR (facet = 'organisms' AND value IN (SELECT n_name FROM nation WHERE n_regionkey = 2)))
SELECT facet, value, n, total - count(*) OVER (PARTITION BY facet) AS hidden FROM shown""")
def collapsed_facets(spark, sf):
    chosen = table(spark, sf, "nation").filter("n_regionkey = 2").select(
        F.lit("organisms").alias("facet"), F.col("n_name").alias("value"))
    return catalogue.collapsed_facets(catalogue.facet_counts(inputs.entries(spark, sf)), chosen)


@query("technology_grid", f"""WITH {ENTRIES_SQL}
SELECT organism, method_category_label AS category, count(*) AS n FROM entries GROUP BY 1, 2""")
def technology_grid(spark, sf):
    rows = catalogue.grid_rows(inputs.entries(spark, sf), "method_category_label")
    return catalogue.grid_counts(rows)


def _with_categories(spark, sf):
    entries = inputs.entries(spark, sf)
    tested = catalogue.tested_categories_by_key(inputs.mentions(spark, sf), "id", "raw")
    lists = tested.groupBy("id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("ord", "label"))), lambda x: x["label"])
        .alias("tested_categories"))
    return entries.join(lists, "id", "left").withColumn(
        "tested_categories", F.coalesce("tested_categories", F.array().cast("array<string>")))


TESTED_SQL = f"""{ENTRIES_SQL}, {MENTIONS_SQL}, {FOOD_DIM},
tested AS (SELECT DISTINCT id, {FOOD_ID_SQL} AS cid FROM mentions),
grid AS (SELECT e.id, e.organism, COALESCE(f.label, 'Not yet mined') AS category
         FROM entries e LEFT JOIN (SELECT * FROM tested WHERE cid IS NOT NULL) t ON e.id = t.id
         LEFT JOIN food f ON t.cid = f.cid),
cols AS (SELECT ord, label FROM food UNION ALL SELECT 19, 'Not yet mined')"""


@query("tested_category_heatmap", f"""WITH {TESTED_SQL},
counts AS (SELECT organism, category, count(*) AS n FROM grid GROUP BY 1, 2),
totals AS (SELECT organism, count(*) AS organism_total FROM entries GROUP BY 1)
SELECT t.organism, organism_total, CAST(c.ord AS BIGINT) AS col_order, c.label AS category,
       COALESCE(n, 0) AS n,
       CAST(CASE WHEN COALESCE(n, 0) = 0 THEN 0 ELSE least(4, greatest(1, ceil(n * 4 / 10.0))) END AS BIGINT) AS heat
FROM totals t CROSS JOIN cols c LEFT JOIN counts k ON k.organism = t.organism AND k.category = c.label""")
def tested_category_heatmap(spark, sf):
    grid = catalogue.heatmap(_with_categories(spark, sf), catalogue.fixed_columns())
    return grid.withColumns({c: F.col(c).cast("bigint") for c in ("col_order", "heat")})


@query("cell_members", f"""WITH {TESTED_SQL}
SELECT id, organism, category FROM grid
WHERE organism = 'NATION_3' AND category = 'Eggs and egg products (derivates)'""")
def cell_members(spark, sf):
    rows = catalogue.grid_rows(_with_categories(spark, sf))
    return catalogue.drill_down(rows, "NATION_3", "Eggs and egg products (derivates)").select(
        "id", "organism", "category")


@query("tested_categories", f"""WITH {MENTIONS_SQL}, {FOOD_DIM}
SELECT id, string_agg(label, ' | ' ORDER BY ord) AS tested, count(*) AS n
FROM (SELECT DISTINCT id, {FOOD_ID_SQL} AS cid FROM mentions) JOIN food USING (cid) GROUP BY id""")
def tested_categories(spark, sf):
    tested = catalogue.tested_categories_by_key(inputs.mentions(spark, sf), "id", "raw")
    return tested.groupBy("id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "label"))),
                                 lambda x: x["label"]), " | ").alias("tested"),
        F.count("*").alias("n"))


@query("category_residual", f"""WITH {MENTIONS_SQL}
SELECT raw, count(*) AS n FROM mentions WHERE ({FOOD_ID_SQL}) IS NULL GROUP BY raw""")
def category_residual(spark, sf):
    return catalogue.residual(inputs.mentions(spark, sf), "raw",
                              classify.food_category(F.col("raw")))


@query("mining_coverage", f"""WITH {ENTRIES_SQL}
SELECT count(*) FILTER (has_performance_data) AS mined, count(*) AS total,
       CAST(floor(count(*) FILTER (has_performance_data) * 100.0 / count(*) + 0.5) AS BIGINT) AS pct
FROM entries WHERE status = 'active'""")
def mining_coverage(spark, sf):
    return catalogue.coverage(inputs.entries(spark, sf).filter("status = 'active'"))


FILTERED = """organism IN ('NATION_3', 'NATION_7', 'NATION_12') AND source IN ('REG-O', 'REG-F')
  AND current_expiry < DATE '2000-01-01' AND current_expiry >= DATE '1996-06-01'
  AND contains(lower(concat_ws(' ', commercial_name, manufacturer_name, organism,
      method_category_label, expert_laboratory, source_certificate_number, reference_method)), 'urgent')"""


def _filtered(spark, sf):
    return browse.filter_entries(
        inputs.entries(spark, sf),
        {"organisms": ["NATION_3", "NATION_7", "NATION_12"], "sources": ["REG-O", "REG-F"], "statuses": []},
        expires_before="2000-01-01", expires_after="1996-06-01", search="URGENT")


@query("catalogue_filter", f"""WITH {ENTRIES_SQL}
SELECT id, organism, source, CAST(current_expiry AS VARCHAR) AS current_expiry FROM entries WHERE {FILTERED}""")
def catalogue_filter(spark, sf):
    return _filtered(spark, sf).select("id", "organism", "source",
                                       F.col("current_expiry").cast("string").alias("current_expiry"))


@query("explorer_filter", f"""WITH {ENTRIES_SQL}
SELECT id, organism, manufacturer_name FROM entries
WHERE status = 'active' AND manufacturer_name LIKE '%7%'
  AND contains(lower(organism || ' ' || commercial_name || ' ' || manufacturer_name), '5-low')""")
def explorer_filter(spark, sf):
    rows = browse.filter_entries(inputs.entries(spark, sf), browse.EXPLORER_DEFAULT,
                                 search="5-low", search_fields=browse.EXPLORER_SEARCH)
    return rows.filter(F.contains("manufacturer_name", F.lit("7"))).select(
        "id", "organism", "manufacturer_name")


@query("catalogue_page", f"""WITH {ENTRIES_SQL},
sized AS (SELECT id, reference_method, source_certificate_number,
                 CASE WHEN reference_method <> '' THEN lpad(substr(reference_method, 5), 20, '0') END AS k
          FROM entries)
SELECT id, reference_method, source_certificate_number FROM sized
ORDER BY k DESC NULLS LAST, id LIMIT 100""")
def catalogue_page(spark, sf):
    page = browse.sort_entries(inputs.entries(spark, sf), "reference_method", descending=True,
                               limit=100)
    return page.select("id", "reference_method", "source_certificate_number")


@query("blanks_last_page", f"""WITH {ENTRIES_SQL}
SELECT id, expert_laboratory FROM entries
ORDER BY lower(expert_laboratory) ASC NULLS LAST, id LIMIT 200""")
def blanks_last_page(spark, sf):
    return browse.sort_entries(inputs.entries(spark, sf), "expert_laboratory",
                               limit=200).select("id", "expert_laboratory")


SUMMARY_COLUMNS = """count(*) AS n_rows, count(DISTINCT manufacturer_name) AS n_makers,
  count(*) FILTER (date_diff('day', DATE '{t}', current_expiry) / 30.44 >= 0
                   AND date_diff('day', DATE '{t}', current_expiry) / 30.44 < 12) AS expiring_soon,
  count(*) FILTER (status = 'expired') AS expired,
  count(*) FILTER (has_performance_data) AS with_performance""".format(t=TODAY)


@query("result_summary", f"""WITH {ENTRIES_SQL},
picked AS (SELECT * FROM entries WHERE {FILTERED})
SELECT {SUMMARY_COLUMNS},
  (SELECT string_agg(m, ', ' ORDER BY m) FROM (SELECT DISTINCT manufacturer_name AS m FROM picked ORDER BY m LIMIT 3)) AS first_makers
FROM picked""")
def result_summary(spark, sf):
    return browse.summarize(_filtered(spark, sf), TODAY)


@query("organism_summaries", f"""WITH {ENTRIES_SQL},
makers AS (SELECT organism, manufacturer_name AS m, row_number() OVER (PARTITION BY organism ORDER BY manufacturer_name) AS rn
           FROM (SELECT DISTINCT organism, manufacturer_name FROM entries)),
three AS (SELECT organism, string_agg(m, ', ' ORDER BY m) AS first_makers FROM makers WHERE rn <= 3 GROUP BY 1)
SELECT organism, {SUMMARY_COLUMNS}, any_value(first_makers) AS first_makers
FROM entries JOIN three USING (organism) GROUP BY organism""")
def organism_summaries(spark, sf):
    return browse.summarize(inputs.entries(spark, sf), TODAY, ["organism"])


@query("expiry_classes", f"""WITH {ENTRIES_SQL},
c AS (SELECT source, date_diff('day', DATE '{TODAY}', current_expiry) / 30.44 AS m FROM entries)
SELECT source, CASE WHEN m < 0 THEN 'bad' WHEN m < 12 THEN 'warn' WHEN m >= 12 THEN 'ok' END AS class, count(*) AS n
FROM c GROUP BY 1, 2""")
def expiry_classes(spark, sf):
    return (inputs.entries(spark, sf)
            .select("source", values.expiry_class(F.col("current_expiry"), TODAY).alias("class"))
            .groupBy("source", "class").agg(F.count("*").alias("n")))


@query("report_links", """
SELECT CASE WHEN o_totalprice > 200000 THEN 'https://reports.example.org/' || o_orderkey || '.pdf'
            WHEN o_orderstatus = 'F' THEN 'https://nf-validation.afnor.org/en/food-industry/'
            WHEN o_orderstatus = 'O' THEN 'https://microval.org/certified-methods/' END AS report_url,
       o_totalprice > 200000 AS direct,
       CASE o_orderstatus WHEN 'F' THEN 'https://nf-validation.afnor.org/en/food-industry/'
            WHEN 'O' THEN 'https://microval.org/certified-methods/' END AS page_url, o_orderkey
FROM orders""")
def report_links(spark, sf):
    source = inputs.phrase(F.col("o_orderstatus"), {"F": "NF-VALIDATION", "O": "MICROVAL"})
    url = F.when(F.col("o_totalprice") > 200000, F.concat(
        F.lit("https://reports.example.org/"), F.col("o_orderkey"), F.lit(".pdf"))).otherwise("")
    links = values.links(source, url, F.lit(None).cast("string"), F.lit(""))
    return table(spark, sf, "orders").select("o_orderkey", links.alias("l")).select(
        F.col("l.summary_report_url").alias("report_url"),
        F.col("l.summary_report_is_direct").alias("direct"),
        F.col("l.source_page_url").alias("page_url"), "o_orderkey")


@query("excluded_sources", f"""WITH {ENTRIES_SQL}
SELECT source, count(*) AS skipped FROM entries WHERE source IN ('REG-P') GROUP BY 1""")
def excluded_sources(spark, sf):
    return catalogue.drop_sources(inputs.entries(spark, sf), ["REG-P"])[1]


@query("kept_sources", f"""WITH {ENTRIES_SQL}
SELECT source, organism, count(*) AS n FROM entries WHERE source <> 'REG-P' GROUP BY 1, 2""")
def kept_sources(spark, sf):
    kept = catalogue.drop_sources(inputs.entries(spark, sf), ["REG-P"])[0]
    return kept.groupBy("source", "organism").agg(F.count("*").alias("n"))


@query("method_details", f"""WITH {ENTRIES_SQL}, {MENTIONS_SQL}
SELECT m.id, raw AS category, metric, CAST(round(value * 100) AS BIGINT) AS hundredths
FROM (SELECT id, raw, 'bias_log' AS metric, l_discount AS value FROM mentions
      UNION ALL SELECT id, raw, 'sd_log', l_tax FROM mentions) m
WHERE m.id IN (SELECT id FROM entries WHERE {FILTERED})""")
def method_details(spark, sf):
    from ..operators.report import performance_facts
    rows = inputs.mentions(spark, sf).select(
        "id", F.col("raw").alias("category"), F.col("l_discount").alias("bias_log"),
        F.col("l_tax").alias("sd_log"))
    facts = performance_facts(rows, ["bias_log", "sd_log"], "quantitative", "id")
    return browse.details(facts, _filtered(spark, sf)).select(
        "id", "category", "metric", F.round(F.col("value") * 100).cast("bigint").alias("hundredths"))


@query("combined_sources", """
SELECT source, n_nationkey_known, count(*) AS n FROM (
  SELECT 'customers' AS source, c_nationkey IS NOT NULL AS n_nationkey_known, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'suppliers', s_nationkey IS NOT NULL, NULL FROM supplier
  UNION ALL SELECT 'parts', FALSE, NULL FROM part) GROUP BY 1, 2""")
def combined_sources(spark, sf):
    c = table(spark, sf, "customer").select(
        F.lit("customers").alias("source"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.lit("suppliers").alias("source"),
                                            F.col("s_nationkey").alias("nation"))
    p = table(spark, sf, "part").select(F.lit("parts").alias("source"))
    return (reconcile.combine_sources(c, s, p)
            .groupBy("source", F.col("nation").isNotNull().alias("n_nationkey_known"))
            .agg(F.count("*").alias("n")))
