"""Engine inputs derived from the driver's tables, in Spark and in SQL.

The driver's tables hold no certificates, so each job runs on columns that play
the same part: orders as methods, nations as organisms, customers as makers,
order lines as report pages, table rows or copies of a record. Every input is a
projection or join of whole tables and grows with them. The SQL side states the
same projection for DuckDB.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

TODAY = "1998-07-01"

NOUNS = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget"]
FOOD_PHRASES = {"anvil": "milk powders", "bolt": "Meat products", "gear": "Poultry",
                "gizmo": "Fish and seafood", "plate": "vegetables", "ring": "Miscellaneous",
                "rod": "Egg products", "widget": "composite foods"}
FOOD_QUALIFIERS = {"cold": "Raw", "hot": "Ready-to-eat", "red": "Pasteurised", "blue": "Dried",
                   "small": "", "large": "Canned"}

LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
              "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
              "l_shipdate"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by their keys before they are unrolled into many: a small file is one
    task, and what is unrolled from its rows stays partitioned by the keys."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def phrase(c: Column, mapping: dict[str, str]) -> Column:
    """A word replaced by the phrase it stands for; other words give null."""
    chain = None
    for word, text in mapping.items():
        test = c == word
        chain = F.when(test, text) if chain is None else chain.when(test, text)
    return chain


def sql_phrase(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join("WHEN '{}' THEN '{}'".format(k, str(v).replace("'", "''"))
                     for k, v in mapping.items() if v is not None)
    return f"CASE {expr} {whens} END"


def noun(c: Column) -> Column:
    return F.element_at(F.split(c, " "), 2)


def adjective(c: Column) -> Column:
    return F.element_at(F.split(c, " "), 1)


# --- Catalogue entries -------------------------------------------------------

ENTRIES_SQL = f"""
entries AS (
  SELECT 'ord-' || o_orderkey AS id, 'REG-' || o_orderstatus AS source,
         'ORD ' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS source_certificate_number,
         c_name || ' ' || o_orderpriority AS commercial_name,
         c_name AS manufacturer_name, n_name AS organism,
         lower(c_mktsegment) AS method_category, c_mktsegment AS method_category_label,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
              THEN 'Lab ' || n_regionkey || ' of ' || o_orderpriority END AS expert_laboratory,
         CASE WHEN o_totalprice >= 100000
              THEN 'ISO ' || CAST(floor(o_totalprice / 10000) AS BIGINT) ELSE '' END AS reference_method,
         CASE WHEN o_totalprice >= 50000 THEN CAST(o_orderdate AS DATE) END AS current_expiry,
         CASE WHEN o_totalprice < 50000 THEN 'unknown'
              WHEN CAST(o_orderdate AS DATE) >= DATE '{TODAY}' THEN 'active'
              ELSE 'expired' END AS status,
         o_totalprice > 250000 AS has_performance_data
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def entries(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.values import status_from_expiry
    orders, customer, nation = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, customer.c_nationkey == nation.n_nationkey))
    expiry = F.when(F.col("o_totalprice") >= 50000, F.col("o_orderdate").cast("date"))
    return joined.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey")).alias("id"),
        F.concat(F.lit("REG-"), F.col("o_orderstatus")).alias("source"),
        F.concat(F.lit("ORD "), F.lpad(F.col("o_orderkey").cast("string"), 8, "0"))
        .alias("source_certificate_number"),
        F.concat_ws(" ", "c_name", "o_orderpriority").alias("commercial_name"),
        F.col("c_name").alias("manufacturer_name"), F.col("n_name").alias("organism"),
        F.lower("c_mktsegment").alias("method_category"),
        F.col("c_mktsegment").alias("method_category_label"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.concat(
            F.lit("Lab "), F.col("n_regionkey"), F.lit(" of "), F.col("o_orderpriority")))
        .alias("expert_laboratory"),
        F.when(F.col("o_totalprice") >= 100000, F.concat(
            F.lit("ISO "), F.floor(F.col("o_totalprice") / 10000))).otherwise("")
        .alias("reference_method"),
        expiry.alias("current_expiry"), status_from_expiry(expiry, TODAY).alias("status"),
        (F.col("o_totalprice") > 250000).alias("has_performance_data"))


# --- Mined category rows: one per order line ---------------------------------

MENTIONS_SQL = f"""
mentions AS (
  SELECT 'ord-' || l_orderkey AS id, l_linenumber, l_discount, l_tax, l_quantity,
         trim(COALESCE({sql_phrase("split_part(p_name, ' ', 1)", FOOD_QUALIFIERS)}, '') || ' ' ||
              {sql_phrase("split_part(p_name, ' ', 2)", FOOD_PHRASES)}) AS raw
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# Stated from the phrases above, not by string rules: which noun and adjective
# lead to which fixed category.
FOOD_ID_SQL = """
CASE WHEN raw LIKE '%composite%' THEN 'composite_foods'
     WHEN raw LIKE 'Dried%' THEN 'dried_produce'
     WHEN raw LIKE '%Egg%' THEN 'eggs'
     WHEN raw LIKE '%Poultry' THEN CASE WHEN raw LIKE 'Ready%' THEN 'rte_poultry' ELSE 'raw_poultry' END
     WHEN raw LIKE '%Meat%' THEN CASE WHEN raw LIKE 'Ready%' THEN 'rte_meat' ELSE 'raw_meat' END
     WHEN raw LIKE '%seafood' THEN CASE WHEN raw LIKE 'Ready%' THEN 'rte_seafood' ELSE 'raw_seafood' END
     WHEN raw LIKE '%milk%' THEN CASE WHEN raw LIKE 'Pasteurised%' THEN 'heat_processed_dairy' ELSE 'raw_milk_dairy' END
     WHEN raw LIKE '%vegetables' THEN CASE WHEN raw LIKE 'Canned%' THEN 'processed_produce' ELSE 'fresh_produce' END
END"""


def mentions(spark: SparkSession, sf: str) -> DataFrame:
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    raw = F.trim(F.concat_ws(" ", phrase(adjective(F.col("p_name")), FOOD_QUALIFIERS),
                             phrase(noun(F.col("p_name")), FOOD_PHRASES)))
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.concat(F.lit("ord-"), F.col("l_orderkey")).alias("id"), "l_linenumber", "l_discount",
        "l_tax", "l_quantity", raw.alias("raw"))


# --- Study reports: a part is a report, each of its order lines a page -------

PAGE_TEXT_SQL = """
  CASE l_returnflag WHEN 'R' THEN 'Relative trueness per category. ' WHEN 'A' THEN 'Sensitivity of the method. ' ELSE 'Annex. ' END
  || CASE l_linestatus WHEN 'F' THEN 'Bias and standard deviation ' ELSE 'Storage ' END
  || CASE WHEN l_discount >= 0.08 THEN 'acceptability limit ' ELSE '' END
  || repeat('0.5 ', CAST(floor(l_quantity / 2) AS INTEGER))"""
REPORT_PAGES_SQL = f"""
report_pages AS (
  SELECT l_partkey AS doc_id,
         CAST(row_number() OVER (PARTITION BY l_partkey ORDER BY {', '.join(LINE_ORDER)}) - 1 AS INTEGER) AS page_no,
         {PAGE_TEXT_SQL} AS text
  FROM lineitem)"""


def report_pages(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    order = Window.partitionBy("l_partkey").orderBy(*LINE_ORDER)
    text = F.concat(
        F.when(F.col("l_returnflag") == "R", "Relative trueness per category. ")
        .when(F.col("l_returnflag") == "A", "Sensitivity of the method. ").otherwise("Annex. "),
        F.when(F.col("l_linestatus") == "F", "Bias and standard deviation ").otherwise("Storage "),
        F.when(F.col("l_discount") >= 0.08, "acceptability limit ").otherwise(""),
        F.expr("repeat('0.5 ', cast(floor(l_quantity / 2) as int))"))
    return lines.select(F.col("l_partkey").alias("doc_id"),
                        (F.row_number().over(order) - 1).alias("page_no"), text.alias("text"))


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents")
