"""Whole jobs as queries: landing, sinks, mining to the merged record, re-collection."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from .. import schemas, vocab
from ..operators import canonical, catalogue, sections, snapshot
from ..session import checkpoint_dir
from ..sources import registry as raw
from ..streaming import incremental
from . import build, inputs
from .inputs import ENTRIES_SQL, TODAY, table
from .catalogue_queries import FACET_SQL
from .reconcile_queries import LIST_SQL, list_rows
from .registry import query
from .report_queries import CERTIFICATE_SQL, certificate_texts


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/regloom-{name}-{uuid.uuid4().hex}"


# --- Landing -----------------------------------------------------------------

LANDED = T.StructType([T.StructField("certificate_number", T.StringType()), T.StructField("commercial_name", T.StringType()),
                       T.StructField("size", T.LongType())])


@query("landed_json", """
SELECT CASE WHEN p_partkey % 17 = 0 THEN 'unreadable' WHEN p_type = 'PROMO' THEN 'no commercial_name' ELSE 'ok' END AS reason,
       count(*) AS n, CAST(sum(CASE WHEN p_partkey % 17 <> 0 THEN p_size END) AS BIGINT) AS sizes FROM part GROUP BY 1""")
def landed_json(spark, sf):
    """Records written as JSON, some cut short, then read back with quarantine."""
    record = F.to_json(F.struct(F.concat(F.lit("P"), F.col("p_partkey")).alias("certificate_number"),
                                F.when(F.col("p_type") != "PROMO", F.col("p_name")).alias("commercial_name"),
                                F.col("p_size").alias("size")))
    path = _folder(spark, "landing")
    table(spark, sf, "part").select(F.when(F.col("p_partkey") % 17 == 0, F.substring(record, 1, 20)).otherwise(record)
                                    .alias("value")).write.text(path)
    good, bad = raw.guard(raw.read_json_objects(spark, path, LANDED, single=False), ["certificate_number", "commercial_name"])
    both = good.select(F.lit("ok").alias("reason"), "size").unionByName(bad.select("reason", "size"))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.sum("size").alias("sizes"))


@query("landed_runs", """
SELECT run_id, p_brand AS source, count(*) AS count, count(DISTINCT p_name) AS keys
FROM part CROSS JOIN (SELECT unnest(['first', 'second']) AS run_id) WHERE run_id = 'first' OR p_size > 25 GROUP BY 1, 2""")
def landed_runs(spark, sf):
    """Two collector runs landed in one folder, then indexed from there."""
    path = _folder(spark, "collector")
    part = table(spark, sf, "part").select(F.col("p_brand").alias("source"), F.col("p_name").alias("key"), "p_size")
    raw.land(part, path, "first", ["source"])
    raw.land(part.filter("p_size > 25"), path, "second", ["source"])
    stored = spark.read.parquet(path)
    indexes = [raw.index_of(stored.filter(F.col("run_id") == run), "key").withColumn("run_id", F.lit(run)) for run in ("first", "second")]
    return indexes[0].unionByName(indexes[1])


# --- Sinks -------------------------------------------------------------------

@query("stored_canonical", f"WITH {LIST_SQL} SELECT 'MICROVAL' AS source, id, status, notes FROM recs")
def stored_canonical(spark, sf):
    path = _folder(spark, "canonical")
    raw.write_canonical(canonical.from_list_rows(list_rows(spark, sf), TODAY), path)
    return spark.read.parquet(path).select("source", "id", F.col("certification.status").alias("status"),
                                           F.col("traceability.notes").alias("notes"))


@query("stored_catalogue", f"""WITH {ENTRIES_SQL}, {FACET_SQL}
SELECT 'facet' AS kind, facet AS name, value, n FROM facets
UNION ALL SELECT 'entry', source, status, count(*) FROM entries GROUP BY 2, 3""")
def stored_catalogue(spark, sf):
    path = _folder(spark, "catalogue")
    stored = raw.write_catalogue(inputs.entries(spark, sf), path)
    entries = stored.groupBy(F.lit("entry").alias("kind"), F.col("source").alias("name"), F.col("status").alias("value")).agg(
        F.count("*").alias("n"))
    return spark.read.parquet(f"{path}/facets").select(F.lit("facet").alias("kind"), F.col("facet").alias("name"), "value", "n").unionByName(entries)


# --- Certificates and categories ---------------------------------------------

@query("certificate_canonical", f"""WITH {CERTIFICATE_SQL}
SELECT 'aoac-ri--' || doc_id AS id, 'Kit ' || o_orderpriority AS commercial_name, 'active' AS status, 'Listeria spp.' AS organism,
  CASE st WHEN 'O' THEN 'multi-lab' ELSE 'unknown' END AS study_type, CASE st WHEN 'O' THEN 2 ELSE -1 END AS labs,
  CASE WHEN st = 'F' THEN o_custkey + 5 WHEN st = 'P' THEN o_custkey WHEN n > 0 THEN n ELSE -1 END AS incl_tested,
  '{vocab.NOTE_CERTIFICATE.replace("'", "''")}' AS notes FROM c""")
def certificate_canonical(spark, sf):
    rec = canonical.from_certificates(sections.certificate_records(certificate_texts(spark, sf)), TODAY)
    return rec.select(
        "id", "commercial_name", F.col("certification.status").alias("status"), F.col("target_organism.normalized").alias("organism"),
        F.col("study_design.study_type").alias("study_type"), F.coalesce("study_design.number_of_labs", F.lit(-1)).cast("int").alias("labs"),
        F.coalesce("performance.qualitative.inclusivity.n_tested", F.lit(-1)).cast("bigint").alias("incl_tested"),
        F.col("traceability.notes").alias("notes"))


@query("raw_categories", """
WITH l AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS nq, count(*) FILTER (l_returnflag = 'A') AS nl,
   max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS q, max(CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS l FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND nq > 0 THEN 'quant ' || q WHEN o_orderstatus = 'O' AND nl > 0 THEN 'qual ' || l
   WHEN o_totalprice > 100000 THEN 'milk|meat' ELSE '' END AS categories FROM orders LEFT JOIN l ON o_orderkey = l_orderkey""")
def raw_categories(spark, sf):
    """Mined names by nature first, the matrices only where there are none."""
    def newest(flag: str, word: str):
        key = F.max(F.when(F.col("l_returnflag") == flag, F.col("l_partkey")))
        return F.when(key.isNotNull(), F.array(F.lit(None).cast("string"), F.lit(""), F.concat(F.lit(f"{word} "), key)))

    mined = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(newest("R", "quant").alias("quant"), newest("A", "qual").alias("qual"))
    nature = F.when(F.col("o_orderstatus") == "F", "quantitative").when(F.col("o_orderstatus") == "O", "qualitative")
    matrices = F.when(F.col("o_totalprice") > 100000, F.array(F.lit("milk"), F.lit("meat")))
    return (table(spark, sf, "orders").join(mined, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select("o_orderkey", F.array_join(catalogue.raw_categories(nature, F.col("quant"), F.col("qual"), matrices), "|").alias("categories")))


# --- Canonical checks and re-collection --------------------------------------

@query("rejected_canonical", """
SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'certificate number is missing' WHEN split_part(p_name, ' ', 2) = 'ring' THEN 'commercial name is missing'
   WHEN p_type = 'SMALL' THEN 'action is not known' WHEN p_type = 'LARGE' THEN 'confidence is not known'
   WHEN p_type = 'MEDIUM' THEN 'method nature is not known' END AS reason
FROM part WHERE p_size % 5 = 0 OR split_part(p_name, ' ', 2) = 'ring' OR p_type IN ('SMALL', 'LARGE', 'MEDIUM')""")
def rejected_canonical(spark, sf):
    """Records spoilt in one field each, and what the checks say of them."""
    rec = canonical.from_list_rows(list_rows(spark, sf), TODAY)
    part = table(spark, sf, "part").select(F.concat(F.lit("microval--2020lr"), F.col("p_partkey")).alias("id"), "p_partkey", "p_size",
                                           "p_type", "p_name")
    spoilt = F.from_json(F.lit('{"method_nature": "other"}'), schemas.PERFORMANCE)
    kind = F.col("p_type")
    rows = (rec.join(part, "id")
            .withColumn("source_certificate_number", F.when(F.col("p_size") % 5 != 0, F.col("source_certificate_number")))
            .withColumn("commercial_name", F.when(inputs.noun(F.col("p_name")) != "ring", F.col("commercial_name")))
            .withColumn("method_type", F.when(kind == "SMALL", F.col("method_type").withField("action", F.lit("guess"))).otherwise(F.col("method_type")))
            .withColumn("traceability", F.when(kind == "LARGE", F.col("traceability").withField("extraction_confidence", F.lit("low")))
                        .otherwise(F.col("traceability")))
            .withColumn("performance", F.when(kind == "MEDIUM", spoilt).otherwise(F.col("performance"))))
    return snapshot.split_valid(rows, snapshot.canonical_checks())[1].select("p_partkey", "reason")


def _mined_before(rows):
    """Records as an earlier mining left them."""
    perf = F.from_json(F.lit('{"method_nature": "qualitative"}'), schemas.PERFORMANCE)
    return (rows.withColumn("performance", F.when(F.col("manufacturer.name") < "Brand#3", perf))
            .withColumn("study_design", F.col("study_design").withField("expert_laboratory", F.lit("Old lab")))
            .withColumn("commercial_name", F.lit("old name")))


PRESERVED_SQL = f"""WITH {LIST_SQL}
SELECT r.id, CASE WHEN p_size % 3 = 0 THEN 'old name' ELSE name END AS commercial_name,
   CASE WHEN p_size % 3 = 1 THEN NULL WHEN p_brand < 'Brand#3' THEN 'qualitative' END AS nature,
   CASE WHEN p_size % 3 <> 1 THEN 'Old lab' END AS laboratory
FROM recs r JOIN (SELECT 'microval--2020lr' || p_partkey AS id, p_size, p_brand, {inputs.sql_phrase("split_part(p_name, ' ', 2)", {
    "anvil": "Petrifilm", "bolt": "Compact Dry XY", "gear": "MALDI thing", "gizmo": "real PCR kit", "plate": "ELISA reader", "ring": "plain",
    "rod": "Soleris vial", "widget": "Brilliance agar"})} AS name FROM part) p ON r.id = p.id"""


def _shown(records):
    return records.select("id", "commercial_name", F.col("performance.method_nature").alias("nature"),
                          F.col("study_design.expert_laboratory").alias("laboratory"))


def _collections(spark, sf):
    """Earlier records (all but every third size) and a new collection (all but
    another third)."""
    rec = canonical.from_list_rows(list_rows(spark, sf), TODAY)
    size = table(spark, sf, "part").select(F.concat(F.lit("microval--2020lr"), F.col("p_partkey")).alias("id"), "p_size")
    sized = rec.join(size, "id")
    old = _mined_before(sized.filter("p_size % 3 <> 1").drop("p_size"))
    return old, sized.filter("p_size % 3 <> 0").drop("p_size")


@query("preserved_fields", PRESERVED_SQL)
def preserved_fields(spark, sf):
    old, new = _collections(spark, sf)
    return _shown(snapshot.preserve_mined_fields(new, old))


@query("collected_snapshots", PRESERVED_SQL)
def collected_snapshots(spark, sf):
    """The same through the file stream: two landings, two snapshots."""
    old, new = _collections(spark, sf)
    landing, base, name = _folder(spark, "drops"), _folder(spark, "snapshots"), f"regloom-stream-{uuid.uuid4().hex}"

    def merge(fresh, previous, mined, key):
        return snapshot.preserve_mined_fields(fresh, previous)

    for rows in (old, new):
        rows.write.mode("append").parquet(landing)
        stream = incremental.read_new_files(spark, landing, old.schema, "parquet")
        incremental.upsert_snapshots(stream.drop("file").withColumn("file", F.col("id")), base, "id", ["file"], ["performance"],
                                     name, merge).awaitTermination()
    return _shown(spark.read.parquet(f"{base}/batch=00000001"))


# --- Mining to the end -------------------------------------------------------

def _mining_inputs(spark, sf):
    """A report per supplier: a cover, its prose and a one-row results table.
    Records exist for the certificate numbers of most of them."""
    s = inputs.spread(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    key = F.col("s_suppkey")
    digits = F.lpad(key.cast("string"), 8, "0")
    number = F.concat(F.lit("AB "), F.substring(digits, 1, 2), F.lit("/"), F.substring(digits, 3, 2), F.lit("-"),
                      F.substring(digits, 5, 2), F.lit("/"), F.substring(digits, 7, 2))
    kind = key % 5
    cover = F.concat(F.when(kind != 3, F.concat(F.lit("Certificate number: "), number)).otherwise("No number"), F.lit("\n"),
                     F.when(kind.isin(0, 3), "Quantitative method").when(kind.isin(1, 4), "Qualitative method").otherwise("Some method"))
    prose = F.concat(F.lit("In all "), key + 1, F.lit(" target strains and 5 non-target strains were tested. Same results were observed by"
                     " both methods for "), key, F.lit(" strains. For 1 strain, differences were observed: - Strain A was not found. Exclusivity"))
    pages = s.select(key.alias("doc_id"), F.posexplode(F.array(cover, prose)).alias("page_no", "text"))
    grids = {0: [["Category", "n", "bias", "SD", "95% lower", "95% upper"], ["1", "Meat", "9", "-0,1", "0,2", "-0,3", "0,4"]],
             1: [["Category", "SE alt", "SE ref"], ["1", "Fish", "98,5", "99"]]}

    def cells_of(grid):
        return F.array(*[F.struct(F.lit(r).alias("row_no"), F.lit(c).alias("col_no"), F.lit(v).alias("cell"))
                         for r, row in enumerate(grid) for c, v in enumerate(row)])

    cells = s.select(key.alias("doc_id"), F.explode(F.when(kind.isin(0, 3), cells_of(grids[0])).otherwise(cells_of(grids[1]))).alias("c")).select(
        "doc_id", F.lit(1).alias("page_no"), F.lit(0).alias("table_no"), "c.*")
    none = F.lit(None).cast("string")
    rows = s.filter("s_nationkey < 20").select(
        number.alias("certificate_number"), F.when(key % 10 != 6, F.lit("Kit")).alias("commercial_name"), F.lit("list").alias("label"),
        F.lit("Valid").alias("status_raw"), *[none.alias(f.name) for f in schemas.LIST_ROW.fields
                                             if f.name not in ("certificate_number", "commercial_name", "label", "status_raw")])
    return canonical.from_list_rows(rows, TODAY), pages, cells


MINED_SQL = """
s AS (SELECT s_suppkey, s_nationkey, s_suppkey % 5 AS kind, CASE WHEN s_suppkey % 5 <> 3 THEN 'AB ' || substr(d, 1, 2) || '/' || substr(d, 3, 2) ||
   '-' || substr(d, 5, 2) || '/' || substr(d, 7, 2) END AS number FROM (SELECT *, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS d FROM supplier))"""


@query("mining_outcomes", f"""WITH {MINED_SQL}
SELECT CASE WHEN kind = 2 THEN 'no_nature' WHEN kind = 3 THEN 'no_number' WHEN s_nationkey >= 20 THEN 'no_record'
            WHEN s_suppkey % 10 = 6 THEN 'invalid' ELSE 'merged' END AS outcome, count(*) AS n FROM s GROUP BY 1""")
def mining_outcomes(spark, sf):
    return build.merge_mined(*_mining_inputs(spark, sf))["outcomes"].groupBy("outcome").agg(F.count("*").alias("n"))


@query("mined_records", f"""WITH {MINED_SQL}
SELECT number, CASE WHEN kind = 0 THEN 'quantitative' WHEN kind IN (1, 4) THEN 'qualitative' END AS nature,
   CASE WHEN kind = 0 THEN 'Meat' WHEN kind IN (1, 4) THEN 'Fish' END AS category,
   CASE WHEN kind IN (0, 1, 4) THEN s_suppkey + 1 END AS incl_tested,
   CASE WHEN kind IN (0, 1, 4) THEN 'Mined from report ' || s_suppkey || '.' END AS mined_note
FROM (SELECT * EXCLUDE (number), 'AB ' || substr(d, 1, 2) || '/' || substr(d, 3, 2) || '-' || substr(d, 5, 2) || '/' || substr(d, 7, 2) AS number
      FROM (SELECT *, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS d FROM s)) WHERE s_nationkey < 20 AND s_suppkey % 10 <> 6""")
def mined_records(spark, sf):
    records = build.merge_mined(*_mining_inputs(spark, sf))["records"]
    p = F.col("performance")
    return records.select(
        F.col("source_certificate_number").alias("number"), p["method_nature"].alias("nature"),
        F.coalesce(F.try_element_at(p["quantitative"]["relative_trueness_by_category"], F.lit(1))["category"],
                   F.try_element_at(p["qualitative"]["method_comparison_by_category"], F.lit(1))["category"]).alias("category"),
        F.coalesce(p["quantitative"]["inclusivity"]["n_tested"], p["qualitative"]["inclusivity"]["n_tested"]).cast("bigint").alias("incl_tested"),
        F.nullif(F.regexp_extract(F.col("traceability.notes"), r"(Mined from report \d+\.)", 1), F.lit("")).alias("mined_note"))
