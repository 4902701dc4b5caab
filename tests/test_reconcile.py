"""Keys, copies, snapshots, results and requests on small frames."""
import datetime as dt

from pyspark.sql import functions as F

from regloom import schemas
from regloom.operators import canonical, quality, reconcile, results, snapshot
from regloom.operators.requests import guard_question
from regloom.plans import reconcile_queries as rq
from regloom.plans.build import reconcile_registry


def test_resolution_and_quarantine(spark):
    boot = spark.createDataFrame([("A", "Kit One"), ("B", "Kit Two"), ("C", "Kit Two")],
                                 "certificate_number string, commercial_name string")
    pages = spark.createDataFrame([
        ("A", "x", 1), ("A", "x", 3), ("Z", "KIT-ONE", 2), (None, "kit one", 9), (None, "Kit Two", 4),
        ("Y", "Kit Two", 5), (None, None, 6)], "certificate_number string, commercial_name string, n int")
    got = {(r.n, r.resolved_key, r.resolution) for r in reconcile.resolve_keys(pages, boot).collect()}
    assert got == {(1, "A", "exact"), (3, "A", "exact"), (2, "A", "by_name"), (9, "A", "by_name"),
                   (4, None, "unresolved"), (5, "Y", "unmatched"), (6, None, "unresolved")}
    for _ in range(2):
        latest, lost = reconcile.latest_resolved(pages, boot, ["n"])
        assert {(r.certificate_number, r.n) for r in latest.collect()} == {("A", 9), ("Y", 5)}
        assert sorted(r.n for r in lost.collect()) == [4, 6]
        pages = pages.orderBy(F.desc("n"))
    claimed = reconcile.resolve_keys(pages, boot, exclude_claimed=True).filter("n = 9").first()
    assert claimed.resolution == "unresolved"


def test_registry_job_does_not_depend_on_input_order(spark, sf):
    pages, boot = rq.page_records(spark, sf), rq.list_records(spark, sf)
    one = reconcile_registry(pages, boot, "1998-07-01")
    two = reconcile_registry(pages.orderBy(F.rand(1)), boot.orderBy(F.rand(2)), "1998-07-01")
    assert one["records"].exceptAll(two["records"]).count() == 0
    assert one["rejected"].count() == 0


def _record(spark, cert, note, perf):
    rows = spark.createDataFrame([(cert, "Kit", "Valid", "01-01-2030")],
                                 "certificate_number string, commercial_name string, status_raw string, expiry_date_raw string")
    for f in schemas.LIST_ROW.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast("string"))
    rec = canonical.from_list_rows(rows, dt.date(2024, 1, 1))
    kind = schemas.PERFORMANCE
    if perf:
        rec = rec.withColumn("performance", F.struct(
            F.lit("qualitative").alias("method_nature"),
            F.lit(None).cast(kind["quantitative"].dataType).alias("quantitative"),
            F.lit(None).cast(kind["qualitative"].dataType).alias("qualitative")).cast(kind))
    return rec.withColumn("commercial_name", F.lit(note))


def test_carry_forward_keeps_mined_fields_and_is_idempotent(spark):
    old = _record(spark, "X1", "old name", True).unionByName(_record(spark, "X2", "gone", True))
    new = _record(spark, "X1", "new name", False).unionByName(_record(spark, "X3", "fresh", False))
    once = snapshot.preserve_mined_fields(new, old)
    got = {r.id: (r.commercial_name, r.performance is not None) for r in once.collect()}
    assert got == {"microval--x1": ("new name", True), "microval--x2": ("gone", True),
                   "microval--x3": ("fresh", False)}
    twice = snapshot.preserve_mined_fields(new, once)
    assert twice.exceptAll(once).count() == 0 and twice.count() == once.count()


def test_validation_and_notes(spark):
    good, bad = snapshot.split_valid(
        _record(spark, "X1", "a", False).unionByName(_record(spark, "X2", None, False)), snapshot.canonical_checks())
    assert good.count() == 1 and bad.first().reason == "commercial name is missing"
    df = spark.createDataFrame([("a b", "b"), ("a", "b"), (None, "b"), ("a", None)], "n string, x string")
    assert [r[0] for r in df.select(snapshot.append_once(F.col("n"), F.col("x"))).collect()] == [
        "a b", "a b", "b", "a"]


def test_merge_rejects_orphans(spark):
    records = _record(spark, "X1", "a", False)
    perf = _record(spark, "X1", "a", True).select("performance").first().performance
    mined = spark.createDataFrame([("X1", perf, "mined"), ("X9", perf, "mined"), (None, perf, "mined")],
                                  schemas.T.StructType([
                                      schemas.T.StructField("certificate_number", schemas.T.StringType()),
                                      schemas.T.StructField("performance", schemas.PERFORMANCE),
                                      schemas.T.StructField("mining_notes", schemas.T.StringType())]))
    merged, orphans = snapshot.merge_performance(records, mined)
    row = merged.first()
    assert row.performance.method_nature == "qualitative" and row.traceability.notes.endswith(". mined")
    assert sorted(r.reason for r in orphans.collect()) == ["no number on the cover page", "no record with this number"]


def test_results_match_by_identifier(spark):
    records = spark.createDataFrame([("a",), ("b",), ("c",)], "custom_id string")
    res = spark.createDataFrame([("c", "succeeded", 0, True), ("b", "succeeded", 2, False), ("a", "succeeded", 1, True),
                                 ("a", "errored", 1, True), ("z", "succeeded", 1, True)],
                                "custom_id string, kind string, n int, ok boolean")
    got = [r.outcome for r in results.match_results(res, records, F.col("n"), F.col("ok")).orderBy("custom_id", "kind").collect()]
    assert got == ["failed", "written", "invalid", "no_data", "failed"]


def test_calibration_null_logic(spark):
    schema = "doc_id string, category string, row_no int, v double"
    truth = spark.createDataFrame([("d", "Meat", 1, 1.0), ("d", " meat ", 2, 2.0), ("d", "Fish", 3, None),
                                   ("d", "Egg", 4, None), ("d", "Milk", 5, 1.0)], schema)
    other = spark.createDataFrame([("d", "MEAT", 1, 2.05), ("d", "fish", 2, None), ("d", "egg", 3, 0.0)], schema)
    got = {r.category: r.verdict for r in quality.compare(truth, other, ["v"]).collect()}
    assert got == {"meat": "match", "fish": "match", "egg": "mismatch", "milk": "missing"}
    total = quality.agreement(quality.compare(truth, other, ["v"]), ["doc_id"], fields=1).first()
    assert total.total_fields == 3 and total.missing_categories == 1


def test_question_guard(spark):
    df = spark.createDataFrame([(" ",), (None,), ("x" * 500,), ("x" * 501,)], "q string")
    assert [r[0] for r in df.select(guard_question(F.col("q"))).collect()] == ["missing", "missing", None, "too_long"]
