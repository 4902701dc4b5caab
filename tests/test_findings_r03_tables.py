"""Rows of results tables are worked out along one order of a block's rows."""
from pyspark.sql import functions as F

from regloom.operators import cells

HEAD = [["Category", "n", "bias", "SD", "95% lower", "95% upper"]]
COMPARED = [["Category", "SE alt", "SE ref"]]
ROWS = "doc_id string, page_no int, table_no int, row_no int, cells array<string>"


def _rows(spark, *tables):
    """Tables as (document, table, {row: cells})."""
    return cells.listed_rows(spark.createDataFrame(
        [(d, 0, t, r, values) for d, t, grid in tables for r, values in grid.items()], ROWS).repartition(3, "doc_id"))


def test_tables_of_several_blocks_are_walked_whole(spark):
    """Names, totals and headers in another block than the rows they belong to, beside tables of one block."""
    metrics = ["-0,1", "0,2", "-0,3", "0,4"]
    name, total = ["1", "Meat"], ["Total", *metrics]
    got = cells.relative_trueness(_rows(
        spark, ("a", 0, {0: HEAD[0], 1: ["1", "Egg", "9", *metrics]}),
        ("b", 0, {0: HEAD[0], 5: name, 9000: ["a", "item", "x"], 20000: total, 20001: total}),
        ("c", 1, {9000: HEAD[0], 9001: name, 9002: total}), ("d", 0, {0: HEAD[0], 1: ["Total", "x"]}),
        ("e", 0, {0: HEAD[0], 9000: ["2", "Fish", "8", *metrics]})))
    assert sorted((r.doc_id, r.row_no, r.category, r.sd_log) for r in got.collect()) == [
        ("a", 1, "Egg", 0.2), ("b", 20000, "Meat", 0.2), ("c", 9002, "Meat", 0.2), ("e", 9000, "Fish", 0.2)]
    got = cells.method_comparison(_rows(
        spark, ("a", 0, {0: COMPARED[0], 1: ["1", "Egg", "98,5", "99"], 2: ["x"], 3: ["Total", "97", "96"], 4: ["2", "Total", "1", "2"]}),
        ("b", 0, {0: COMPARED[0], 5: ["1", "Meat", "90", "91"], 20000: ["Total", "92", "93"]})))
    assert sorted((r.doc_id, r.row_no, r.category, r.sensitivity_alternative_pct) for r in got.collect()) == [
        ("a", 1, "Egg", 97.0), ("b", 5, "Meat", 92.0)]


def test_rows_dealt_by_document_are_read_once_and_not_joined(spark):
    dealt = _rows(spark, ("a", 0, {0: HEAD[0], 1: ["1", "Egg", "9", "1", "2", "3", "4"]}))
    plan = cells.headed_rows(dealt, ["category"], {"_n": F.size("labels")})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_last_number_of_a_text(spark):
    from regloom.functions import values
    texts = ["5", "-0,05", "5.", "D -0,12", "1 2,5", "-", "", "1.2.3", "x", " 7", "12abc", "1-2"]
    both = spark.createDataFrame([(t,) for t in texts], "t string").select(
        values.last_double(F.col("t")).alias("a"), values.to_double(values.last_number(F.col("t"))).alias("b")).collect()
    assert [r.a for r in both] == [r.b for r in both] and both[1].a == -0.05
