"""Suppliers of a small file are dealt out before their reports are written and mined."""
from regloom.plans import job_queries


def test_reports_of_a_small_file_are_dealt_out(spark, sf):
    records, pages, cells = job_queries._mining_inputs(spark, sf)
    for rows in (records, pages, cells):
        assert "Repartition" in rows._jdf.queryExecution().optimizedPlan().toString()
