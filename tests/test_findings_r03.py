"""Findings of the third review: what each changed, on small frames."""
import datetime as dt

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from regloom.operators import rule_table, sections, stitch
from regloom.plans import report_queries
from regloom.streaming import arrivals, quota


def against_sql(spark, name, sf, tables):
    """The query's rows and those of its SQL over the same files."""
    got = entry.queries()[name](spark, sf)
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    return sorted(map(repr, (tuple(r) for r in got.collect()))), sorted(map(repr, want))


def test_laboratories_take_the_words_of_their_sql(spark, tmp_path):
    rows = [(1, "Par et ita la mentqueon"), (2, "Par pour au eauvi"), (3, "Les in dome"), (4, "nothing"), (5, "Abc def\nPar et x")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got, want = against_sql(spark, "laboratories_in_text", str(tmp_path), ["documents"])
    assert got == want and "(1, 'Par')" in got and "(3, None)" in got


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cover_metadata_sends_no_pages_through_the_driver(spark, sf):
    text = plan(entry.queries()["cover_metadata"](spark, sf))
    assert "BroadcastHashJoin" not in text and "BroadcastExchange" not in text


def test_report_pages_are_unrolled_by_many_tasks(spark, sf):
    from regloom.plans import report_queries
    pages = report_queries.study_pages(spark, sf)
    assert pages.rdd.getNumPartitions() > 1 and "(size(" not in plan(pages).split("Generate")[1].split("\n")[1]


def test_seams_hold_what_follows_without_running_lists(spark):
    texts = {1: ["a"] * 150, 2: ["b" * 300, "c", "d" * 500, "e"], 3: ["only"], 4: [f"w{i}" for i in range(90)]}
    rows = [(d, p, t) for d, pages in texts.items() for p, t in enumerate(pages)]
    pages = spark.createDataFrame(rows, "doc_id int, page_no int, text string")
    met = stitch.seams(stitch.forms(pages, "doc_id", "page_no", "text"), "doc_id", "page_no")
    got = {(r.doc_id, r.page_no): (r.squeezed, r.squeezed_cut, r.thin) for r in met.collect()}
    want = {}
    for d, ts in texts.items():
        for p, t in enumerate(ts[:-1]):
            tail = t[-stitch.REACH:]
            want[d, p] = tuple(x for gap in " \n" for x in (tail + gap + gap.join(ts[p + 1:])[:stitch.REACH], len(tail)))[:3]
    assert got == want and "collect_list" not in plan(met)


def test_windows_of_values_do_not_shuffle_where_rules_are_few(spark):
    values = spark.createDataFrame([("abcdef",), ("xabc",), ("zz",), (None,), ("\n",)], "value string")
    rules = spark.createDataFrame([(2, "abc", "long"), (1, "f", "short"), (1, "e", "tie"), (1, "e", "also"), (0, "", "never")],
                                  "priority int, needle string, label string")
    found = rule_table.first_rule(values, rules)
    assert {tuple(r) for r in found.collect()} == {("abcdef", "also"), ("xabc", "long")}
    above = plan(found).split("Generate")[0]
    assert "SortMergeJoin" not in above and above.count("Exchange hashpartitioning") == 1


def test_users_of_a_slot_share_a_key_and_keep_their_own_quota(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, i % 5, base + dt.timedelta(hours=(i * 7) % 48)) for i in range(60)]
    end = [(-1, -1, base + dt.timedelta(days=90))]
    drops = [spark.createDataFrame(r, "event_id long, user_id long, ts timestamp") for r in (rows[:30], rows[30:], end)]
    with arrivals.keyed_state(spark):
        got, progress = arrivals.run_to_table(lambda s: quota.quota_by_event_time(s, 2, "day", "3 days", slots=1), drops, "slots")
        taken = {(r.event_id, r.accepted) for r in got.collect() if r.event_id >= 0}
    ranks = {}
    for i, u, t in sorted(rows, key=lambda r: (r[2], r[0])):
        ranks.setdefault((u, t.date()), []).append(i)
    assert taken == {(i, n < 2) for ids in ranks.values() for n, i in enumerate(ids)}


def test_headings_are_branches_of_their_own_and_texts_are_dealt(spark, sf):
    """No pattern is data of a loop, which would compile it for every text; one file of orders is many tasks."""
    docs = spark.createDataFrame([(1, "x AUTHORS\na b\nXAUTHORS c Principle of the method  d\nReference methods and guidelines e"), (2, "none")],
                                 "doc_id int, text string")
    out = sections.sections(docs)
    assert "pattern" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(1, "authors", "a b XAUTHORS c"), (1, "principle", "d"), (1, "reference_method", "e")]
    assert report_queries.certificate_texts(spark, sf).rdd.getNumPartitions() == 4
