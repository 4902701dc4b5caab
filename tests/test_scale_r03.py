"""Steps of round 3 that must not grow faster than their input, on small frames."""
import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from regloom.functions import text
from regloom.operators import web


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def filters(df):
    """The conditions of all filters of a plan."""
    return [part.split("\n   ")[0] for part in re.split(r"[+:]- (?:\*\(\d+\) )?Filter ", plan(df))[1:]]


def test_page_fields_are_read_once_a_block(spark, sf):
    got = entry.queries()["organism_page_records"](spark, sf)
    assert not [f for f in filters(got) if "regexp_replace" in f or "regexp_extract" in f]
    assert plan(got).count("coliformes-totaux") <= 1


def test_blanks_are_those_of_unicode(spark):
    chars = spark.createDataFrame([(i, chr(i)) for i in range(1, 0x3100)], "id int, c string")
    old = r"[\s\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    assert chars.filter(F.col("c").rlike(old) != F.col("c").rlike(text.BLANK)).isEmpty()
    assert [r.id for r in chars.filter(F.col("c").rlike(old) & ~F.col("c").rlike(text.INLINE)).collect()] == [10]


def test_odd_markup_keeps_its_lines_links_and_dates(spark):
    page = ("<p>  a   b<br class=x>\n \r\n<b>c</b> &amp; &lt;d<BR/>  \n<a HREF=/x>one<a href='y'>two &quot;</a><a name=q>no</a>"
            "</p>before mise  à jour\tet publiée le  3  mai 2020 </div>mise à jour et publiée le 4 mai")
    r = spark.createDataFrame([(page, "<p open", "<P>a</p>b", "<p>x</q>")], "h string, o string, c string, n string").select(
        web.line_array(F.col("h")).alias("lines"), web.link_array(F.col("h")).alias("links"), web.last_updated(F.col("h")).alias("date"),
        *[web._inside(F.col(c), "p").alias(c) for c in "ocn"], web.last_updated(F.lit("<p>none</p>")).alias("none")).first()
    assert r.lines[:2] == ["a b", "c & <d"]
    assert [tuple(x) for x in r.links] == [("/x", "one"), ("y", "two \"")]
    assert (r.date, r.o, r.c, r.n, r.none) == ("3 mai 2020", "", "a", "x</q>", None)


def test_ranges_of_dates_meet_days_not_entries(spark):
    """Many ranges over few conditions: each condition meets the entries once."""
    import datetime as dt
    from regloom.operators import requests
    base = dt.date(2020, 1, 1)
    rows = [(f"e{i}", "S" + str(i % 2), "active" if i % 3 else "expired", "tech", "org", f"m{i * 7 % 23:02d}" if i % 11 else None, "lab",
             f"kit {i % 5}", "label", f"c{i}", "", base + dt.timedelta(days=i * 13 % 400) if i % 7 else None, i % 4 == 0) for i in range(300)]
    entries = spark.createDataFrame(rows, "id string, source string, status string, method_category string, organism string, manufacturer_name string, "
                                    "expert_laboratory string, commercial_name string, method_category_label string, source_certificate_number string, "
                                    "reference_method string, current_expiry date, has_performance_data boolean")
    asked = []
    for n in range(120):
        lo = str(base + dt.timedelta(days=n * 3)) if n % 3 else ""
        hi = str(base + dt.timedelta(days=n * 3 + n % 97)) if n % 4 else ("2020-02-31" if n == 8 else "")
        asked.append((f"r{n}", ["S1"] if n % 5 == 0 else [], lo, hi, ["", "", "kit 3", "2"][n % 4]))
    none = F.array().cast("array<string>")
    reqs = spark.createDataFrame(asked, "request_id string, sources array<string>, expires_after string, expires_before string, text string").select(
        "*", *[none.alias(c) for c in ("statuses", "technologies", "organisms", "manufacturers", "expert_laboratories")], F.lit(True).alias("understood"))
    today = dt.date(2020, 6, 1)
    got = {r.request_id: tuple(r)[1:] for r in requests.answer(reqs, entries, str(today)).collect()}
    for rid, sources, lo, hi, words in asked:
        hit = [r for r in rows if (not sources or r[1] in sources) and (words == "" or words in " ".join(x.lower() for x in (r[7], r[5], r[4], r[8], r[6], r[9]) if x))
               and hi != "2020-02-31" and ((not lo and not hi) or (r[11] and (not lo or str(r[11]) >= lo) and (not hi or str(r[11]) < hi)))]
        names = sorted({r[5] for r in hit if r[5]})
        soon = sum(1 for r in hit if r[11] and 0 <= (r[11] - today).days / 30.44 < 12)
        assert got[rid] == (len(hit), len(names), soon, sum(r[2] == "expired" for r in hit), sum(r[12] for r in hit), ", ".join(names[:3])), rid
    filters = requests.conditions_of(requests.distinct_filters(reqs)[0])
    days = requests.count_conditions(filters, entries, str(today))
    assert days.agg(F.sum("_n")).first()[0] <= filters.select("condition_id").distinct().count() * len(rows)


def test_rows_of_small_files_are_dealt_before_costly_expressions(spark, sf):
    for name, key in (("text_keys", "doc_id"), ("detail_fields", "c_custkey"), ("printed_values", "l_orderkey")):
        text = plan(entry.queries()[name](spark, sf))
        assert f"Exchange hashpartitioning({key}" in text and "REPARTITION_BY_NUM" in text, name
        assert "regexp" not in text.split("REPARTITION_BY_NUM")[1], name
