from pyspark.sql import functions as F

from regloom.functions import text, values
from regloom.operators import reconcile, report, sections, stitch, web

WORDS = ("Certificate number : AB 01 / 02 – 03/44 Quantitative  method of 10 target strains and 5 non-target strains were tested, "
         "SD_Repeatability 0,1 0.2 +/- 0.5 end").split(" ")
WORDS = [w.replace("_", " ") for w in WORDS]


def test_pages_of_a_few_words_are_searched_as_one(spark):
    """a page of a word cost a seam in each form."""
    rows = [(1, i, w) for i, w in enumerate(WORDS)] + [(2, 0, None), (2, 1, " \n"), (3, 0, "x" * 5000), (3, 1, "y"), (3, 2, "z" * 9000), (3, 3, "e")]
    pages = spark.createDataFrame(rows, "doc_id int, page_no int, text string").repartition(3)
    got = {(r.doc_id, r.page_no): r.text for r in stitch.merged(pages).collect()}
    assert got == {(1, 0): "\n".join(WORDS), (2, 0): "\n \n", (3, 0): "x" * 5000, (3, 1): "y\n" + "z" * 9000, (3, 3): "e"}
    cover = {r.doc_id: (r.certificate_number, r.method_nature) for r in report.cover_metadata(pages).collect()}
    assert cover == {1: ("AB 01/02-03/44", "quantitative"), 2: (None, None), 3: (None, None)}
    assert [(r.pos, r.n_lines) for r in report.repeatability_lines(pages).collect()] == [(1, 1)]
    plan = report.repeatability_lines(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan


def test_lone_blanks_are_no_matches_of_squeezing(spark):
    cases = ["a b", " a  b ", "a\tb", "a \tb", "a b  c", "\n", "", None, "a\r\nb \n c"]
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    got = [(r[0], r[1]) for r in df.select(text.squeeze(F.col("c")), stitch.thin(F.col("c"))).collect()]
    assert got == [("a b", "a b"), ("a b", "a\nb"), ("a b", "a\nb"), ("a b", "a\nb"), ("a b c", "a\nb\nc"), ("", ""), ("", ""), (None, None), ("a b c", "a\nb\nc")]


def test_a_heading_is_judged_once_a_section_and_lines_are_read_from_text(spark):
    """each block looked its heading up again, in lower case for every label."""
    html = ("<h2>Méthodes moléculaires</h2><p>Kit<br>Titulaire : A : b<br><br>SOCIÉTÉ: Last<br>Détection (selon ISO 1)<br>dénombrement"
            "<a href=\"/c.pdf\">ATTESTATION</a><a href='/r?a=1&amp;b'>Rapport d'une synthèse</a><a href=/s.pdf>Synthèse certificat</a></p>"
            "<p>titulaire: first line</p><p>Menu</p><P>Other<a href=\"/open>rapport</a></P>")
    pages = spark.createDataFrame([(1, "https://a.org/x/", html)], "page_id int, url string, html string")
    out = web.organism_page_records(pages)
    got = [(r.commercial_name, r.manufacturer.name, r.method_type.category, r.reference_method.raw, r.reference_method.standard,
            r.traceability.certificate_pdf_url, r.traceability.summary_report_pdf_url) for r in out.collect()]
    assert got == [("Kit", "Last", "molecular_pcr", "Détection (selon ISO 1)", "ISO 1", "/s.pdf", "/r?a=1&b")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(trim(") == 1


def test_latest_rows_carry_what_is_read_and_settle_by_pairs(spark):
    """whole rows were sorted and shuffled as structs, and again for each join that settles their keys."""
    pages = spark.createDataFrame([("A 1", "Kit", "f1", "u"), ("A 1", "Kit", "f2", "v"), ("B 2", "Two", "f1", "w"), (None, "Two", "f3", "x"), (None, "?", "f4", "y"),
                                   ("Z 9", "Kit", "f5", "z"), ("Z 9", "Else", "f6", "q")], "certificate_number string, commercial_name string, file string, wide string")
    boot = spark.createDataFrame([("A 1", "Other"), ("C 3", "two"), ("D 4", "kit")], "certificate_number string, commercial_name string")
    latest, lost = reconcile.latest_resolved(pages, boot, ["file"])
    assert {tuple(r) for r in latest.collect()} == {("A 1", "Kit", "f2", "v"), ("C 3", "Two", "f3", "x"), ("D 4", "Kit", "f5", "z"), ("Z 9", "Else", "f6", "q")}
    assert [r.file for r in lost.collect()] == ["f4"]
    plan = latest.select("certificate_number", "file")._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and plan.count("wide") <= plan.count("LogicalRDD") + plan.count("LocalRelation")


def test_headings_are_searched_once_in_any_case(spark):
    """every heading was searched twice, and case was folded at each character."""
    cases = ["x Authors\nA\nREFERENCE METHOD b table 2.  METHOD SELECTIVITY c", "ſubmitting company A AUTHORSX authors. B", "PRİNCIPLE OF THE METHOD z", "none", None]
    df = spark.createDataFrame(list(enumerate(cases)), "doc_id int, text string")
    got = {(r.doc_id, r.section): r.text for r in sections.sections(df).collect()}
    assert got == {(0, "authors"): "A", (0, "reference_method"): "b", (0, "method_selectivity_table"): "c",
                   (1, "submitting_company"): "A AUTHORSX", (1, "authors"): ". B"}
    plan = sections.sections(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") < plan.count("regexp_instr(")
    dates = df.limit(1).select(values.english_date(F.lit("on Feb 1, 2020 May 3, 2021")).alias("n"), values.english_date(F.lit("May 3, 2021")).alias("e"),
                               values.french_date(F.lit("le 1er août 2020")).alias("f")).first()
    assert (dates.n, str(dates.e), str(dates.f)) == (None, "2021-05-03", "2020-08-01")
