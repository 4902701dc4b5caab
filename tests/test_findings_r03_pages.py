"""Scores of pages, and ranges from one reading of the selection."""
from pyspark.sql import functions as F

from regloom import vocab
from regloom.operators import pages

TEXTS = ["ECART-TYPE", "ecart type", "Ecart", "the bias.", "BIAIS", "debiased", "lod 5", "rlod", "melodic", "Profil d'Exactitude", "profil d’exactitude",
         "limite d'acceptabilité", "COMPARAISON DES MÉTHODES", "comparaison des methodes", "comparaison des", "biaſ", "löd LOD", "", None,
         "Relative trueness 0.5 0.5 0,5 -0.5 .5 5. 1.5 and bias"]


def test_words_a_match_needs_change_no_score(spark):
    df = spark.createDataFrame([(0, i, t) for i, t in enumerate(TEXTS)], "doc_id int, page_no int, text string")
    whole = sum((F.coalesce(F.col("text").rlike("(?iU)" + s), F.lit(False)).cast("int") for s in vocab.PAGE_SIGNALS), F.lit(0))
    bonus = F.least(F.floor(F.coalesce(F.regexp_count("text", F.lit(vocab.PAGE_NUMBER)), F.lit(0)) / 5), F.lit(6))
    want = df.select("page_no", F.when(whole == 0, 0).otherwise(whole * 2 + bonus).cast("int").alias("score"))
    got = {r.page_no: r.score for r in pages.score_pages(df).collect()}
    assert got == {r.page_no: r.score for r in want.collect()} and max(got.values()) == 5
    assert [pages._needed(b) for b in (r"\bRLOD\b", r"ecart[- ]type", "profil d.exactitude", "a?b", r"\d+ x", "a(b)")] == [
        "rlod", "ecart", "exactitude", "", "", ""]


def test_signals_are_sought_behind_a_word(spark):
    df = spark.createDataFrame([(0, 0, "x")], "doc_id int, page_no int, text string")
    plan = pages.score_pages(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lower(") == 1 and "Contains" in plan or "contains" in plan.lower()


def test_ranges_read_the_selection_once(spark):
    picked = spark.createDataFrame([("d", p) for p in (0, 3, 4, 5, 9)] + [("e", 0)], "doc_id string, page_no int")
    got = pages.format_pages(picked)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r.doc_id: r.pages for r in got.collect()} == {"d": "1, 4-6, 10", "e": "1"}
