"""Page choice against brute force, and evidence across pages."""
import random

from pyspark.sql import functions as F

from regloom.operators import evidence, pages


def brute_force(scores, budget):
    """The stated rule, one page at a time."""
    n = len(scores)
    ranked = sorted(((s, i) for i, s in enumerate(scores) if s > 0), reverse=True)
    if n <= budget or not ranked:
        return set(range(n))
    keep = {0}
    for _, i in ranked:
        if len(keep | {i, i + 1}) <= budget:
            keep |= {i} | ({i + 1} if i + 1 < n else set())
    return keep


def test_selection_equals_brute_force(spark):
    rng = random.Random(5)
    docs = {}
    for d in range(120):
        n = rng.choice([1, 3, 9, 14, 15, 40, 120, 200])
        share = rng.choice([0.0, 0.05, 0.4, 1.0])
        docs[d] = [rng.choice([2, 4, 5, 8]) if rng.random() < share else 0 for _ in range(n)]
    rows = [(d, p, s) for d, scores in docs.items() for p, s in enumerate(scores)]
    rng.shuffle(rows)
    scored = spark.createDataFrame(rows, "doc_id int, page_no int, score int").repartition(5)
    for budget in (4, 5, 14):
        got = {}
        for r in pages.select_pages(scored, budget).collect():
            assert r.page_no not in got.setdefault(r.doc_id, set())
            got[r.doc_id].add(r.page_no)
        assert got == {d: brute_force(s, budget) for d, s in docs.items()}


def test_scores_and_ranges(spark):
    table = "Relative trueness. Bias and standard deviation. " + "0.12 " * 12
    rows = [(1, 0, "cover"), (1, 1, "Sensitivity was assessed"), (1, 2, table), (1, 3, ""), (1, 4, None)]
    df = spark.createDataFrame(rows, "doc_id int, page_no int, text string")
    got = {r.page_no: r.score for r in pages.score_pages(df).collect()}
    assert got == {0: 0, 1: 2, 2: 6, 3: 0, 4: 0}
    chosen = spark.createDataFrame([(1, p) for p in (0, 43, 44, 45, 59)] + [(2, 5)], "doc_id int, page_no int")
    assert {r.doc_id: r.pages for r in pages.format_pages(chosen).collect()} == {1: "1, 44-46, 60", 2: "6"}


def test_keywords_count_once_across_pages(spark):
    rows = [("a", 0, "a thermocycler"), ("a", 1, "with a primer"), ("b", 0, "thermocycler thermocycler"),
            ("c", 0, "growth inhibition by a ph indicator, primer, amplified"), ("d", 0, None)]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, text string")
    got = {r.doc_id: r.evidence for r in evidence.text_technology(df).collect()}
    assert got == {"a": "molecular_pcr", "b": None, "c": "inhibition_assay", "d": None}


def test_expert_lab_from_pages(spark):
    rows = [("a", 0, "study performed by Unknown House in Paris"), ("a", 3, "footer Microsept v0"),
            ("b", 0, "Expert laboratory: for. The study was carried out by Nofima AS in Norway."),
            ("c", 0, "nothing"), ("d", 0, "Expert laboratory: W. Jansen-Smit")]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, text string")
    got = {r.doc_id: r.expert_laboratory for r in evidence.find_expert_lab(df).collect()}
    assert got == {"a": "Microsept", "b": "Nofima AS", "c": None, "d": None}


def test_evidence_lines_kinds(spark):
    rows = [("a", 1, "x\n PCR  here \n"), ("a", 0, "first\nagar"), ("b", 0, "one\n\ntwo"), ("c", 0, "  "),
            ("d", 0, "\n".join(["broth"] * 40))]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, text string")
    got = {}
    for r in evidence.evidence_lines(df).orderBy("rank").collect():
        got.setdefault((r.doc_id, r.kind), []).append(r.line)
    assert got[("a", "hint")] == ["agar", "PCR  here"]
    assert got[("b", "opening")] == ["one", "two"]
    assert got[("c", "no_text")] == [None]
    assert len(got[("d", "hint")]) == 25


def test_unions_do_not_lean_on_the_session(spark):
    """Results are whole in a session that zips unions of equal partitioning."""
    scored = spark.createDataFrame([(d, p, (d * p) % 5) for d in range(30) for p in range(3 + 4 * (d % 7))], "doc_id int, page_no int, score int")
    texts = spark.createDataFrame([(d, p, f"line {d}\nby laboratory {p}" if d % 3 else "") for d in range(20) for p in range(4)],
                                  "doc_id int, page_no int, text string")

    def both():
        return (sorted(map(tuple, pages.select_pages(scored, 6).collect())), sorted(map(str, evidence.evidence_lines(texts).collect())))

    want = both()
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    assert both() == want and spark.conf.get("spark.sql.unionOutputPartitioning") == "false"
