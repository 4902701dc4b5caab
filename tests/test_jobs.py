"""Whole jobs end to end on small inputs."""
import random
import re
import uuid
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from regloom import schemas, vocab
from regloom.operators import canonical, catalogue, report, sections
from regloom.plans import build
from regloom.session import checkpoint_dir
from regloom.sources import registry as raw

PROSE = ("In all 10 target strains and 5 non-target strains were tested. Same results were observed by both methods "
         "for 9 strains. For 1 strain, differences were observed: - Strain A was not found. Exclusivity Among the 5 "
         "non-target strains tested, 5 strains were not enumerated with the new method. ")
LINES = "SD Repeatability 0,1 0.2 +/- 0.5\nSD Repeatability 0,3 0.4 +/- 0.5\n"


def report_inputs(spark):
    pages = spark.createDataFrame([
        ("q", 0, "Certificate number: AB 01 / 02 – 03/04\nQuantitative method"), ("q", 1, PROSE),
        ("q", 2, "Acceptability Limit is fixed at ± 0,5 Log\n" + LINES),
        ("l", 0, "AB 05/06-07/08 Qualitative method"), ("n", 0, "nothing here")],
        "doc_id string, page_no int, text string")
    head = ["Category", "n", "bias", "SD", "95% lower", "95% upper"]
    grids = {"q": [head, ["1", "Meat", "9", "-0,1", "0,2", "-0,3", "0,4"], ["2", "Milk", "8", "0,1", "0,2", "-0,3", "0,4"],
                   ["All categories", "17", "0", "0", "0", "0"]],
             "l": [["Category", "SE alt", "SE ref"], ["1", "Fish", "98,5", "99"]]}
    cells = spark.createDataFrame(
        [(d, 1, 0, r, c, v) for d, grid in grids.items() for r, row in enumerate(grid) for c, v in enumerate(row)],
        "doc_id string, page_no int, table_no int, row_no int, col_no int, cell string")
    return pages, cells


@pytest.mark.parametrize("breaks", [0, 1, 2, 7])
def test_mining_reports(spark, breaks):
    pages, cells = report_inputs(spark)
    if breaks:  # the same text on many short pages that break inside sentences
        whole = defaultdict(list)
        for r in pages.orderBy("page_no").collect():
            whole[r.doc_id] += re.split(r"(?<=\s)(?<!Acceptability\s)(?<!Limit\s)(?<!is\s)(?<!fixed\s)(?<!SD\s)(?=\S)", r.text + "\n")
        pages = spark.createDataFrame(
            [(d, i, re.sub(r"\s$", "", "".join(words[i:i + breaks])) if i % 3 else "".join(words[i:i + breaks]))
             for d, words in whole.items() for i in range(0, len(words), breaks)], "doc_id string, page_no int, text string")
    mined = {r.doc_id: r for r in build.mine_reports(pages, cells).collect()}
    assert set(mined) == {"q", "l"}
    q = mined["q"].performance.quantitative
    assert mined["q"].certificate_number == "AB 01/02-03/04"
    assert [(r.category, r.bias_log, r.n_samples) for r in q.relative_trueness_by_category] == [
        ("Meat", -0.1, 9), ("Milk", 0.1, 8)]
    assert q.accuracy_profile.acceptability_limit_log == 0.5
    assert [(m.matrix, m.sd_repeatability_reference) for m in q.accuracy_profile.by_matrix] == [
        ("Meat", 0.1), ("Milk", 0.3)]
    assert (q.inclusivity.n_tested, q.inclusivity.n_correctly_detected) == (10, 9)
    assert q.inclusivity.discrepancies[0].strain == "Strain A"
    assert (q.exclusivity.n_tested, q.exclusivity.n_correctly_detected) == (5, 5)
    rows = mined["l"].performance.qualitative.method_comparison_by_category
    assert [(r.category, r.sensitivity_alternative_pct) for r in rows] == [("Fish", 98.5)]


def test_sentences_across_pages_equal_the_whole_text(spark):
    """Random page breaks, also inside words; the whole text is searched in Python."""
    rng = random.Random(8)
    text = ("x12 target strains and 5 non-target strains were tested. Among the 9 strains Same results\u00a0were observed by both "
            "methods for 31 strains. For 2 strains, differences were observed: - One was odd - Two  Exclusivity \n" + LINES +
            "3 additional target strains and 4 additional non-target strains were tested. Acceptability Limit is fixed at\n 0.7 Log. "
            "Among the 7 non -target strains tested, 6 strains were not enum erated with the method by any method. "
            "strains were enumerated by both methods: Proteus x and Hafnia y. SD Repeatability 1 2 +/- 3\n\n")
    docs = {}
    for d in range(40):
        cuts = sorted(rng.sample(range(len(text) * 2), rng.randint(0, 60)))
        whole = text * 2
        docs[d] = [whole[a:b] for a, b in zip([0, *cuts], [*cuts, len(whole)])]
    pages = spark.createDataFrame([(d, 3 * i, p) for d, ps in docs.items() for i, p in enumerate(ps)],
                                  "doc_id int, page_no int, text string").repartition(4)
    told = {r.doc_id: r for r in report.prose(pages).collect()}
    lines = defaultdict(list)
    for r in report.repeatability_lines(pages).orderBy("pos").collect():
        lines[r.doc_id].append((r.pos, r.n_lines, r.sd_repeatability_reference))
    plain = {k: re.sub(r"^\(\?[a-zA-Z]+\)", "", getattr(vocab, k)) for k in (
        "TESTED_SENTENCE", "SAME_SENTENCE", "NON_TARGET_SENTENCE", "BOTH_METHODS_SENTENCE", "LIMIT_SENTENCE", "REPEATABILITY_LINE")}
    for d, ps in docs.items():
        full = "\n".join(ps)
        norm = re.sub(r"\s+", " ", full)
        tested = sum(int(a) for a, _ in re.findall(plain["TESTED_SENTENCE"], norm))
        same, among = re.search(plain["SAME_SENTENCE"], norm), re.search(plain["NON_TARGET_SENTENCE"], norm)
        limit, named = re.search(plain["LIMIT_SENTENCE"], full), re.search(plain["BOTH_METHODS_SENTENCE"], norm)
        got = told[d]
        assert got.limit == (float(limit[1].rstrip(".")) if limit else None)
        assert (got.inclusivity is None) == (not same or not tested)
        if got.inclusivity:
            assert (got.inclusivity.n_tested, got.inclusivity.n_correctly_detected) == (tested, int(same[1]))
            assert len(got.inclusivity.discrepancies) == len([x for x in re.split(r"\s-\s", same[3]) if x.strip(" -.")])
        assert (got.exclusivity is None) == (among is None)
        if among:
            assert (got.exclusivity.n_tested, got.exclusivity.n_correctly_detected) == (int(among[1]), int(among[2]))
            assert len(got.exclusivity.discrepancies) == (len([s for s in re.split(
                r",(?! [A-Z][a-z]+ \d)|\band\b", named[1]) if s.strip()]) if named else 0)
        want = re.findall(plain["REPEATABILITY_LINE"], full)
        assert [(p, n) for p, n, _ in lines[d]] == [(i + 1, len(want)) for i in range(len(want))]


@pytest.mark.parametrize("closing", [None, 0, 2000])
def test_pages_behind_the_last_closing_are_not_put_together(spark, monkeypatch, closing):
    """A long document whose sentences find no end, one on their page, or one far behind."""
    pages = [f"Page {i}" for i in range(3000)]
    pages[5] = ("Among the 9 non-target strains tested, 6 strains were not enumerated with the " + "usual method" * (closing == 0)
                + " strains were enumerated by both methods: Proteus x and Hafnia y" + "." * (closing == 0))
    if closing:
        pages[closing] = "one method. And more"
    frame = spark.createDataFrame([(1, i, p) for i, p in enumerate(pages)], "doc_id int, page_no int, text string").repartition(4)
    spans, whole = [], report.stitch.assembled
    monkeypatch.setattr(report.stitch, "assembled", lambda p, ranges, *rest: (spans.append(ranges), whole(p, ranges, *rest))[1])
    got = report.prose(frame).first()
    last = closing or 5
    assert {(r.kind, r.first, r.last) for r in spans[0].collect()} == {("among", 5, last), ("named", 5, last)}
    assert got.inclusivity is None
    # "both methods" ends the first sentence in any case; the second has no end in the first case.
    assert (got.exclusivity.n_tested, got.exclusivity.n_correctly_detected) == (9, 6)
    assert [d.strain for d in got.exclusivity.discrepancies][:1] == ([] if closing is None else ["Proteus x"])
    assert len(got.exclusivity.discrepancies) == (0 if closing is None else 2)


def test_merging_counts_every_report(spark):
    pages, cells = report_inputs(spark)
    more = spark.createDataFrame([("r", 0, "Certificate number: AB 01/02-03/04 Qualitative method"), ("s", 0, "Qualitative method")],
                                 "doc_id string, page_no int, text string")
    rows = spark.createDataFrame([("AB 01/02-03/04", "Kit", "m", "Salmonella", "milk", "Valid")],
                                 "certificate_number string, commercial_name string, manufacturer_raw string, analyte_raw string, "
                                 "matrices_raw string, status_raw string")
    for f in schemas.LIST_ROW.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast("string"))
    out = build.merge_mined(canonical.from_list_rows(rows, "2024-01-01"), pages.unionByName(more), cells)
    assert {r.doc_id: r.outcome for r in out["outcomes"].collect()} == {
        "q": "superseded", "l": "no_record", "n": "no_nature", "r": "merged", "s": "no_number"}
    record = out["records"].first()
    assert record.performance.method_nature == "qualitative" and record.traceability.notes.endswith("Mined from report r.")


def test_pages_to_send_and_evidence(spark):
    pages, _ = report_inputs(spark)
    sent = build.pages_to_send(pages, budget=2)
    assert {(r.doc_id, r.page_no) for r in sent.collect()} == {("q", 0), ("l", 0), ("n", 0)}
    labs, evidence = build.read_evidence(pages)
    assert labs.count() == 3 and evidence.count() == 3


def test_certificate_to_canonical(spark):
    text = ("Certificate No. 77\nhereby certifies the method known as Kit\nmanufactured by\nMaker\nStreet\n"
            "This method has been evaluated\nExpiration Date December 31, 2030\nINDEPENDENT LABORATORY\nLab\n"
            "DISCUSSION OF THE VALIDATION STUDY Of the 50 inclusivity strains tested, all 50 were correctly detected.\n"
            "PRINCIPLE OF THE METHOD qPCR\nTable 1. Inclusivity\n1 Strain\n  one -c\n2 Strain two +\n3 gap\n 4  Strain  three -c\nTable 2. Other\n")
    docs = spark.createDataFrame([("d", text), ("e", "Certificate No. 78\n no data")], "doc_id string, text string")
    rec = canonical.from_certificates(sections.certificate_records(docs), "2024-01-01")
    got = {r.id: r for r in rec.collect()}
    one, two = got["aoac-ri--77"], got["aoac-ri--78"]
    panel = one.performance.qualitative.inclusivity
    assert (panel.n_tested, panel.n_correctly_detected) == (50, 50)
    assert [d.strain for d in panel.discrepancies] == ["Strain three"]
    assert one.study_design.study_type == "multi-lab" and one.study_design.number_of_labs == 2
    assert one.method_type.category == "molecular_pcr" and one.certification.status == "active"
    assert two.performance is None and two.commercial_name == "UNKNOWN"


def test_catalogue_sink_and_reports(spark):
    rows = spark.createDataFrame([
        ("A1", "Petrifilm X", "3M / Neogen", "Salmonella", "Cheese, nonsense", "Valid"),
        ("A2", "Odd thing", "BIO-RAD", "Yeasts and molds", None, "Withdrawn")],
        "certificate_number string, commercial_name string, manufacturer_raw string, analyte_raw string, "
        "matrices_raw string, status_raw string")
    for f in schemas.LIST_ROW.fields:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast("string"))
    records = canonical.from_list_rows(rows, "2024-01-01")
    out = build.build_catalogue(records.unionByName(records.limit(1).withColumn("source", F.lit("AOAC-RI"))))
    base = f"{checkpoint_dir(spark)}/cat-{uuid.uuid4().hex}"
    stored = raw.write_catalogue(out["entries"], base)
    got = {r.source_certificate_number: r for r in stored.collect()}
    assert got["A1"].manufacturer_name == "Neogen" and got["A2"].organism == "Yeasts and moulds"
    assert got["A1"].tested_categories == ["Raw milk and dairy products"]
    assert got["A1"].links.summary_report_url == "https://microval.org/certified-methods/"
    assert {r.raw for r in out["unknown_categories"].collect()} == {"nonsense"}
    assert [r.commercial_name for r in out["unknown_technology"].collect()] == ["Odd thing"]
    assert out["skipped"].first().skipped == 1
    assert spark.read.parquet(f"{base}/facets").filter("facet = 'manufacturers'").count() == 2
    assert out["heatmap"].count() == 2 * 19
    raw.write_canonical(records, f"{base}/canonical")
    assert spark.read.parquet(f"{base}/canonical").count() == 2
    assert catalogue.coverage(out["entries"].limit(0)).first().pct == 0
