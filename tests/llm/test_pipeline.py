"""The pipeline's stages, each on what the one before kept."""
from collections import Counter

import corpus_pipeline
from regloom.llm.staging import materialize
from test_operators import WORD, all_ids, brute_components, brute_targets


def test_stages(spark, sf, documents):
    docs, sizes, kept = documents, [], {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "test")
        kept[name] = docs
        sizes.append(docs.count())
        if name != "packing":
            assert docs.columns == documents.columns
    n = documents.count()
    assert n > sizes[0] >= sizes[1] > sizes[2] > 0
    ids = [r["doc_id"] for r in kept["near_dedup"].select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    mixed = kept["mixing"].groupBy("doc_id").count().collect()
    assert {r["doc_id"] for r in mixed} <= set(ids) and max(r["count"] for r in mixed) == 2
    assert {r["doc_id"] for r in kept["packing"].select("doc_id").distinct().collect()} == {r["doc_id"] for r in mixed}


def test_stages_on_odd_rows(spark, sf, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "test")
    assert docs.count() > 0


def test_rows_of_the_last_stages(spark, sf, documents):
    """Near-dedup, mixing and packing, each against plain Python on its own input."""
    docs, rows = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), "test")
        rows[name] = docs.collect()
    judged, kept, mixed = rows["quality_classifier"], rows["near_dedup"], rows["mixing"]
    groups = brute_components([(r["doc_id"], r["text"]) for r in judged])
    assert Counter(kept) == Counter(r for r in judged if groups[r["doc_id"]][1] == r["doc_id"])
    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in kept}
    sizes, taken = Counter(), Counter()
    for r in kept:
        sizes[r["source"]] += size[r["doc_id"]]
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    assert set(mixed) <= set(kept)
    for s, aim in brute_targets(sizes).items():
        assert abs(taken[s] - aim) <= max(size[r["doc_id"]] for r in kept if r["source"] == s)
    want, got = Counter(), Counter()
    for (i, ids), n in zip(all_ids([(r["doc_id"], r["text"]) for r in kept]), (mixed.count(r) for r in kept)):
        want[i] = n * len(ids)
    for r in rows["packing"]:
        got[r["doc_id"]] += r["length"]
    assert got == +want
