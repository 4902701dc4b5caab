"""Each operator against a brute-force version, and on odd rows."""
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from regloom.llm import (bfd_packing, html_text, mixing, near_dup, projected_nn, quality_rules, ss_packing, staging,
                         token_counts, tokens, warc_zip, weak_classifier)
from regloom.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(frame):
    return sorted(map(str, frame.collect()))


# --- quality rules -----------------------------------------------------------

def test_mcd_rejects_junk_and_keeps_clean(spark, documents, sf):
    got = quality_rules.judge(documents).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    judged = got[~got.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.98
    assert judged[judged.quality == 0].kept.mean() < 0.08


def test_concentration_finds_the_majority(spark):
    rng = np.random.default_rng(1)
    good = rng.normal([1, 0.1, 0.2, 0.1], [0.3, 0.2, 0.3, 0.2], (600, 4))
    bad = rng.normal([4, 1, 1, 1], 0.05, (250, 4))
    frame = spark.createDataFrame([("g", [float(v) for v in x]) for x in np.concatenate((good, bad))],
                                  "grp string, x array<double>")
    found = quality_rules.estimate(frame).first()
    assert np.abs(np.array(found["center"]) - good.mean(0)).max() < 0.12
    inverse = np.zeros((4, 4))
    for (i, j), v in zip(quality_rules.PAIRS, found["inverse"]):
        inverse[i, j] = inverse[j, i] = v

    def distance(x):
        d = x - np.array(found["center"])
        return np.einsum("ni,ij,nj->n", d, inverse, d) / found["scale"]

    assert (distance(bad) > quality_rules.LIMIT).all() and (distance(good) < quality_rules.LIMIT).mean() > 0.98


def test_least_determinant_equals_many_random_starts(spark):
    """Three groups of other shapes against concentration from 300 random subsets."""
    rng = np.random.default_rng(12)
    mixed = rng.normal(size=(4, 4)) * 0.3
    groups = {
        "junk": np.concatenate((rng.normal(0, 0.3, (300, 4)), rng.normal(2, 0.1, (140, 4)))),
        "tilted": np.concatenate((rng.normal(size=(400, 4)) @ mixed, rng.normal(3, 0.5, (120, 4)))),
        "heavy": rng.standard_t(2, (400, 4)) * [0.1, 0.2, 0.3, 0.4]}
    frame = spark.createDataFrame([(g, [float(v) for v in x]) for g, xs in groups.items() for x in xs], "grp string, x array<double>")
    found = {r.grp: r for r in quality_rules.estimate(frame, steps=8).collect()}
    floor = np.diag(np.square(quality_rules.FLOORS))
    for name, x in groups.items():
        h, least = -(-len(x) // 2), np.inf
        for _ in range(300):
            half = x[rng.choice(len(x), 8, replace=False)]
            for _ in range(15):
                d = x - half.mean(0)
                half = x[np.argsort(np.einsum("ni,ij,nj->n", d, np.linalg.inv(np.cov(half.T, bias=True) + floor), d))[:h]]
            least = min(least, np.linalg.det(np.cov(half.T, bias=True) + floor))
        assert 0.9 * least < found[name].determinant < 1.25 * least, (name, found[name].determinant / least)


def test_rules_on_odd_rows(odd, odd_rows):
    got = quality_rules.judge(odd).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    for i in (0, 1, 2, 3, 4, 6, 7):
        assert by[i]["base_failed"] and not by[i]["kept"]
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in got)
    assert quality_rules.judge(odd.limit(0)).count() == 0


# --- classifier --------------------------------------------------------------

def test_em_recovers_rates():
    rng = np.random.default_rng(3)
    m = len(weak_classifier.LABELLERS)
    truth = rng.random(20_000) < 0.2
    hit, slip = np.linspace(0.9, 0.4, m), np.full(m, 0.02)
    votes = np.where(rng.random((len(truth), m)) < np.where(truth[:, None], hit, slip), 1, 2)
    keys = Counter((votes @ 3 ** np.arange(m)).tolist())
    posterior, rates, prior = weak_classifier.fit_labellers(keys)
    assert abs(prior - 0.2) < 0.02 and np.abs(rates[1, :, 1] - hit).max() < 0.05
    guess = np.array([posterior[k] > 0.5 for k in (votes @ 3 ** np.arange(m)).tolist()])
    assert (guess == truth).mean() > 0.97


def test_classifier_on_held_out_labels(spark, sf):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = weak_classifier.classify(docs).join(labels, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.98 and got[got.quality == 0].kept.mean() < 0.35


def test_classifier_on_odd_rows(odd, odd_rows):
    got = weak_classifier.classify(odd)
    assert got.count() == len(odd_rows)
    assert all(r["kept"] for r in got.filter("doc_id IN (0, 1, 2)").collect())
    assert weak_classifier.keep_good(odd).columns == odd.columns
    assert weak_classifier.classify(odd.limit(0)).count() == 0


# --- near duplicates ---------------------------------------------------------

def brute_components(rows):
    sets, parent = [], {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k:k + 5]) for k in range(max(len(words) - 4, 1))} if words else set())
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            held[x].append(k)
    pairs = Counter((a, b) for ks in held.values() for n, a in enumerate(ks) for b in ks[n + 1:])
    for (a, b), n in pairs.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = root(rows[a][0]), root(rows[b][0])
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for (i, _), s in zip(rows, sets)}


def test_near_copies_equal_brute_force(documents):
    want = brute_components([(r["doc_id"], r["text"]) for r in documents.collect()])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dup.clusters(documents).collect()}
    assert got == want


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(2)
    base, rows = [f"w{i}" for i in range(150)], []
    for i in range(400):
        words = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 12)):
            words[k] = f"x{i}-{k}"
        rows.append((i, " ".join(words)))
    got = near_dup.clusters(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows)


def test_near_copies_on_odd_rows(odd, odd_rows):
    got = near_dup.clusters(odd).collect()
    assert len(got) == len(odd_rows)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert [r["n_shingles"] for i in (0, 1, 2) for r in by[i]] == [0, 0, 0] and all(by[i][0]["kept"] for i in (0, 1, 2))
    assert {r["component_id"] for r in by[4]} == {3} and by[None][0]["component_id"] == 3
    assert {r["component_id"] for i in range(60, 70) for r in by[i]} == {60}
    one = near_dup.one_of_each(odd)
    assert one.columns == odd.columns and one.filter("doc_id = 4").count() == 0 and one.filter("doc_id = 60").count() == 1
    assert near_dup.clusters(odd.limit(0)).count() == 0


# --- nearest neighbours ------------------------------------------------------

def test_recall_and_scores(spark, sf):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = table.toPandas()
    x, ids = np.stack(pdf.embedding.to_list()).astype(float), pdf.vec_id.to_numpy()
    place = {int(v): k for k, v in enumerate(ids)}
    got = projected_nn.nearest(table, block=200).toPandas()
    assert set(got.query_id) == {i for i in ids if i % 20 == 0} and (got.groupby("query_id").size() == 20).all()
    recall = []
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        score = x @ x[place[q]]
        assert np.abs(score[[place[v] for v in g.vec_id]] - g.score).max() < 1e-12 and (np.diff(g.score) <= 0).all()
        score[place[q]] = -9
        recall.append(len(set(ids[np.lexsort((ids, -score))[:20]]) & set(g.vec_id)) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("lengths", ["unit", "unequal"])
def test_recall_in_production_blocks(spark, lengths):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(6000, 48))
    x /= np.sqrt((x * x).sum(1))[:, None]
    if lengths == "unequal":
        x *= rng.lognormal(0, 0.7, (len(x), 1))
    rows = [(i, v) for i, v in enumerate(x.tolist())] + [(10_000 + i, [1e6 * i, 1.0]) for i in range(3)]
    got = projected_nn.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    recall = []
    for q in range(0, len(x), 20):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(set(np.argsort(-score)[:20]) & set(got[got.query_id == q].vec_id)) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (40, [1.0, 2.0, 3.0]), (41, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0])]
    frame = spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<double>, score string")
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in projected_nn.nearest(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 20, 0.0), (0, 4, 9, -1.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0),
                   (20, 3, 0, 0.0), (20, 4, 9, 0.0), (40, 1, 41, 1.0)]
    assert projected_nn.nearest(frame.limit(0)).count() == 0


def test_chi_square():
    assert abs(projected_nn.chi_square_cdf(np.array([15.507]), 8)[0] - 0.95) < 1e-4


# --- WARC --------------------------------------------------------------------

def test_records_come_back(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html", F.lit(1).alias("records"))
    pages = pages.unionByName(pages.filter("page_id % 3 = 0").withColumn("page_id", F.col("page_id") + 100_000))
    plain = pages.toPandas()
    plain["digest"] = [warc_zip.base32_sha1(h.encode()) for h in plain.html]
    last = plain.groupby("digest").page_id.max()
    packages = warc_zip.write(pages, staging.new_folder(spark, "warc-test"), package_bytes=50_000)
    assert packages.count() > 2 and packages.agg(F.sum("records")).first()[0] == len(plain)
    got = warc_zip.read(packages, with_payload=True).toPandas().set_index("page_id")
    assert len(got) == len(plain)
    for r in plain.itertuples():
        g, response = got.loc[r.page_id], last[r.digest]
        assert g.payload_digest == r.digest and g.payload_bytes == len(r.html.encode())
        assert g.record_type == ("response" if response == r.page_id else "revisit")
        assert (g.payload == r.html.encode()) if response == r.page_id else g.refers_to == response


def test_zip64_and_comments(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        with z.open("archive/data.warc.gz", "w", force_zip64=True) as f:
            f.write(b"abc" * 1000)
        z.writestr("packed.txt", "x" * 500, zipfile.ZIP_DEFLATED)
        z.writestr("indexes/index.cdx", "hello")
        z.comment = b"PK\x05\x06 is a mark" * 100
    many = tmp_path / "many.zip"
    with zipfile.ZipFile(many, "w", zipfile.ZIP_STORED) as z:
        for i in range(66_000):
            z.writestr(zipfile.ZipInfo(f"n{i}"), b"")
        z.writestr("last", "end")
    with open(path, "rb") as f:
        found = warc_zip.members(f, path.stat().st_size)
        assert set(found) == {"archive/data.warc.gz", "indexes/index.cdx"}
        f.seek(found["archive/data.warc.gz"][0])
        assert f.read(found["archive/data.warc.gz"][1]) == b"abc" * 1000
    with open(many, "rb") as f:
        found = warc_zip.members(f, many.stat().st_size)
        assert len(found) == 66_001
        f.seek(found["last"][0])
        assert f.read(3) == b"end"
    with pytest.raises(ValueError):
        warc_zip.members(pa.BufferReader(b"no archive"), 10)


def test_odd_pages(spark):
    rows = [(1, "u", "a"), (2, None, "a"), (2, "v", "a"), (3, "w", None), (None, "u", ""), (9, "ü ñ\r\n", "é€😀" * 50_000)]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, path string")
    got = Counter((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"])
                  for r in warc_zip.round_trip(spark, frame).collect())
    assert got == Counter({(1, 1, "revisit", 2): 1, (2, 1, "response", None): 2, (3, 0, "response", None): 1,
                           (None, 0, "revisit", 3): 1, (9, 450_000, "response", None): 1})
    assert warc_zip.round_trip(spark, frame.limit(0)).count() == 0


# --- packing -----------------------------------------------------------------

def all_ids(rows):
    coder = tokens.coder(tokens.default_vocabulary())
    return [(i, np.array(coder.exact.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in rows]


def test_sum_of_squares_choice():
    rng = np.random.default_rng(4)
    packer, counts = ss_packing.Packer(32), Counter()
    for n in rng.integers(1, 32, 3000).tolist():
        def cost(h):
            after = counts.copy()
            after[h] -= h > 0
            after[h + n] += 1
            return sum(v * v for level, v in after.items() if 0 < level < 32)
        options = [h for h in range(0, 33 - n) if h == 0 or counts[h]]
        level = packer.level_for(n)
        assert level in options and cost(level) == min(map(cost, options))
        packer.add((0, 0, np.zeros(n, np.uint16)))
        counts[level] -= level > 0
        counts[level + n] += 1
        assert all(packer.counts[h] == counts[h] for h in range(1, 32))


def test_packed_ids_come_back(odd, odd_rows):
    got = ss_packing.pack(odd, with_ids=True).toPandas()
    fills = got.groupby("sequence_id").length.sum()
    assert all(n == 4096 or n & (n - 1) == 0 for n in fills) and (fills <= 4096).all()
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got.itertuples())
    for i, ids in all_ids([r[:2] for r in odd_rows]):
        if i in (4, None):  # a repeated row, and a null id
            continue
        mine = got[got.doc_id == i].sort_values("start")
        assert b"".join(mine.ids) == ids.tobytes() and (mine.doc_tokens == len(ids)).all()
    assert got[got.doc_id == 4].length.sum() == 2 * len(all_ids([(4, "ONE  two\n")])[0][1])
    assert ss_packing.pack(odd.limit(0)).count() == 0


def test_open_windows_are_bounded():
    packer = ss_packing.Packer(64, most_open=10)
    for i in range(100):
        packer.document(i, np.arange(40, dtype=np.uint16))
        assert packer.open <= 10
    packer.close()
    assert sum(len(p[2]) for w in packer.done for p in w) == 4000


@pytest.mark.parametrize("most_open", [3, 4096])
def test_closing_fills_windows_and_loses_no_id(most_open):
    rng = np.random.default_rng(9)
    for count in (0, 1, 2, 7, 300):
        packer, texts = ss_packing.Packer(64, most_open), []
        for i, n in enumerate(rng.integers(1, 150, count).tolist()):
            texts.append(rng.integers(0, 9999, n).astype(np.uint16))
            packer.document(i, texts[-1])
        packer.close()
        fills = [sum(len(p[2]) for p in w) for w in packer.done]
        total = sum(map(len, texts))
        assert fills.count(64) == total // 64 and packer.open == 0 and not packer.counts.any()
        assert sorted(f for f in fills if f < 64) == [1 << b for b in range(6) if total % 64 >> b & 1]
        pieces = sorted(((row, start, ids) for w in packer.done for row, start, ids in w), key=lambda p: p[:2])
        for i, text in enumerate(texts):
            mine = [p for p in pieces if p[0] == i]
            assert [p[1] for p in mine] == [0, *np.cumsum([len(p[2]) for p in mine])[:-1]]
            assert (np.concatenate([p[2] for p in mine]) == text).all()


def test_pieces_placed_at_closing_follow_the_sum_of_squares():
    rng = np.random.default_rng(10)
    packer = ss_packing.Packer(64)
    for i, n in enumerate(rng.integers(20, 60, 300).tolist()):
        packer.document(i, np.full(n, i, np.uint16))
    placed, put = [], packer._put
    packer._put = lambda piece, level: (placed.append((len(piece[2]), level, packer.counts.copy())), put(piece, level))
    packer.close()

    def total(counts, level, n):
        after = counts.copy()
        after[level] -= 1
        after[level + n] += 1
        return int((after[1:64] ** 2).sum())

    assert placed
    for n, level, counts in placed:
        options = [h for h in range(1, 65 - n) if counts[h]]
        assert not options or total(counts, level, n) == min(total(counts, h, n) for h in options)


def test_best_fit_equals_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(100):
        row = int(rng.choice([7, 16, 50]))
        sizes = rng.integers(1, row + 1, rng.integers(0, 60)).tolist()
        want: list[list[int]] = []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            room = [row - sum(sizes[j] for j in w) for w in want]
            fits = [r for r in room if r >= sizes[i]]
            if fits:
                want[room.index(min(fits))].append(i)
            else:
                want.append([i])
        got = bfd_packing.best_fit(sizes, row)
        assert sorted(i for w in got for i in w) == list(range(len(sizes)))
        assert Counter(sum(sizes[i] for i in w) for w in got) == Counter(sum(sizes[i] for i in w) for w in want)


def test_matrices_come_back(spark, odd, odd_rows):
    got = bfd_packing.round_trip(spark, odd).toPandas()
    want = Counter((i, len(ids)) for i, ids in all_ids([r[:2] for r in odd_rows]))
    assert sum(n * k for (_, n), k in want.items()) == got.length.sum()
    rows = got.groupby(["file", "row"])
    assert (rows.length.sum() == rows.n_tokens.first()).all() and (rows.size() == rows.n_segments.first()).all()
    assert (got.n_resets == got.n_segments).all()
    crc = {(i, s): zlib.crc32(ids[s:s + 2048].tobytes()) for i, ids in all_ids([r[:2] for r in odd_rows])
           for s in range(0, len(ids), 2048)}
    assert all(crc[None if np.isnan(r.doc_id) else int(r.doc_id), r.start] == r.ids_crc32 for r in got.itertuples())
    single = got[got.n_segments == 1]
    assert (single.ids_crc32 == single.row_crc32).all()
    assert bfd_packing.round_trip(spark, odd.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------

def brute_targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in free}
        for s in full:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= full
    return out


@pytest.mark.parametrize("table", ["documents", "odd"])
def test_mix_against_brute_force(request, table):
    docs = request.getfixturevalue(table)
    plain = [(r["doc_id"], r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()]
    sizes = Counter()
    for _, s, n in plain:
        sizes[s] += n
    aims = brute_targets(sizes)
    got = mixing.mix(docs).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(plain)
    taken, largest = Counter(), max(n for *_, n in plain)
    for r in got:
        assert abs(r["target"] - aims[r["source"]]) < 1e-6 * max(1, r["target"]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - aims[s]) <= max(n for _, x, n in plain if x == s) for s in sizes)
    assert 1.5 * sum(sizes.values()) - largest <= sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert rows_of(mixing.mix(docs)) == rows_of(mixing.mix(docs.repartition(7)))
    copies = mixing.mixed_documents(docs)
    assert copies.columns == docs.columns and copies.count() == sum(r["copies"] for r in got)


def test_mix_of_nothing(odd):
    assert mixing.mix(odd.limit(0)).count() == 0
    assert all(r["taken"] == 0 for r in mixing.mix(odd.filter("doc_id < 3")).collect())


# --- HTML and token counts ---------------------------------------------------

PAGE = """<html><head><title>T</title><script>a<b</script><body><h1>Head</h1>one <b>two</b>
three<p>para<p>second<br>line<ul><li>a<li>b<ul><li>b1<li>b2</ul><li>c</ul><ol start=3><li>x<li>z</ol>
<table><tr><th>Name<th>Qty<tr><td>apple<td>12<tr><td>kiwi &amp; co<td><table><tr><td>in<td>ner</table></table>tail<div hidden>no</div>
<span style="display: none">no</span><pre>  keep
   this</pre><dl><dt>term<dd>def</dl><img alt="pic"> end</div></p>after <!-- c --> &copy; <a title='x>y'>link</a> 3 < 4"""
TEXT = """Head

one two three

para

second
line

- a
- b
  - b1
  - b2
- c

3. x
4. z

Name      | Qty
apple     | 12
kiwi & co | in | ner

tail

  keep
   this

term
  def

pic end

after © link 3 < 4"""


def test_layout():
    assert html_text.render(html_text.build(PAGE)) == TEXT


@pytest.mark.parametrize("page, text", [
    ("<a title='it's'>Hello</a> <p>don't</p>", "Hello\n\ndon't"), ("<p it's hidden'>one</p><p>isn't</p>", "one\n\nisn't"),
    ("<a title = \"x>y\" rel='a>b'>link</a>", "link"), ("<a href=it's>one</a> two's", "one two's"),
    ("a<xmp>  <b>x</b> &amp;\n y</xmp>b", "a\n\n  <b>x</b> &amp;\n y\n\nb")])
def test_stray_quotes_and_xmp(page, text):
    assert html_text.render(html_text.build(page)) == text


@pytest.mark.parametrize("page", ["", "<", "<p", "</", "<!--", "<a href='x", "</td></table>", "<script>", "&#x110000;"])
def test_broken_markup(page):
    html_text.render(html_text.build(page))


def test_all_visible_words_of_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    texts = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        body = re.sub(r"(?s)<head>.*?</head>|<script>.*?</script>|<style>.*?</style>|<!--.*?-->", " ", r["html"])
        words = html_text.html.unescape(re.sub(r"</?(?:b|a|i|em|strong)\b[^>]*>", "", body))
        words = re.sub(r"<[^>]*>", " ", words).split()
        assert [w for w in texts[r["page_id"]].split() if w != "-"] == [w for w in words if w != "-"]


def test_odd_html(spark):
    frame = spark.createDataFrame([(1, None, 1), (1, None, 1), (None, "<p>x", 1), (3, "<div>" * 3000 + "deep", 1)],
                                  "page_id long, html string, text int")
    assert rows_of(html_text.extract(frame).select("page_id", "text")) == sorted(map(str, [
        *[r for r in spark.createDataFrame([(1, ""), (1, ""), (None, "x"), (3, "deep")], "page_id long, text string").collect()]]))
    assert html_text.extract(frame.limit(0)).count() == 0


def test_token_attribution(odd, odd_rows):
    got = defaultdict(list)
    for r in token_counts.count(odd).orderBy("section").collect():
        got[r["doc_id"]].append(r)
    tokenizer = token_counts.units(token_counts.default_vocabulary()).tokenizer
    for i, text, *_ in odd_rows:
        if i in (4, None):
            continue
        text = text or ""
        spans, mine = tokenizer.encode(text, add_special_tokens=False).offsets, got[i]
        assert sum(r["n_tokens"] for r in mine) == len(spans) == mine[0]["doc_tokens"]
        assert [r["start"] for r in mine] == [sum(x["length"] for x in mine[:k]) for k in range(len(mine))]
        assert sum(r["length"] for r in mine) == len(text)
        if len(text) > 10_000:
            continue
        counts = Counter()
        for a, b in spans:
            held = [(max(0, min(b, r["start"] + r["length"]) - max(a, r["start"])), -k) for k, r in enumerate(mine)]
            counts[-max(held)[1] if b > a else 0] += 1
        assert all(counts[k] == r["n_tokens"] for k, r in enumerate(mine))
    assert token_counts.count(odd.limit(0)).count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 11))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf, name):
    import duckdb
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    got = queries.QUERIES[name](spark, sf)
    want = con.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(want.fetchall())
