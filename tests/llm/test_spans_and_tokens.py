"""Secrets, fill-in-the-middle and token alignment against plain Python."""
import hashlib
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from regloom.llm import fill_in_middle, secret_lexer, token_alignment as ta

def texts(parts, most):
    return st.lists(st.sampled_from(parts), max_size=most).map("".join)


TEXTS = texts(list("ab1 \n\t.'\"<>PSM=:é😀\xa0▁-\r") + ["word ", "don't ", " 12"], 60)


# --- secrets -----------------------------------------------------------------

SOURCE = '''import os
token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
BASE = "x9Kq-2LmPz" + "77QwErTy"
client_secret: str = BASE
password = os.getenv("PASSWORD_ENV")
pwd = "changeme"
config["db_password"] = 'tR0ub4dor&3'
{"apiKey": "A1b2C3d4E5f6", "password_field": "user_password1", "title": "hello"}
DB_PASS=s3cr3tV4lue!
<password>Zx81Spectrum</password>
url = "postgres://admin:Hunter2x9@db.host/prod"
const signingKey = later;
later = "0aZ9-bY8_cX7dW6"
# don't set password == "notAssigned9" or it's bad
key: the garden
a = "abc12"
b = "DEF34"
secret_access_key = a + b
public_key = "MIIBIjANBgkqhkiG9w0"
'''
LITERALS = {"04dbebab91ab85687d33eeaaf9ac699e1188f962": "token", "x9Kq-2LmPz": "client_secret", "77QwErTy": "client_secret",
            "tR0ub4dor&3": "db_password", "A1b2C3d4E5f6": "apiKey", "s3cr3tV4lue!": "DB_PASS", "Zx81Spectrum": "password",
            "Hunter2x9": "password", "0aZ9-bY8_cX7dW6": "signingKey", "abc12": "secret_access_key",
            "DEF34": "secret_access_key"}


def test_assigned_literals_and_propagated_constants():
    text = "😀 é " + SOURCE
    got = {text[f["start"]:f["stop"]]: f["name"] for f in secret_lexer.findings(text) if f["kind"] == "literal"}
    assert got == LITERALS


def brute_shapes(text):
    """The contract's base spans, character by character where no pattern is needed."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
                         r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    run = 0
    for i, c in enumerate(text + "~"):
        if c in "0123456789abcdef":
            run += 1
            continue
        if run >= 32:
            out.append((i - run, 2, i))
        run = 0
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        stop = at + 4
        while stop < len(text) and (text[stop].isascii() and (text[stop].isdigit() or text[stop].isupper())):
            stop += 1
        if stop == at + 4:
            at += 1
            continue
        if stop - at >= 16:
            out.append((at, 1, stop))
        at = stop
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out)]


ODD_SECRETS = ["", None, "token=secret :abcdefghij", "api-key: x", "ſecret=abcdefghi", "AKIA" + "A1" * 8 + "é AKIAB AKIAAKIA",
               "0" * 31 + " " + "f" * 32 + "F", "PASSWORD : 'aaaaaaaa'", "pass" * 50_000, "x = " + "y + " * 20_000 + "'z'",
               "token = '" + "ab" * 40_000 + "'", '"\\' * 50_000, "password=" * 20_000, SOURCE, SOURCE]


def test_secrets_of_a_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(-i, t) for i, t in enumerate(ODD_SECRETS)]
    got = secret_lexer.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        text = texts[r["doc_id"]] or ""
        want = brute_shapes(text)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert [s for s in spans if not s.startswith("literal")] == want
        if r["doc_id"] > 0:  # prose: literals only where an assignment stands
            assert all(any(int(w.split(":")[1]) < int(s.split(":")[1]) <= int(w.split(":")[2]) for w in want)
                       for s in spans if s.startswith("literal"))
    assert secret_lexer.digests(documents.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(texts(["pass", "word", "key", "token", "=", ":", " ", "\n", '"', "'", "a1B2c3D4e5", "x", "+", "(", "<", ">",
                                "/", "api_", "\\", "://", "@", "[", "]"], 25))
def test_texts_not_lexed_have_no_findings(text):
    found = secret_lexer.findings(text)
    may = pa.compute.match_substring_regex(pa.array([text]), secret_lexer.HOLDS)[0].as_py()
    assert may or not found
    assert all(0 <= f["start"] < f["stop"] <= len(text) for f in found)


# --- fill in the middle ------------------------------------------------------

def brute_fim(i, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD_TEXTS = ["", None, "x", "x" * 300_000, "a b," * 100_000, "😀 ß\n$1\\ <P <S", "\r\n", "a<P>b", "<", "<<S", "P>x", "é" * 70_000, "$3 \\2"]


def test_middles_of_a_table(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows += [(i, t) for i in range(10**6, 10**6 + 12) for t in ODD_TEXTS[:3] + ODD_TEXTS[5:11]] + [(None, t) for t in ODD_TEXTS]
    rows += [(7, "twice given"), (7, "twice given")]
    got = fill_in_middle.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = []
    for i, t in rows:
        n, form, p, m, out = brute_fim(i, t)
        want.append((i, n, form, p, m, hashlib.sha256(out.encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert fill_in_middle.digests(documents.limit(0)).count() == 0


def test_outputs_are_restored(spark, odd):
    back = fill_in_middle.restored(fill_in_middle.transform(odd, rate=100, spm_rate=50))
    assert back.filter("restored <> text OR restored IS NULL").count() == 0 and back.count() == odd.count()
    assert back.select("form").distinct().count() == 3


def test_middles_stay_in_the_scan(documents):
    plan = fill_in_middle.digests(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- alignment ---------------------------------------------------------------

def spans(tokens):
    at, out = 0, []
    for i, body in tokens:
        out.append((at, at + len(body), i))
        at += len(body)
    return out


@pytest.fixture(scope="module")
def brute_tokens():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    paths = ta.default_vocabularies()
    a, b = Tokenizer.from_file(paths[0]), SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    letters = ta._byte_letters()

    def tokens(text):
        if not text:
            return [], []
        one = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        two = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode())
               for i in b.encode(text)]
        whole = (" " + text).encode()
        if any(b"".join(x for _, x in t) != whole for t in (one, two)):
            return [], []
        return spans(one), spans(two)

    return tokens


def brute_links(a, b):
    out, j = [], 0
    for start, stop, i in a:
        while b[j][1] <= start:
            j += 1
        m = j
        while m < len(b) and b[m][0] < stop:
            out.append((i, b[m][2]))
            m += 1
    return out


def brute_groups(a, b):
    out, a, b = [], list(a), list(b)
    for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
        sides = []
        for side in (a, b):
            n = sum(e <= end for _, e, _ in side[:60]) if len(side) < 60 or side[59][1] > end else None
            n = sum(e <= end for _, e, _ in side) if n is None else n
            sides.append(",".join(str(i) for _, _, i in side[:n]))
            del side[:n]
        out.append("|".join(sides))
    return ";".join(out), len(out)


def brute_alignment(rows, tokens):
    found, held = [], Counter()
    for i, text in rows:
        a, b = tokens(text)
        links = brute_links(a, b)
        held.update(set(links))
        groups, n = brute_groups(a, b)
        found.append((i, len(a), len(b), n, links, hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return sorted(str((i, na, nb, n, len(l), sum(held[p] == best[p[0]] for p in l), sum(held[p] for p in l), h))
                  for i, na, nb, n, l, h in found)


ODD_TOKENS = ["", " ", "  ", "a  b", " x", "x ", "\n\n", "a　 b", "a\xa0 é  b", "x▁y", "<s> <|endoftext|> </s>", ".\r\n  x\t\ty",
              "é́ 😀 ß x\x1cy z", "it's  don't\n 'll", "\x00 a", "ab" * 3000, None, "\x85 a \x85 b", "— —", "e    x", "a  b"]


def test_alignment_of_a_table(spark, documents, brute_tokens):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()] + [(-i, t) for i, t in enumerate(ODD_TOKENS)] + [(None, "abc def")]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, block string").repartition(5)
    got = ta.digests(frame)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute_alignment(rows, brute_tokens)
    assert ta.digests(frame.limit(0)).count() == 0


def test_groups_as_rows(spark, documents):
    some = documents.filter("doc_id < 20").unionByName(spark.createDataFrame([(-1, "")], "doc_id long, text string"), True)
    texts = {r["doc_id"]: " " + r["text"] for r in some.collect()}
    rows, digest = ta.groups(some).collect(), {r["doc_id"]: r for r in ta.digests(some).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    for i, r in digest.items():
        mine = sorted(by[i], key=lambda x: x["group"])
        assert len(mine) == r["n_groups"]
        joined = ";".join(",".join(map(str, g["a_ids"])) + "|" + ",".join(map(str, g["b_ids"])) for g in mine)
        assert (hashlib.sha256(joined.encode()).hexdigest() if mine else "") == r["groups_sha256"]
        if mine:
            assert [g["start"] for g in mine[1:]] == [g["stop"] for g in mine[:-1]] and mine[0]["start"] == 0
            assert mine[-1]["stop"] == len(texts[i].encode())


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_units_encode_like_whole_texts(brute_tokens, texts):
    found = ta.aligner(*ta.default_vocabularies()).align(pa.array(texts))
    for i, text in enumerate(texts):
        for side, want in enumerate(brute_tokens(text)):
            assert found.ids[side][found.doc[side] == i].tolist() == [t[2] for t in want]


# --- reading back, long pages ------------------------------------------------

def test_packages_and_matrices_are_read_by_many_tasks(spark, documents, sf):
    from regloom.llm import bfd_packing, staging, warc_zip
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    packages = warc_zip.write(pages, staging.new_folder(spark, "test-warc"), package_bytes=1_500)
    n = packages.count()
    read = warc_zip.read(packages)
    assert n >= 24 and read.rdd.getNumPartitions() > 8 and read.count() == pages.count()
    segments = bfd_packing.pack(documents, staging.new_folder(spark, "test-packed"), block_tokens=8_000)
    rows = bfd_packing.read_rows(segments)
    assert segments.select("file").distinct().count() >= 8 and rows.rdd.getNumPartitions() >= 8 and rows.count() > 0


@pytest.mark.parametrize("unit", ["<div>", "<a ", "<li>", "</i>", "<ul><li>x", "<p><table><td>", '<a x="', "<body>", "<dd>"])
def test_long_pages_take_linear_time(unit):
    import time
    from regloom.llm import html_text
    page = unit * ((1 << 20) // len(unit))
    begun = time.process_time()
    html_text.render(html_text.build(page))
    assert time.process_time() - begun < 10


def test_odd_pages():
    from regloom.llm import html_text

    def text(page):
        return html_text.render(html_text.build(page))

    assert text("<head><b>x<body><p>seen") == "seen"
    assert text("one <a two <b three") == "one <a two <b three"
    assert text("<p>one<table><tr><td>two<div>three") .split() == ["one", "two", "three"]


# --- neighbours: ties and repeated ids ---------------------------------------

def test_copies_and_repeated_ids(spark):
    import numpy as np
    from regloom.llm import projected_nn
    rng = np.random.default_rng(1)
    one, other = rng.standard_normal(16), rng.standard_normal((300, 16))
    rows = [(i, one.tolist()) for i in range(3000, 8000)] + [(i, v.tolist()) for i, v in enumerate(other, 1)]
    rows += [(0, one.tolist()), (0, (-one).tolist()), (2, other[1].tolist())]
    rng.shuffle(rows)
    rows = [(int(i), [float(x) for x in v]) for i, v in rows]
    got = projected_nn.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), every=1000)
    vectors, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    want = []
    for k in np.flatnonzero(ids % 1000 == 0).tolist():
        scores = projected_nn.products(vectors, vectors[k])
        best = [m for m in np.lexsort((ids, -scores)).tolist() if m != k][:20]
        want += [(int(ids[k]), rank, int(ids[m]), float(scores[m])) for rank, m in enumerate(best, 1)]
    assert len(want) == 7 * 20  # two rows share the id 0, each has its answer
    assert sorted(map(tuple, got.collect())) == sorted(want)
