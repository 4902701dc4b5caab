"""Text helpers against plain Python."""
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from regloom.llm import arrow_text as at, quality_rules, shingles, token_counts, tokens

WORD = re.compile(r"[^\x20\x09-\x0D]+")
texts = st.lists(st.text(st.one_of(st.sampled_from(" \n\t\x0b\x1c ab<|>%#.é'sS~́"), st.characters(exclude_categories=["Cs"])),
                         max_size=60), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_and_counts(some):
    array = at.strings(pa.array([*some, None]))
    bounds, codes, words = at.word_codes(array)
    want = [WORD.findall(t) for t in some] + [[]]
    assert [[words[int(c)].as_py() for c in codes[a:b]] for a, b in zip(bounds, bounds[1:])] == want
    assert at.word_counts(array).tolist() == [len(w) for w in want]
    got = quality_rules.measure(array)
    assert got["word_chars"].tolist() == [sum(map(len, w)) for w in want]
    assert got["n_symbols"].tolist() == [len(re.findall(r"[#*$%&|<>]", t)) for t in [*some, ""]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c"]), max_size=30), st.lists(st.sampled_from(["a b", "a", " ", ""]), max_size=8))
def test_repeats(words, lines):
    text = " ".join(words) + "\n" + "\n".join(lines)
    found = WORD.findall(text)
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    got = quality_rules.measure(at.strings(pa.array([text, text[:3]])))
    assert got["n_repeat_words"][0] == len(covered) and got["n_dup_lines"][0] == repeated


@settings(max_examples=100, deadline=None)
@given(texts)
def test_ids_equal_the_tokenizer(some):
    coder = tokens.coder(tokens.default_vocabulary())
    bounds, ids = coder.ids(at.strings(pa.array(some)))
    want = [e.ids + [2] for e in coder.exact.encode_batch(some, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == want


@settings(max_examples=100, deadline=None)
@given(texts)
def test_spans_equal_the_tokenizer(some):
    path = token_counts.default_vocabulary()
    want = [e.offsets for e in token_counts.units(path).tokenizer.encode_batch(some, add_special_tokens=False)]
    assert [list(zip(a.tolist(), b.tolist())) for a, b in token_counts.token_spans(some, path)] == want


def test_forgetting_keeps_ids(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 4)
    coder = tokens.WordCoder(tokens.default_vocabulary())
    for text in ("a b c d e f, g!", "a b", "new words here"):
        assert coder.ids(pa.array([text]), None)[1].tolist() == coder.exact.encode(text, add_special_tokens=False).ids


def test_shingle_sets():
    def brute(text):
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
        return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()

    some = ["", "a", "A", "a b c d", "a b c d e", "A b C d e a b c d e a", "x y z x y z x y z x y z", "É é"]
    sets = shingles.shingle_sets(at.strings(pa.array(some)))
    for i, s in enumerate(some):
        assert len(sets[i]) == len(brute(s)) and (np.diff(sets[i]) > 0).all()
        for j, t in enumerate(some):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute(s) & brute(t))
