"""Secrets in texts: fixed shapes, and literals assigned to sensitive names.

Besides three fixed shapes (``SHAPES``), texts are lexed as source code or
configuration: strings, names, operators, tags. The lexemes are parsed into
assignments (``name = "literal"``, ``"name": "literal"``, ``x["name"] = ..``,
``name: type = ..``, ``name => ..``, ``NAME=bare``, ``<name>bare</name>``, user and
password of a URL). A value is a row of literals and names joined by ``+`` or
written side by side; a name stands for the constant assigned to it last before,
or else first after. So constants propagate from assignment to assignment, and
a literal counts for every target it reaches.

A target's words give a weight (``WEIGHTS``; ``KEY_KINDS`` make a key a strong one,
``HARMLESS`` words make a name harmless), a value's length, kinds and number of
characters its strength. If weight times strength reaches ``LEAST`` (``LEAST_BARE``
without quotes), all literals of the value are findings of kind ``literal``.
Placeholders, and values with white space, are none.

Each text is one pass over its lexemes and one over its assignments, whatever
its length, in the scan's stage; texts that cannot hold a finding are told by
a pattern over the whole batch and not lexed.

Defined cases: null and empty texts have no findings; unclosed quotes are
ordinary characters; offsets are code points; repeated rows are scanned each; an
empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import arrow_text as at

#: Fixed shapes: pattern, the group whose length counts, its least length.
SHAPES = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                          re.IGNORECASE | re.ASCII), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
KINDS = [*SHAPES, "literal"]

WEIGHTS = {"password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 3.0, "pass": 3.0, "secret": 3.0, "secrets": 3.0,
           "credential": 3.0, "credentials": 3.0, "apikey": 3.0, "token": 2.0, "bearer": 2.0, "auth": 2.0, "jwt": 2.0,
           "salt": 2.0, "key": 0.7}
KEY_KINDS = {"api", "access", "private", "secret", "encryption", "signing", "master", "auth", "account", "storage", "ssh",
             "aes", "hmac", "client", "service"}
HARMLESS = {"url", "uri", "path", "file", "field", "label", "hint", "placeholder", "length", "min", "max", "policy", "prompt",
            "message", "title", "type", "name", "public", "header", "regex", "pattern", "count", "size", "ttl", "expiry",
            "expires", "error", "column", "format", "version"}
PLACEHOLDER = re.compile(r"^[$@%<{]|^(.)\1*$|example|change_?me|your[_-]|dummy|placeholder|redacted|^(?:none|null|undefined|"
                         r"true|false|todo)$", re.IGNORECASE)
LEAST, LEAST_BARE = 4.5, 7.5

LEXEME = re.compile(r"""
  (?P<string>(?<![\w\\])[rbfuRBFU]{0,2}(?:\"{3}(?:[^\\"]++|\\.|"(?!""))*+\"{3}|'{3}(?:[^\\']++|\\.|'(?!''))*+'{3}
     |"(?:[^"\\\n]++|\\.)*+"|'(?:[^'\\\n]++|\\.)*+'|`(?:[^`\\]++|\\.)*+`))
 |(?P<tag></?[A-Za-z][\w.:-]*+>)
 |(?P<name>[A-Za-z_$][\w$]*+(?:(?:\.|->|::|-)[A-Za-z_$][\w$]*+)*+)
 |(?P<op>:=|=>|==|!=|<=|>=|[=:+])
 |(?P<mark>[^\s\w])
 |(?P<line>\n)
 |(?P<other>\w++)
""", re.VERBOSE | re.DOTALL)
QUOTES = re.compile(r"[rbfuRBFU]{0,2}(\"{3}|'{3}|[\"'`])")
BARE = re.compile(r"[^\s\"'`,;<>(){}\[\]]+")
TAGGED = re.compile(r"[^<>\n]+")
SPACE = re.compile(r"\s")
NAME_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
URL_PASSWORD = re.compile(r"://[^\s:/@\"']+:([^\s/@\"']+)@")
#: What every text with a finding of some kind holds (one automaton, whole batches).
HOLDS = (r"(?i:pass|pwd|secret|token|bearer|auth|jwt|salt|key|cred)[^\"'=;\n]*[\"'`\]\s]*[:=>]|://[^\s:/@\"']+:[^\s/@\"']+@"
         r"|AKIA|[0-9a-f]{32}")


def weight(name: str) -> float:
    """Sensitivity of a target by its words: 0 harmless, 3 surely a secret."""
    words = [w.lower() for w in NAME_WORD.findall(name)]
    if HARMLESS.intersection(words):
        return 0.0
    best = max((WEIGHTS.get(w, 0.0) for w in words), default=0.0)
    keyed = any(b == "key" and a in KEY_KINDS for a, b in zip(words, words[1:]))
    return 3.0 if keyed else best


def strength(length: int, seen: int) -> float:
    """Of a value, by its length and the set of its characters (bits up to 127, one for all others)."""
    kinds = sum(bool(seen & mask) for mask in _MASKS)
    return min(length / 8, 3.0) + max(kinds - 1, 0) + min(seen.bit_count(), 16) / 8


def _mask(chars: str) -> int:
    return sum(1 << ord(c) for c in chars)


_LOWER, _UPPER, _DIGIT = (_mask(c) for c in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
_MASKS = (_LOWER, _UPPER, _DIGIT, ((1 << 128) - 1) & ~(_LOWER | _UPPER | _DIGIT))


class Assignment:
    """A target, its literals (start, stop) and the assignments its names stand for."""
    __slots__ = ("name", "at", "literals", "names", "bare", "sources", "length", "seen", "score", "shown")

    def __init__(self, name: str, at: int):
        self.name, self.at, self.bare, self.shown = name, at, False, False
        self.literals: list[tuple[int, int]] = []
        self.names: list[str] = []
        self.sources: list[Assignment] = []
        self.length = self.seen = 0
        self.score = 0.0


def _inner(text: str, start: int, stop: int) -> tuple[int, int]:
    """A string lexeme without prefix and quotes."""
    quote = QUOTES.match(text, start)
    return quote.end(), stop - len(quote[1])


def assignments(text: str) -> list[Assignment]:
    """All assignments of a text in order, names not yet resolved."""
    found: list[Assignment] = []
    lexemes = [(m.lastgroup, m.start(), m.end()) for m in LEXEME.finditer(text)]
    n = len(lexemes)
    kind = lambda i: lexemes[i][0] if 0 <= i < n else ""
    word = lambda i: text[lexemes[i][1]:lexemes[i][2]] if 0 <= i < n else ""
    i = 0
    while i < n:
        what, start, stop = lexemes[i]
        if what == "tag" and text[start + 1] != "/":
            body = TAGGED.match(text, stop)
            if body and text.startswith("</", body.end()):
                one = Assignment(text[start + 1:stop - 1], start)
                one.bare, one.literals = True, [body.span()]
                found.append(one)
        elif what == "string":
            found += _url_passwords(text, start, stop)
        elif what == "op" and text[start:stop] in ("=", ":", ":=", "=>"):
            left = i - 2 if word(i - 1) == "]" else i - 1
            if kind(left) in ("name", "string"):
                a, b = lexemes[left][1:] if kind(left) == "name" else _inner(text, *lexemes[left][1:])
                one = Assignment(text[a:b], a)
                j = i + 1
                if text[start:stop] == ":" and kind(j) == "name" and word(j + 1) == "=":
                    j += 2  # a type stands between
                after = _value(text, lexemes, j, one, kind, word)
                for k in range(j, after):
                    if kind(k) == "string":
                        found += _url_passwords(text, *lexemes[k][1:])
                if one.literals or one.names:
                    found.append(one)
                i = max(i, after - 1)
        i += 1
    return found


def _url_passwords(text: str, start: int, stop: int) -> list[Assignment]:
    out = []
    for m in URL_PASSWORD.finditer(text, start, stop):
        out.append(Assignment("password", m.start()))
        out[-1].literals.append(m.span(1))
    return out


def _value(text, lexemes, j, one, kind, word) -> int:
    """Read the operands of a value from lexeme j on; the place after them."""
    first = j
    while True:
        if kind(j) == "string":
            one.literals.append(_inner(text, *lexemes[j][1:]))
        elif kind(j) == "name" and word(j + 1) in ("+", "", "\n", ";", ",", ")", "}", "]") or (
                kind(j) == "name" and j > first):
            if word(j + 1) == "(":
                return j
            one.names.append(word(j))
        elif j == first and kind(j) not in ("", "line"):
            bare = BARE.match(text, lexemes[j][1])
            if bare and word(j + 1) != "(":
                one.bare, one.literals = True, [bare.span()]
                while kind(j) and lexemes[j][1] < bare.end():
                    j += 1
            return j
        else:
            return j
        j += 1
        if word(j) == "+":
            j += 1
        elif kind(j) != "string":
            return j


def resolve(found: list[Assignment]) -> None:
    """Tie names to constants and score each value: lengths add up and characters
    unite along names, so a chain of assignments is one step each."""
    last: dict[str, Assignment] = {}
    later: dict[str, Assignment] = {}
    for one in reversed(found):
        later[one.name] = one
    for one in found:
        for name in one.names:
            source = last.get(name) or later.get(name)
            if source is not None and source is not one:
                one.sources.append(source)
                one.length += source.length
                one.seen |= source.seen
        last[one.name] = one


def literal_findings(text: str) -> list[tuple[int, int, str, float]]:
    """start, stop, target and score of the literals that sensitive names reach."""
    found = assignments(text)
    for one in found:
        for a, b in one.literals:
            value = text[a:b]
            if PLACEHOLDER.search(value) or SPACE.search(value):
                one.literals = []
                one.length = one.seen = 0
                break
            one.length += b - a
            for c in set(value):
                one.seen |= 1 << min(ord(c), 127)
    resolve(found)
    best: dict[tuple[int, int], tuple[str, float]] = {}
    hits = [(weight(o.name) * strength(o.length, o.seen), o) for o in found if o.length]
    for score, one in sorted(((s, o) for s, o in hits if s >= (LEAST_BARE if o.bare else LEAST)), key=lambda x: (-x[0], x[1].at)):
        stack = [one]
        while stack:
            node = stack.pop()
            if node.shown:
                continue
            node.shown = True
            for span in node.literals:
                best.setdefault(span, (one.name, score))
            stack += node.sources
    return [(a, b, name, score) for (a, b), (name, score) in best.items() if b > a]


def shape_findings(text: str) -> list[tuple[str, int, int]]:
    """kind, start and stop of all matches of the fixed shapes that are long enough."""
    return [(kind, m.start(), m.end()) for kind, (pattern, group, least) in SHAPES.items()
            for m in pattern.finditer(text) if len(m[group]) >= least]


def findings(text: str) -> list[dict]:
    """All findings of a text by start, then kind in the order of ``KINDS``."""
    rows = [{"kind": k, "start": a, "stop": b, "name": None, "score": None} for k, a, b in shape_findings(text)]
    rows += [{"kind": "literal", "start": a, "stop": b, "name": n, "score": s} for a, b, n, s in literal_findings(text)]
    return sorted(rows, key=lambda r: (r["start"], KINDS.index(r["kind"]), r["stop"]))


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("name", pa.string()),
                            ("score", pa.float64())]))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and findings: array of kind, start, stop (code points), and of literals
    the target's name and the score."""
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch):
                texts = at.strings(part.column("text"))
                may = pc.match_substring_regex(texts, HOLDS).to_pylist()
                found = [findings(t) if m else [] for t, m in zip(texts.to_pylist(), may)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, FOUND)], names=["doc_id", "findings"])

    return used.mapInArrow(run, f"doc_id {dict(used.dtypes)['doc_id']}, findings array<struct<kind string, start long, "
                                "stop long, name string, score double>>")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 over the findings of the fixed
    shapes, and all findings as ``kind:start:stop``, comma-joined."""
    def listed(column):
        return F.array_join(F.transform(column, lambda f: F.concat_ws(":", f["kind"], f["start"], f["stop"])), ",")

    def of(kind):
        return lambda f: f["kind"] == kind

    shapes = F.filter("findings", lambda f: f["kind"] != "literal")
    return scan(docs).select(
        "doc_id", *[F.size(F.filter("findings", of(k))).cast("long").alias(f"n_{k}") for k in SHAPES],
        F.sha2(listed(shapes), 256).alias("base_sha256"), listed("findings").alias("spans"))
