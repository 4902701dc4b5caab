"""Token counts per section by offset-mapped attribution.

A whole document is encoded once; every token keeps its span of characters.
Sections are spans too: here the sentences and lines of a text, each with the
white space that follows it. Tokens and sections are joined by interval. A
token inside one section counts there. A token that crosses a boundary belongs
to the section that holds most of its characters, the earlier one in a tie, and
is counted as crossing. Counts of a document's sections add up to its tokens.

The byte-level vocabulary puts a space before the word that follows, so the
first token of a sentence crosses from the one before. Texts are coded in units
that begin at a space behind a visible character, where the vocabulary's pattern
always splits; distinct units are coded once and kept (``token_alignment.Units``).

Defined cases: null and empty texts have one section of no characters and no
tokens; special strings count as ordinary text; repeated rows are counted each;
an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import arrow_text as at
from .token_alignment import Side, Units, byte_coder

SECTION = re.compile(r"\n\s*|(?<=[.!?])[ \t]+")
SLICE = 4 << 20


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def section_starts(text: str) -> np.ndarray:
    """First characters of the sections: 0, and what follows each break."""
    ends = [m.end() for m in SECTION.finditer(text) if m.end() < len(text)]
    return np.unique(np.array([0, *ends], np.int64))


def attributed(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span, and whether it crosses a boundary."""
    first = np.searchsorted(sections, starts, side="right") - 1
    last = np.searchsorted(sections, np.maximum(ends - 1, starts), side="right") - 1
    owner = first.copy()
    crossing = last > first
    stops = np.append(sections[1:], length)
    two = np.flatnonzero(last == first + 1)
    middle = stops[first[two]]
    owner[two] += ends[two] - middle > middle - starts[two]
    for t in np.flatnonzero(last > first + 1).tolist():
        held = [min(ends[t], stops[s]) - max(starts[t], sections[s]) for s in range(first[t], last[t] + 1)]
        owner[t] = first[t] + int(np.argmax(held))
    return owner, crossing


class Coder:
    """A byte-level vocabulary, its units, and the library's own tokenizer."""

    def __init__(self, path: str):
        self.path, self.side = path, Side(*byte_coder(path))
        self.known = Units(self.side)

    @functools.cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer
        found = Tokenizer.from_file(self.path)
        found.encode_special_tokens = True
        return found


@functools.lru_cache(maxsize=1)
def units(path: str) -> Coder:
    return Coder(path)


def spans(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per text, the bounds of the texts and the spans of all tokens, in
    characters of all texts laid end to end (none of them null). A token that holds
    part of a character's bytes spans that character."""
    coder = units(path)
    found, owner = coder.known.find(texts)
    ids, sizes = coder.side.tokens(found)
    width = coder.side.width[ids]
    ends = np.cumsum(width)
    body, bounds = at.raw(texts)
    chars = np.concatenate(([0], np.cumsum((body & 0xC0) != 0x80)))  # begun before each byte
    n_tokens = at.per_text(np.ones(len(ids), np.int64), np.concatenate(([0], np.cumsum(np.bincount(
        owner, weights=sizes, minlength=len(texts)).astype(np.int64)))))
    return n_tokens, chars[bounds], chars[ends - width + 1] - 1, chars[ends]


def token_spans(texts: list[str], path: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Character spans of all tokens of each text."""
    n_tokens, bounds, starts, ends = spans(pa.array(texts, pa.string()), path)
    upto = np.concatenate(([0], np.cumsum(n_tokens)))
    return [(starts[a:b] - base, ends[a:b] - base) for a, b, base in zip(upto, upto[1:], bounds)]


def count(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per section: doc_id, section, start, length, n_tokens,
    n_crossing (of these, tokens that cross a boundary), doc_tokens."""
    path = vocabulary or default_vocabulary()
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in at.slices(batch, most=SLICE):
                texts = at.strings(part.column("text"))
                n_tokens, bounds, starts, ends = spans(texts, path)
                each = [section_starts(t) for t in texts.to_pylist()]
                rows = np.array([len(x) for x in each])
                begin = np.concatenate(each)
                whole = begin + np.repeat(bounds[:-1], rows)
                owner, crossing = attributed(starts, ends, whole, bounds[-1])
                n = len(whole)
                columns = (np.arange(n) - np.repeat(np.cumsum(rows) - rows, rows), begin, np.diff(np.append(whole, bounds[-1])),
                           np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n), np.repeat(n_tokens, rows))
                owners = part.column("doc_id").take(pa.array(np.repeat(np.arange(len(texts)), rows)))
                yield pa.RecordBatch.from_arrays(
                    [owners.cast(kind), *[pa.array(c.astype(np.int64)) for c in columns]],
                    names=["doc_id", "section", "start", "length", "n_tokens", "n_crossing", "doc_tokens"])

    return used.mapInArrow(run, f"doc_id {dict(used.dtypes)['doc_id']}, section long, start long, length long, "
                                "n_tokens long, n_crossing long, doc_tokens long")
