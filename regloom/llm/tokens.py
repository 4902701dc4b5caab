"""Token ids of whole texts by a public tokenizer, each distinct word encoded once.

``word_bpe_49k.json`` drops white space and never merges across it, so a text's
ids are those of its white-space separated words in order. A word's trailing
run of ASCII symbols is a pre-token of its own where the character before it is
a plain letter or digit, and is coded apart. All ids come from the tokenizer;
words and their ids are kept from slice to slice of a worker, up to
``KEPT_WORDS`` of them.
"""
from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrow_text as at

KEPT_WORDS = 1_000_000
END_ID = 2
#: A word of plain characters that ends in symbols other than an apostrophe.
HEAD = r"^(?P<head>.*[0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])(?P<tail>[!-&(-/:-@\[-`{-~]+)$"
#: Words whose normal form is their lower case, and that need no care beside the separator.
PLAIN = r"^[!-;=?-}]+$"
SEPARATOR = "~"
CHUNK = 512


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=2)
def coder(path: str) -> "WordCoder":
    return WordCoder(path)


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indexes of consecutive runs [start, start + size)."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


class WordCoder:
    """Ids of words, remembered for the life of a Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers
        self.exact = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.separator = self.plain.encode(SEPARATOR, add_special_tokens=False).ids
        self.dtype = np.uint16 if self.exact.get_vocab_size() <= 1 << 16 else np.uint32
        self.forget()

    def forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.flat = np.zeros(0, self.dtype)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _encode(self, words: pa.Array) -> list[list[int]]:
        """Ids of each word, plain ones many at a time with separators between."""
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        out: list = [None] * len(words)
        listed = words.to_pylist()
        odd = np.flatnonzero(~plain).tolist()
        if len(self.separator) == 1:
            easy = np.flatnonzero(plain).tolist()
            chunks = [easy[i:i + CHUNK] for i in range(0, len(easy), CHUNK)]
            joined = [f" {SEPARATOR} ".join([listed[i] for i in c]) for c in chunks]
            for chunk, found in zip(chunks, self.plain.encode_batch_fast(joined, add_special_tokens=False)):
                ids = np.array(found.ids, np.int64)
                cuts = np.flatnonzero(ids == self.separator[0])
                if len(cuts) != len(chunk) - 1:
                    odd += chunk
                    continue
                for i, part in zip(chunk, np.split(ids, cuts)):
                    out[i] = part
                for i in chunk[1:]:
                    out[i] = out[i][1:]
        else:
            odd = list(range(len(words)))
        for i, found in zip(odd, self.exact.encode_batch_fast([listed[i] for i in odd], add_special_tokens=False)):
            out[i] = found.ids
        return out

    def _places(self, words: pa.Array) -> np.ndarray:
        """Row of each of some distinct words in the tables of known words;
        unknown ones are encoded and become the next rows."""
        if len(self.known) + len(words) > KEPT_WORDS:
            self.forget()
        found = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = found < 0
        if missing.any():
            new = words.filter(pa.array(missing))
            found[missing] = len(self.known) + np.arange(len(new))
            coded = self._encode(new)
            sizes = np.array([len(c) for c in coded], np.int64)
            first = len(self.flat)
            self.starts = np.concatenate((self.starts, first + np.cumsum(sizes) - sizes))
            self.sizes = np.concatenate((self.sizes, sizes))
            self.flat = np.concatenate([self.flat, *[np.asarray(c, self.dtype) for c in coded]])
            self.known = pa.concat_arrays([self.known, new])
        return found

    def ids(self, texts: pa.Array, end: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of each text and all ids, ``end`` appended to each text."""
        bounds, codes, words = at.word_codes(texts)
        halves = pc.extract_regex(words, HEAD)
        whole = pc.or_(halves.is_null(), pc.match_substring(words, "<|"))  # special tokens stay whole
        head = pc.if_else(whole, words, halves.field("head"))
        tail = pc.if_else(whole, "", halves.field("tail"))
        head, tail = pc.ascii_lower(head).dictionary_encode(), tail.dictionary_encode()
        distinct = pa.concat_arrays([head.dictionary, tail.dictionary]).unique()
        place = self._places(distinct)
        a = place[pc.index_in(head.dictionary, distinct).to_numpy(zero_copy_only=False)]
        b = place[pc.index_in(tail.dictionary, distinct).to_numpy(zero_copy_only=False)]
        a, b = (x[y.indices.to_numpy(zero_copy_only=False)] for x, y in ((a, head), (b, tail)))
        both = np.stack((a[codes], b[codes]), axis=1).ravel()
        sizes = self.sizes[both]
        ids = self.flat[gather(self.starts[both], sizes)]
        upto = np.concatenate(([0], np.cumsum(sizes)))[2 * bounds]
        if end is None:
            return upto, ids
        return upto + np.arange(len(upto)), np.insert(ids, upto[1:], end)
