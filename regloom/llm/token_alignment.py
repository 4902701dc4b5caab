"""Alignment of two tokenizers' tokens over the bytes of the same texts.

A is a byte-level vocabulary over a space and the text, B a piece vocabulary
over the text, which puts that space itself; so both cover the same bytes. Per
batch of texts, ``pandas.merge_asof`` keyed by document finds for every token's
start the other side's token that covers it. Of two tokens that overlap, the
later start lies in the other, so the union of both directions is all overlaps.
Offsets where tokens of both sides end cut a text into groups.

Neither side joins characters across a boundary between a visible character and
a space (of A the pattern splits there, B has no such piece), so texts are encoded
in units that begin at such spaces, each distinct unit once; a worker keeps up
to ``KEPT_UNITS`` of them and one batch.

``digests`` also needs how many documents of the corpus hold a pair of ids
linked. Texts are handled in blocks of at most ``SLICE`` bytes or one text; a block
sends each of its pairs once, with the documents that hold it, and gets the
corpus' figures back once. So no key has more rows than there are blocks, and
the rows of documents move with their block alone.

Defined cases: null and empty texts, and texts whose bytes one side does not give
back, have no tokens, groups or links; strings of special tokens are plain text;
repeated rows are documents of their own; an empty table gives an empty result;
texts may be of any length; other columns are ignored.
"""
from __future__ import annotations

import functools
import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import arrow_text as at
from .staging import materialize
from .tokens import gather

SLICE = 1 << 20
KEPT_UNITS = 200_000
#: How byte-level vocabularies split texts into words (fixed).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLAIN = r"^[\t-\r\x20-\x7e\x{a1}-\x{24f}\x{2010}-\x{2027}\x{20ac}]*$"
#: White space that A's pattern knows beside the six ASCII spaces.
OTHER_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
VISIBLE = np.zeros(256, bool)
VISIBLE[0x21:0x7f] = True
SEPARATORS = pa.array([",", "|", ";"])


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1
    characters for themselves, the others from U+0100 on in order."""
    shown = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Side:
    """Ids of units by one tokenizer, remembered for the life of a Python worker."""

    def __init__(self, entries: list[bytes], encode):
        self.encode = encode
        self.width = np.array([len(e) for e in entries], np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.letters = np.frombuffer(b"".join(entries), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, units: pa.Array) -> np.ndarray:
        """Encode new units; whether their tokens give their bytes back."""
        coded = self.encode(units)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.int32, int(sizes.sum()))
        self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
        self.sizes = np.concatenate((self.sizes, sizes))
        self.flat = np.concatenate((self.flat, flat))
        body, bounds = at.raw(at.strings(units))
        width, upto = self.width[flat], np.concatenate(([0], np.cumsum(sizes)))
        valid = at.per_text(width, upto) == np.diff(bounds)
        kept = np.repeat(valid, sizes)
        same = self.letters[gather(self.first[flat[kept]], width[kept])] == body[np.repeat(valid, np.diff(bounds))]
        valid[valid] = at.per_text(~same, np.concatenate(([0], np.cumsum(np.diff(bounds)[valid])))) == 0
        return valid

    def tokens(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive units, and how many each unit has."""
        sizes = self.sizes[units]
        return self.flat[gather(self.starts[units], sizes)], sizes


def byte_coder(path: str):
    """Entries of a byte-level vocabulary and a function that encodes units.

    Where ids follow the order of merges, units of characters whose classes every
    Unicode version has alike are coded by ranks, which gives the same ids sooner;
    all others by the vocabulary's own library."""
    import tiktoken
    from tokenizers import Tokenizer
    exact = Tokenizer.from_file(path)
    exact.encode_special_tokens = True
    letters = _byte_letters()
    special = {i for i, t in exact.get_added_tokens_decoder().items() if t.special}
    entries = [bytes(letters[c] for c in exact.id_to_token(i)) for i in range(exact.get_vocab_size())]
    model = json.loads(exact.to_str())
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
    ordered = model["normalizer"] is None and all(
        model["model"]["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(merges))
    by_rank = tiktoken.Encoding("byte-level", pat_str=WORDS, special_tokens={}, mergeable_ranks={
        e: i for i, e in enumerate(entries) if i not in special}).encode_ordinary if ordered else None

    def encode(units: pa.Array) -> list:
        listed = units.to_pylist()
        if by_rank is None:
            return [e.ids for e in exact.encode_batch_fast(listed, add_special_tokens=False)]
        plain = pc.match_substring_regex(units, PLAIN).to_numpy(zero_copy_only=False)
        out = [by_rank(u) if p else None for u, p in zip(listed, plain.tolist())]
        odd = np.flatnonzero(~plain).tolist()
        for i, e in zip(odd, exact.encode_batch_fast([listed[i] for i in odd], add_special_tokens=False)):
            out[i] = e.ids
        return out

    return entries, encode


def piece_coder(path: str):
    """Entries of a piece vocabulary and a function that encodes units, each of
    which begins with the space that the vocabulary puts itself."""
    from sentencepiece import SentencePieceProcessor
    pieces = SentencePieceProcessor(model_file=path)
    entries = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else
               pieces.id_to_piece(i).replace("▁", " ").encode() for i in range(pieces.get_piece_size())]
    return entries, lambda units: pieces.encode([u[1:] for u in units.to_pylist()], num_threads=1)


@dataclass
class Aligned:
    """Tokens of a batch of texts; offsets count the bytes of all its valid texts."""
    n_texts: int
    doc: tuple[np.ndarray, np.ndarray]  # text of each A and each B token
    ids: tuple[np.ndarray, np.ndarray]
    ends: tuple[np.ndarray, np.ndarray]
    cuts: np.ndarray  # ends of groups
    group: tuple[np.ndarray, np.ndarray]
    links: tuple[np.ndarray, np.ndarray]  # overlapping A and B tokens


class Units:
    """Distinct units of texts, coded once by each side and remembered for the life
    of a Python worker."""

    def __init__(self, *sides: Side):
        self.sides = sides
        self.forget()

    def forget(self) -> None:
        self.known, self.valid = pa.array([], pa.string()), np.zeros(0, bool)
        for side in self.sides:
            side.forget()

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Known unit numbers of all texts in order, and the text of each."""
        body, bounds = at.raw(texts)
        sizes = np.diff(bounds)
        cut = np.zeros(len(body), bool)
        plain = ~pc.match_substring_regex(texts, OTHER_SPACE).to_numpy(zero_copy_only=False)
        last = body[:-1]
        cut[1:] = (body[1:] == 0x20) & (VISIBLE[last] | ((last >= 0x80) & np.repeat(plain, sizes)[1:]))
        cut[bounds[1:][sizes > 0] - 1] = False  # alone, a last space would be a unit without text for B
        cut[bounds[:-1][sizes > 0]] = True
        first = np.flatnonzero(cut)
        offsets = np.append(first, len(body)).astype(np.int32)
        coded = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(body)).dictionary_encode()
        if len(self.known) > KEPT_UNITS:
            self.forget()
        words = coded.dictionary
        place = pc.fill_null(pc.index_in(words, self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = place < 0
        if missing.any():
            new = words.filter(pa.array(missing))
            place[missing] = len(self.known) + np.arange(len(new))
            self.valid = np.concatenate((self.valid, np.all([side.add(new) for side in self.sides], axis=0)))
            self.known = pa.concat_arrays([self.known, new])
        return place[coded.indices.to_numpy(zero_copy_only=False)], np.repeat(np.arange(len(sizes)), at.per_text(cut, bounds))


class Aligner:
    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = Side(*byte_coder(byte_path)), Side(*piece_coder(piece_path))
        self.size_a, self.size_b = len(self.a.width), len(self.b.width)
        self.units = Units(self.a, self.b)

    def align(self, texts: pa.Array) -> Aligned:
        """Tokens, groups and links of some texts (none of them null)."""
        spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, ""))
        units, owner = self.units.find(at.strings(spaced))
        broken = np.bincount(owner[~self.units.valid[units]], minlength=len(texts)) > 0
        kept = ~broken[owner]
        units, owner = units[kept], owner[kept]
        doc, ids, starts, ends = [], [], [], []
        for side in (self.a, self.b):
            found, sizes = side.tokens(units)
            width = side.width[found]
            end = np.cumsum(width)
            doc.append(np.repeat(owner, sizes)), ids.append(found), starts.append(end - width), ends.append(end)
        frames = [pd.DataFrame({"at": s, "doc": d, name: np.arange(len(s))}) for s, d, name in zip(starts, doc, "ab")]
        under = pd.merge_asof(frames[0], frames[1], on="at", by="doc")  # the B token at each A token's start
        over = pd.merge_asof(frames[1], frames[0], on="at", by="doc")
        a, b = over["a"].to_numpy(np.int64), over["b"].to_numpy(np.int64)
        inside = starts[0][a] < starts[1][b]  # equal starts are in the other direction already
        links = (np.concatenate((under["a"].to_numpy(np.int64), a[inside])),
                 np.concatenate((under["b"].to_numpy(np.int64), b[inside])))
        ending = np.zeros((2, int(ends[0][-1]) + 1 if len(ends[0]) else 1), bool)
        ending[0, ends[0]] = ending[1, ends[1]] = True
        both = ending[0] & ending[1]
        before = np.cumsum(both)  # groups that end at an offset or before it
        return Aligned(len(texts), tuple(doc), tuple(ids), tuple(ends), np.flatnonzero(both),
                       tuple(before[e - 1] for e in ends), links)


@functools.lru_cache(maxsize=1)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


@functools.lru_cache(maxsize=1)
def _decimals(n: int) -> pa.Array:
    return pc.cast(pa.array(np.arange(n)), pa.string())


def _last_tokens(group: np.ndarray) -> np.ndarray:
    """Place of the last token of each group."""
    return np.cumsum(np.bincount(group)) - 1 if len(group) else group


def group_texts(found: Aligned, size: int) -> list[bytes]:
    """Per text its groups as ``a1,a2|b1;a3|b2,b3``, ids in order; ids are below ``size``."""
    (ids_a, ids_b), (group_a, group_b) = found.ids, found.group
    upto_a, upto_b = (np.cumsum(np.bincount(g, minlength=len(found.cuts))) for g in found.group)
    place_a = np.arange(len(ids_a)) + np.concatenate(([0], upto_b))[group_a]
    place_b = np.arange(len(ids_b)) + upto_a[group_b]
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int32), np.zeros(len(ids_a) + len(ids_b), np.int8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark[place_a[upto_a - 1]], mark[place_b[upto_b - 1]] = 1, 2
    parts = pc.binary_join_element_wise(_decimals(size).take(pa.array(ids)), SEPARATORS.take(pa.array(mark)), "")
    body, bounds = at.raw(at.strings(parts))
    upto = np.cumsum(sum(np.bincount(d, minlength=found.n_texts) for d in found.doc))
    stops = bounds[np.concatenate(([0], upto))]
    view = memoryview(body.tobytes())
    return [bytes(view[s:max(e - 1, s)]) for s, e in zip(stops[:-1].tolist(), stops[1:].tolist())]


def groups(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """One row per group: doc_id, group, start and stop in the bytes of the space
    and the text, a_ids, b_ids."""
    paths = vocabularies or default_vocabularies()
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.slices(batch, most=SLICE):
                found = aligner(*paths).align(at.strings(part.column("text")))
                owner = found.doc[0][_last_tokens(found.group[0])]
                opens = np.concatenate(([True], owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, bool)
                starts = np.concatenate(([0], found.cuts[:-1])) if len(owner) else found.cuts
                base = np.repeat(starts[opens], np.diff(np.append(np.flatnonzero(opens), len(owner))))
                first = np.repeat(np.flatnonzero(opens), np.diff(np.append(np.flatnonzero(opens), len(owner))))
                lists = [pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(np.bincount(g, minlength=len(owner))))).astype(np.int32),
                                                  pa.array(i)) for g, i in zip(found.group, found.ids)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(owner)), pa.array(np.arange(len(owner)) - first),
                     pa.array(starts - base), pa.array(found.cuts - base), *lists],
                    names=["doc_id", "group", "start", "stop", "a_ids", "b_ids"])

    return used.mapInArrow(run, f"doc_id {dict(used.dtypes)['doc_id']}, group long, start long, stop long, "
                                "a_ids array<int>, b_ids array<int>")


def aligned(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, its
    block, its distinct linked pairs as places in the block's list with their
    numbers of links, and in one row of each block that list (a_id * size of B +
    b_id, rising) with the documents that hold each pair."""
    paths = vocabularies or default_vocabularies()
    used = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in at.slices(batch, most=SLICE):
                both = aligner(*paths)
                found = both.align(at.strings(part.column("text")))
                n, count = found.n_texts, lambda x: pa.array(np.bincount(x, minlength=found.n_texts).astype(np.int64))
                (a, b), owner = found.links, found.doc[0]
                codes = found.ids[0][a].astype(np.int64) * both.size_b + found.ids[1][b]
                pairs, place = np.unique(codes, return_inverse=True)
                held, times = np.unique(owner[a] * max(len(pairs), 1) + place, return_counts=True)
                whose, where = np.divmod(held, max(len(pairs), 1))
                offsets = np.searchsorted(whose, np.arange(n + 1)).astype(np.int32)
                once = np.zeros(n, bool)
                once[:1] = True
                listed = [pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.full(n, len(pairs)))).astype(np.int32)),
                                                   pa.array(v.astype(np.int64))) for v in (pairs, np.bincount(where, minlength=len(pairs)))]
                digest = [hashlib.sha256(t).hexdigest() if t else "" for t in group_texts(
                    found, max(both.size_a, both.size_b))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(kind), *[count(d) for d in found.doc],
                     count(owner[_last_tokens(found.group[0])]), count(owner[a]), pa.array(digest, pa.string()),
                     pa.array(np.full(n, number, np.int64)),
                     *[pa.ListArray.from_arrays(pa.array(offsets), pa.array(v.astype(np.int32))) for v in (where, times)],
                     *[pc.if_else(pa.array(once), v, None) for v in listed]],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "block", "held", "times",
                           "block_pairs", "block_docs"])
                number += 1

    return used.mapInArrow(run, f"doc_id {dict(used.dtypes)['doc_id']}, n_a long, n_b long, n_groups long, n_links long, "
                                "groups_sha256 string, block long, held array<int>, times array<int>, "
                                "block_pairs array<long>, block_docs array<long>")


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """pair, docs of the corpus that hold it linked, and whether no other pair of its
    A id is held by more, from the rows of ``aligned``."""
    counts = _block_pairs(found).groupBy("pair").agg(F.sum("docs").alias("docs"))
    most = F.max("docs").over(Window.partitionBy(F.floor(F.col("pair") / size_b)))  # at most size_b rows
    return counts.select("pair", "docs", (F.col("docs") == most).alias("best"))


def _block_pairs(found: DataFrame) -> DataFrame:
    rows = found.filter(F.col("block_pairs").isNotNull()).select(
        "block", F.explode(F.arrays_zip(F.col("block_pairs").alias("pair"), F.col("block_docs").alias("docs"))).alias("x"))
    return rows.select(F.col("block").alias("home"), "x.pair", "x.docs")


def digests(docs: DataFrame, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair is
    one of its A id's most held), count_sum (holding documents over all links) and
    groups_sha256."""
    from sentencepiece import SentencePieceProcessor
    paths = vocabularies or default_vocabularies()
    size_b = SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    found = materialize(aligned(docs, paths), "alignment")
    known = _block_pairs(found).drop("docs").join(pair_counts(found, size_b), "pair").select(
        "home", "pair", F.col("docs").alias("count"), "best")
    rows = found.drop("block_pairs", "block_docs")
    kept = [c for c in rows.columns if c not in ("block", "held", "times", "groups_sha256")]
    kinds = dict(rows.dtypes)

    def score(held: pd.DataFrame, figures: pd.DataFrame) -> pd.DataFrame:
        """The block's figures in the order of its own list, summed per document."""
        figures = figures.sort_values("pair")
        count, best = figures["count"].to_numpy(np.int64), figures["best"].to_numpy(np.int64)
        out = held[kept].copy()
        sizes = held["held"].map(len).to_numpy(np.int64)
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        where, times = (np.concatenate([np.zeros(0, np.int64), *held[c]]).astype(np.int64) for c in ("held", "times"))
        for name, figure in (("n_best", best), ("count_sum", count)):
            sums = np.concatenate(([0], np.cumsum(figure[where] * times)))
            out[name] = sums[bounds[1:]] - sums[bounds[:-1]]
        out["groups_sha256"] = held["groups_sha256"]
        return out

    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(known.groupBy("home")).applyInPandas(score, schema)
