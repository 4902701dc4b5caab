"""Texts of an Arrow batch as numpy arrays: words, bytes, bounded slices.

Words are runs of characters other than the six ASCII spaces (x20, x09-x0D).
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 6 << 20


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text each; a
    longer text is a part of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def strings(column: pa.Array) -> pa.Array:
    """Null texts become empty ones; offsets start at 0."""
    filled = pc.fill_null(column.cast(pa.string()), "")
    return pa.concat_arrays([filled]) if filled.offset == 0 else pa.array(filled.take(pa.array(
        np.arange(len(filled)))))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the bounds of each text in them."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4)
    data = texts.buffers()[2]
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[bounds[0]:bounds[-1]], (bounds - bounds[0]).astype(np.int64)


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` within each text."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def word_lists(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Bounds of each text in the flat array of all words, and that array."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)))
    some = pc.greater(pc.binary_length(flat), 0)
    flags = some.to_numpy(zero_copy_only=False)
    if flags.all():
        return full, flat
    kept = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return kept[full], flat.filter(some)


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Bounds, one integer per word, and the distinct words they stand for."""
    bounds, flat = word_lists(texts)
    coded = flat.dictionary_encode()
    return bounds, coded.indices.to_numpy(zero_copy_only=False), coded.dictionary


def table(used: list[str]) -> np.ndarray:
    """Byte table that is True at the given ASCII characters."""
    out = np.zeros(256, bool)
    out[[ord(c) for c in used]] = True
    return out


SPACES = table(list(" \t\n\x0b\x0c\r"))


def word_counts(texts: pa.Array) -> np.ndarray:
    """Words per text, from the bytes alone."""
    body, bounds = raw(texts)
    space = SPACES[body]
    first = np.empty(len(body), bool)
    if len(body):
        first[0] = True
        first[1:] = space[:-1]
        starts = bounds[:-1]
        first[starts[starts < len(body)]] = True
    return per_text(first & ~space, bounds)
