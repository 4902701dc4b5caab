"""Sum-of-squares online packing of token sequences.

A window holds at most ``size`` tokens. Documents come one after another; a
document's full windows are cut off first, and the rest is placed whole into
the fill level (or a new window) for which the sum over levels of the squared
number of windows at that level is smallest afterwards. A level array keeps
these numbers, so a placement is one vector operation. Windows that reach
``size`` are written. No more than ``most_open`` are open: where a new one would be
too many, a piece goes to the best level there is, and if it fits none, what a
window of the commonest level lacks is cut off from it, which takes most from the
sum. At the end of a partition the emptiest windows are taken back one by one and
their pieces placed again in the same way, until all others are full; the tokens
that are left go into windows of powers of two, which need no padding.

Each partition of the input packs its own documents where they are read:
nothing is shuffled, memory holds one slice of text and the open windows, and a
task that is run again gives the same rows.

Defined cases: null and empty texts are the end id alone; other columns are
ignored; repeated rows are packed each; an empty table gives an empty result.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import arrow_text as at, tokens

SIZE = 4096
OPEN = 4096
FAR = np.iinfo(np.int64).max


class Packer:
    """Open windows by fill level. A piece is (document row, start, ids)."""

    def __init__(self, size: int = SIZE, most_open: int = OPEN):
        self.size, self.most_open = size, most_open
        self.counts = np.zeros(size + 1, np.int64)
        self.windows: dict[int, list[list]] = {}
        self.open = 0
        self.done: list[list] = []
        self.placed_again = 0

    def level_for(self, n: int, new: bool = True) -> int:
        """Fill level that takes n tokens at the least sum of squares. 0: a new window,
        or, where ``new`` ones are not allowed, no level has room."""
        counts, size = self.counts, self.size
        here, after = counts[1:size - n + 1], counts[n + 1:size + 1]
        if not len(here):
            return 0
        change = 2 * (after - here) + 2
        change[-1] = 1 - 2 * int(here[-1])  # a full window leaves the sum
        change[here == 0] = FAR
        best = int(change.argmin())
        return best + 1 if change[best] <= (2 * int(counts[n]) + 1 if new else FAR - 1) else 0

    def add(self, piece: tuple, new: bool = True) -> None:
        row, start, ids = piece
        while len(ids):
            more = new and self.open < self.most_open
            level = self.level_for(len(ids), more)
            if not level and self.open and not more and len(ids) < self.size:
                level = int(self.counts.argmax())
            n = min(len(ids), self.size - level)
            self._put((row, start, ids[:n]), level)
            start, ids = start + n, ids[n:]

    def _take(self, level: int) -> list:
        self.counts[level] -= 1
        self.open -= 1
        return self.windows[level].pop()

    def _put(self, piece: tuple, level: int) -> None:
        """The piece into a window of the level; 0: into a new one."""
        window = self._take(level) if level else []
        window.append(piece)
        filled = level + len(piece[2])
        if filled == self.size:
            self.done.append(window)
            return
        self.windows.setdefault(filled, []).append(window)
        self.counts[filled] += 1
        self.open += 1

    def document(self, row, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.size):
            self.add((row, start, ids[start:start + self.size]))

    def close(self) -> None:
        """Fill all open windows without padding. ``placed_again`` counts the tokens moved."""
        while self.open:
            window = self._take(int(self.counts.nonzero()[0][0]))
            if not self.open:
                self.done.extend(self._powers(window))
                return
            for piece in window:
                self.placed_again += len(piece[2])
                self.add(piece, new=False)

    def _powers(self, window: list) -> Iterator[list]:
        """A window cut where the powers of two in its length end, the largest first."""
        left = sum(len(p[2]) for p in window)
        part: list = []
        room = 1 << left.bit_length() - 1
        for row, start, ids in window:
            while len(ids):
                n = min(len(ids), room)
                part.append((row, start, ids[:n]))
                start, ids, room, left = start + n, ids[n:], room - n, left - n
                if not room:
                    yield part
                    part, room = [], 1 << max(left.bit_length() - 1, 0)


def pack(docs: DataFrame, vocabulary: str | None = None, size: int = SIZE, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and with ``with_ids`` the ids as little-endian bytes."""
    path = vocabulary or tokens.default_vocabulary()
    used = docs.select("doc_id", "text")
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, coder = Packer(size), tokens.coder(path)
        first = TaskContext.get().partitionId() << 40
        count = 0
        kind = None

        def rows() -> Iterator[pa.RecordBatch]:
            nonlocal count
            ids_of, out, blobs = [], [], []
            for window in packer.done:
                offset = 0
                for (doc, total), start, ids in window:
                    data = ids.astype("<u4").tobytes()
                    ids_of.append(doc)
                    out.append((start, len(ids), zlib.crc32(data), total, first + count, offset))
                    blobs.append(data if with_ids else None)
                    offset += len(ids)
                count += 1
            packer.done = []
            if out:
                columns = [pa.array(ids_of, kind), *[pa.array(c, pa.int64()) for c in zip(*out)]]
                if with_ids:
                    columns.append(pa.array(blobs, pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, *["ids"] * with_ids])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in at.slices(batch, most=10 << 20):
                bounds, ids = coder.ids(at.strings(part.column("text")))
                ends = bounds.tolist()
                for doc, a, b in zip(part.column("doc_id").to_pylist(), ends, ends[1:]):
                    # Copies, so that an open window does not hold the whole slice.
                    packer.document((doc, b - a), ids[a:b].copy())
                yield from rows()
        packer.close()
        yield from rows()

    schema = f"doc_id {dict(used.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in names)
    return used.mapInArrow(run, schema + ", ids binary" * with_ids)
