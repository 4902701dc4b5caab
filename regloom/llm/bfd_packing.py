"""Best-fit-decreasing packing into binary token matrices.

Documents are encoded where they are read. A document longer than a row is
split into whole rows and a rest; every id lies in exactly one segment. The
rests of a block of about ``BLOCK_TOKENS`` tokens are sorted by length and each
goes to the open row with the least room that takes it, found by a segment tree
over room sizes. Rows are written as id matrices (little-endian, one unsigned
type wide enough for the vocabulary), each block one file below the shared
folder, with its cumulative segment lengths and position resets beside it.

Each task writes files of its own name and returns what it wrote, so a repeated
task leaves no half files in use. Memory holds one block.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed each; other columns are ignored; an empty table writes nothing and gives
an empty result.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import arrow_text as at, tokens
from .staging import materialize, new_folder
from .warc_zip import file_system

ROW = 2048
BLOCK_TOKENS = 1 << 22
PAD = 0


class Rooms:
    """Numbers of open rows by room, with the least room of at least n found in
    a binary tree of sums."""

    def __init__(self, most: int):
        self.width = 1 << most.bit_length()
        self.sums = [0] * (2 * self.width)

    def add(self, room: int, by: int) -> None:
        i = room + self.width
        while i:
            self.sums[i] += by
            i >>= 1

    def least(self, n: int) -> int | None:
        """Smallest room >= n that a row has."""
        i = n + self.width
        if self.sums[i]:
            return n
        while i > 1:
            if not i & 1 and self.sums[i + 1]:  # the right neighbour holds larger rooms only
                i += 1
                while i < self.width:
                    i = 2 * i if self.sums[2 * i] else 2 * i + 1
                return i - self.width
            i >>= 1
        return None


def best_fit(sizes: list[int], row: int = ROW) -> list[list[int]]:
    """Rows as lists of item numbers; items in decreasing size, ties in order."""
    rooms, rows = Rooms(row), []
    open_: dict[int, list[int]] = {}
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        n = sizes[item]
        room = rooms.least(n) if n < row else None
        if room is None:
            rows.append([item])
            r, room = len(rows) - 1, row
        else:
            r = open_[room].pop()
            rooms.add(room, -1)
            rows[r].append(item)
        if room > n:
            open_.setdefault(room - n, []).append(r)
            rooms.add(room - n, 1)
    return rows


def pack(docs: DataFrame, folder: str, vocabulary: str | None = None, row: int = ROW,
         block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the matrices below a folder; one row per segment: doc_id, start,
    length, file, row, offset, ids_crc32."""
    path = vocabulary or tokens.default_vocabulary()
    used = docs.select("doc_id", "text")
    schema = (f"doc_id {dict(used.dtypes)['doc_id']}, start long, length long, file string, row long, offset long, "
              "ids_crc32 long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, coder = TaskContext.get(), tokens.coder(path)
        kind = np.dtype(coder.dtype).newbyteorder("<")
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        system, base = file_system(name)
        held: list[tuple] = []
        total = count = 0
        doc_type = None

        def block() -> pa.RecordBatch:
            pieces = [(doc, start, ids[start:start + row]) for doc, ids in held for start in range(0, len(ids), row)]
            rows = best_fit([len(p[2]) for p in pieces], row)
            matrix = np.full((len(rows), row), PAD, kind)
            lengths, out, docs_ = [], [], []
            for r, items in enumerate(rows):
                offset = 0
                for doc, start, ids in (pieces[i] for i in items):
                    matrix[r, offset:offset + len(ids)] = ids
                    docs_.append(doc)
                    out.append((start, len(ids), f"{name}-{count}", r, offset, zlib.crc32(ids.astype("<u4").tobytes())))
                    offset += len(ids)
                lengths.append([len(pieces[i][2]) for i in items])
            ends = np.cumsum([n for r in lengths for n in r])
            places = np.concatenate(([0], np.cumsum([len(r) for r in lengths])))
            # Flat places, in the matrix, at which positions start again from 0.
            resets = np.array([r * row + sum(ns[:k]) for r, ns in enumerate(lengths) for k in range(len(ns))], np.int64)
            system.create_dir(base.rpartition("/")[0], recursive=True)
            for end, array in ((".ids", matrix), (".cu_seqlens", np.concatenate(([0], ends)).astype("<i8")),
                               (".row_segments", places.astype("<i8")), (".resets", resets.astype("<i8"))):
                with system.open_output_stream(f"{base}-{count}{end}") as f:
                    f.write(array.tobytes())
            numbers = [pa.array(c, pa.string() if k == 2 else pa.int64()) for k, c in enumerate(zip(*out))]
            return pa.RecordBatch.from_arrays([pa.array(docs_, doc_type), *numbers], names=[
                "doc_id", "start", "length", "file", "row", "offset", "ids_crc32"])

        for batch in batches:
            doc_type = batch.schema.field("doc_id").type
            for part in at.slices(batch, most=10 << 20):
                bounds, ids = coder.ids(at.strings(part.column("text")))
                ends = bounds.tolist()
                for doc, a, b in zip(part.column("doc_id").to_pylist(), ends, ends[1:]):
                    held.append((doc, ids[a:b]))
                    total += b - a
                    if total >= block_tokens:
                        yield block()
                        held, total, count = [], 0, count + 1
        if held:
            yield block()

    return materialize(used.mapInArrow(run, schema), "segments")


def read_rows(segments: DataFrame, row: int = ROW, vocabulary: str | None = None) -> DataFrame:
    """One row per matrix row, from the files: file, row, n_tokens, n_segments,
    cu_seqlens (array), n_resets, ids_crc32 of the row's ids without padding."""
    width = np.dtype(tokens.coder(vocabulary or tokens.default_vocabulary()).dtype).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, base = file_system(name)

                def load(end: str, kind: str) -> np.ndarray:
                    with system.open_input_file(base + end) as f:
                        return np.frombuffer(f.read(), kind)

                matrix = load(".ids", f"<u{width}").reshape(-1, row)
                bounds, places, resets = (load(x, "<i8") for x in (".cu_seqlens", ".row_segments", ".resets"))
                out = []
                for r in range(len(matrix)):
                    a, b = int(places[r]), int(places[r + 1])
                    cu = bounds[a:b + 1] - bounds[a]
                    n = int(cu[-1])
                    inside = resets[a:b] - r * row
                    out.append((name, r, n, b - a, cu.tolist(), int((inside == cu[:-1]).sum()),
                                zlib.crc32(matrix[r, :n].astype("<u4").tobytes())))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[
                    "file", "row", "n_tokens", "n_segments", "cu_seqlens", "n_resets", "ids_crc32"])

    files = segments.select("file").distinct()
    # Names of files are few bytes, so a number is given, which adaptive execution leaves as it is.
    return files.repartition(max(1, files.count()), "file").mapInArrow(run, "file string, row long, n_tokens long, n_segments long, cu_seqlens array<long>, "
                                 "n_resets long, ids_crc32 long")


def round_trip(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Segments of all documents, each with what its row in the files holds."""
    segments = pack(docs, new_folder(spark, "packed"))
    rows = read_rows(segments).withColumnRenamed("ids_crc32", "row_crc32")
    # Spark takes a mapped frame to be as small as its input; these rows grow with the documents.
    return segments.join(rows.hint("merge"), ["file", "row"]).selectExpr(
        "doc_id", "start", "length", "substring_index(file, '/', -1) AS file", "row", "offset", "ids_crc32", "n_tokens",
        "n_segments", "n_resets", "row_crc32")
