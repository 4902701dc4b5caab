"""WARC records in ZIP packages: written per partition, read by range.

A package is a ZIP file with two stored members, ``archive/data.warc.gz`` (one
gzip member per record) and ``indexes/index.cdx`` (one line per record: id,
offset and length in the archive member). Reading needs no extraction: the end
record, the ZIP64 end record where one is needed, and the central directory
are read from the end of the file; local headers give the place of the stored
bytes; index lines give records, which are read by range in runs of neighbours.

Packages lie in the session's shared folder and are reached through Arrow's
file systems by URI. Every attempt of a task writes files of its own name and
returns what it wrote, so that a repeated task leaves no half files in use.

Of rows with equal payloads (by SHA-1, of any size), the one with the largest
page_id is written as response, the others as revisits of it.

Defined cases: null html is an empty payload; null urls become ``urn:page:``
names; null page_ids come after all others and refer to or are referred to as
null; rows that repeat a page_id with an equal payload have the role of that
page_id each; an empty table writes nothing and gives an empty result; other
columns are ignored.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .staging import materialize, new_folder

#: Compressed bytes after which a package is closed.
PACKAGE_BYTES = 32 << 20
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR, CENTRAL, LOCAL = (b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
#: Bytes between two records of one read.
GAP = 64 << 10
READ = 4 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(uri: str):
    """Arrow file system and path of a URI or a plain path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri if uri.startswith("/") else uri.replace(
        "file:/", "file:///", 1))


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC record: HTTP header, and the payload unless it is a revisit."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = f"urn:page:{page_id}" if url is None else quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Package:
    """Writes one ZIP package to an output stream; the index follows the archive."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.lines: list[str] = []
        self.size = 0

    def add(self, name: str, data: bytes) -> None:
        packed = gzip.compress(data, 6, mtime=0)
        self.member.write(packed)
        self.lines.append(f"{name} {self.size} {len(packed)}\n")
        self.size += len(packed)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.write("".join(self.lines).encode())
        self.zip.close()


class _Sink(io.RawIOBase):
    """What zipfile needs of an unseekable output stream."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        pass


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, html, response_id and is_revisit: who stores each payload."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("_sha", F.sha1(F.encode("html", "UTF-8")))
    groups = rows.groupBy("_sha").agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("response_id"))
    shared = groups.filter("_n > 1").select("_sha", "response_id")
    return (rows.join(shared, "_sha", "left")
            .withColumn("response_id", F.when(F.col("response_id").isNull(), F.col("page_id")).otherwise(F.col("response_id")))
            .withColumn("is_revisit", ~F.col("page_id").eqNullSafe(F.col("response_id"))).drop("_sha"))


def write(pages: DataFrame, folder: str, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Write the pages' records below a folder; (path, records) of the packages
    in use, as a table in the same folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        system, base = file_system(name)
        count, package, stream = 0, None, None
        for batch in batches:
            for row in (r for k in range(0, batch.num_rows, 256) for r in batch.slice(k, 256).to_pylist()):
                if package is None:
                    system.create_dir(base.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(f"{base}-{count}.zip")
                    package = Package(_Sink(stream))
                payload = row["html"].encode("utf-8", "surrogatepass")
                package.add(str(row["page_id"]), record(row["page_id"], row["url"], payload, base32_sha1(payload),
                                                        row["response_id"], row["is_revisit"]))
                if package.size >= package_bytes:
                    package.close()
                    stream.close()
                    yield pa.RecordBatch.from_pydict({"path": [f"{name}-{count}.zip"], "records": [len(package.lines)]})
                    package, count = None, count + 1
        if package is not None:
            package.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{name}-{count}.zip"], "records": [len(package.lines)]})

    return materialize(roles(pages).mapInArrow(run, "path string, records long"), "packages")


def members(file, size: int) -> dict[str, tuple[int, int]]:
    """(offset, length) of the stored members of an open ZIP file, by name."""

    def read(at: int, n: int) -> bytes:
        file.seek(at)
        return file.read(n)

    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = read(tail_at, size - tail_at)
    place = tail.rfind(END)
    while place >= 0 and (len(tail) - place < 22 or place + 22 + struct.unpack_from("<H", tail, place + 20)[0] != len(tail)):
        place = tail.rfind(END, 0, place)  # the mark may stand inside the comment
    if place < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, place + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        at = tail_at + place - 20
        mark, _, end64, _ = struct.unpack("<4sIQI", read(at, 20))
        if mark != LOCATOR:
            raise ValueError("no ZIP64 locator")
        end = read(end64, 56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 end record")
        count, length, start = struct.unpack_from("<QQQ", end, 32)
    central, at, found = read(start, length), 0, {}
    for _ in range(count):
        if central[at:at + 4] != CENTRAL:
            raise ValueError("broken central directory")
        method, = struct.unpack_from("<H", central, at + 10)
        packed, whole, names, extras, notes = struct.unpack_from("<IIHHH", central, at + 20)
        offset, = struct.unpack_from("<I", central, at + 42)
        name = central[at + 46:at + 46 + names].decode()
        extra, spot = central[at + 46 + names:at + 46 + names + extras], 0
        while spot + 4 <= len(extra):
            kind, n = struct.unpack_from("<HH", extra, spot)
            if kind == 1:  # the values that did not fit, in this order
                wide = list(struct.unpack_from(f"<{n // 8}Q", extra, spot + 4))
                whole = wide.pop(0) if whole == 0xFFFFFFFF else whole
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                offset = wide.pop(0) if offset == 0xFFFFFFFF else offset
            spot += 4 + n
        if method == 0:
            head = read(offset, 30)
            if head[:4] != LOCAL:
                raise ValueError("broken local header")
            a, b = struct.unpack_from("<HH", head, 26)
            found[name] = (offset + 30 + a + b, whole)
        at += 46 + names + extras + notes
    return found


def ranges(packages: DataFrame) -> DataFrame:
    """(path, start, length, sizes): runs of neighbouring records to read at
    once, from each package's directory and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, base = file_system(path)
                with system.open_input_file(base) as file:
                    found = members(file, file.size())
                    if INDEX not in found or ARCHIVE not in found:
                        raise ValueError(f"{path} holds no stored {ARCHIVE} with its {INDEX}")
                    file.seek(found[INDEX][0])
                    lines = file.read(found[INDEX][1]).decode().splitlines()
                first = found[ARCHIVE][0]
                entries = sorted(tuple(map(int, x.rsplit(" ", 2)[1:])) for x in lines)
                out: list[list] = []
                for at, n in entries:
                    if out and at - (out[-1][0] + out[-1][1]) <= GAP and out[-1][1] + n <= READ:
                        out[-1][2].append([at - out[-1][0], n])
                        out[-1][1] = at + n - out[-1][0]
                    else:
                        out.append([at, n, [[0, n]]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(out)), pa.array([first + r[0] for r in out], pa.int64()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([[x for e in r[2] for x in e] for r in out], pa.list_(pa.int64()))],
                    names=["path", "start", "length", "places"])

    return packages.select("path").repartition(_tasks(packages), "path").mapInArrow(
        run, "path string, start long, length long, places array<long>")


def _tasks(packages: DataFrame) -> int:
    """A number of partitions that adaptive execution leaves as it is: rows that name
    packages and ranges are few bytes, what is read for them is not."""
    return max(1, packages.count())


def parsed(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC header, HTTP header and payload of an unpacked record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:]), payload


def read(packages: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to, and with ``with_payload`` the payload (null for revisits). The
    digest and size of a response are those of the bytes read."""

    def number(name: str | None) -> int | None:
        text = None if name is None else name.removeprefix("<urn:page:").removesuffix(">")
        return None if text in (None, "None") else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, length, places in zip(*[c.to_pylist() for c in batch.columns]):
                system, base = file_system(path)
                with system.open_input_file(base) as file:
                    file.seek(start)
                    data = file.read(length)
                rows: list[tuple] = []
                for at, n in zip(places[::2], places[1::2]):
                    fields, http, payload = parsed(zlib.decompress(data[at:at + n], 31))
                    revisit = fields["WARC-Type"] == "revisit"
                    rows.append((
                        number(fields["WARC-Record-ID"]), int(http["Content-Length"]) if revisit else len(payload),
                        fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32_sha1(payload),
                        fields["WARC-Type"], number(fields.get("WARC-Refers-To")), None if revisit else payload))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                used = 6 if with_payload else 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows))[:used], kinds)],
                                                 names=names[:used])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    found = ranges(packages).select("path", "start", "length", "places").repartition(2 * _tasks(packages), "path", "start")
    return found.mapInArrow(run, schema + ", payload binary" * with_payload)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages, then read every record back."""
    return read(write(pages, new_folder(spark, "warc")))
