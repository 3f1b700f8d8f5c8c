"""Web pages as WARC records in ZIP files, and back.

A task writes ZIP files that hold one member of records, each packed on its own, and one index with a line for each record; both are
stored, so the records of an index are ranges of the ZIP file. Readers parse the directory, take the places of all records from the
index, and deal ranges of neighbouring records out to tasks, which read them in place. A payload that occurs
again is written once; its other records refer to that one.

Files are written under names that no other attempt uses; the manifest, a table that Spark commits, names those that count.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import UTC, datetime
from urllib.parse import quote, unquote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrivel.llm.archives import Span, ZipReader
from scrivel.llm.landing import landed
from scrivel.llm.token_files import _opened, qualified

#: Packed bytes after which a task begins another file, and of the records that are read by a task at once.
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
#: Copies of one row that a task writes out at once.
COPIES = 100_000
_FLUSH_BYTES = 8 << 20

# Fixed values of the format.
RESPONSE, REVISIT = "response", "revisit"
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATA, _INDEX = "archive/data.warc.gz", "indexes/index.cdx"
_ID_SCHEME = "urn:row:"
_CUT = re.compile(r"[\x00-\x20\x7f]")

_MANIFEST = "path string, n_records long, n_bytes long"
_RANGES = "path string, packed boolean, offset long, length long"
_RECORDS = (
    "id string, url string, record_type string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def payload_records(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0
) -> DataFrame:
    """Rows ``id, url, record_type, refers_to, sha1, size, payload``: what is to be written for each page.

    Of rows with equal payloads of ``least_bytes`` at least, one is a response and the others are revisits that refer to it and carry no payload: the one of the smallest id, then the
    smallest url; among rows alike in all three any one is. Null ids come last, null urls first, a null payload is empty.
    Smaller payloads are all responses. Repeated ids stay, an empty table gives no rows, other columns are not read.

    Only digests are shuffled. Payloads meet the table of repeated ones where they are, as long as Spark finds it small enough to
    broadcast, and else in a join that adaptive execution can split.
    """
    content = F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b""))
    rows = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url"), content.alias("payload"))
    rows = rows.select("id", "url", "payload", F.length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))
    large = rows.filter(F.col("size") >= least_bytes)
    same = large.groupBy("digest", "id", "url").agg(F.count("*").alias("copies"), F.first("size").alias("size"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "url", "copies")
    found = same.groupBy("digest").agg(F.min(place).alias("first"), F.sum("copies").alias("n"))
    repeated = landed(found.filter("n > 1").select("digest", "first"), "repeated")

    met = rows.join(repeated, (rows["digest"] == repeated["digest"]) & (rows["size"] >= least_bytes), "left").drop(repeated["digest"])
    first = F.col("first").isNotNull() & F.col("id").eqNullSafe(F.col("first.id")) & F.col("url").eqNullSafe(F.col("first.url"))
    several = first & (F.col("first.copies") > 1)
    again = F.col("first").isNotNull() & ~first
    sha1 = F.sha1("payload").alias("sha1")

    def record(again: F.Column) -> list[F.Column]:
        return [
            F.col("id").cast("string").alias("id"),
            "url",
            F.when(again, REVISIT).otherwise(RESPONSE).alias("record_type"),
            F.when(again, F.col("first.id").cast("string")).alias("refers_to"),
            sha1,
            "size",
            F.when(~again, F.col("payload")).alias("payload"),
        ]

    single = met.filter(~F.coalesce(several, F.lit(False))).select(*record(again))
    if repeated.filter("first.copies > 1").isEmpty():
        return single
    # Rows alike in id, url and payload: one with the payload, and as many without as are left.
    alike = met.filter(several).groupBy("digest", "id", "url").agg(F.first("first").alias("first"), F.first("payload").alias("payload"), F.first("size").alias("size"))
    written = landed(alike, "alike")
    steps = F.sequence(F.lit(1).cast("long"), F.col("first.copies") - 1, F.lit(COPIES))
    blocks = written.select("id", "url", "first", "size", sha1, F.explode(steps).alias("low"))
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = F.least(F.col("low") + COPIES - 1, F.col("first.copies") - 1)
    copies = blocks.repartition(parts, "id", "low").withColumn("nth", F.explode(F.sequence("low", last)))
    others = copies.select(
        F.col("id").cast("string").alias("id"),
        "url",
        F.lit(REVISIT).alias("record_type"),
        F.col("first.id").cast("string").alias("refers_to"),
        "sha1",
        "size",
        F.lit(None).cast("binary").alias("payload"),
    )
    return single.unionByName(written.select(*record(F.lit(False)))).unionByName(others)


def _address(id: str | None) -> str:
    return f"<{_ID_SCHEME}{quote(id or '', safe='')}>"


def _id(address: str | None) -> str | None:
    return unquote(address.strip("<>").removeprefix(_ID_SCHEME)) or None if address else None


def _base32(sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1)).decode()


def record_bytes(row: dict, date: str) -> bytes:
    """One record as it stands in an unpacked WARC file."""
    page = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row['size']}\r\n\r\n".encode()
    block = page + (row["payload"] or b"")
    head = [_VERSION, f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {_address(row['id'])}", f"WARC-Date: {date}"]
    if row["url"] is not None:
        head.append(f"WARC-Target-URI: {_CUT.sub(lambda m: quote(m[0], safe=''), row['url'])}")
    if row["record_type"] == REVISIT:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_address(row['refers_to'])}", "WARC-Truncated: length"]
    head += [
        f"WARC-Payload-Digest: sha1:{_base32(row['sha1'])}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _url_key(url: str) -> str:
    """The host's labels from the last to the first, then the rest, so that pages of a site stand together."""
    try:
        parts = urlsplit(url)
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return _CUT.sub("", url)
    rest = parts.path + (f"?{parts.query}" if parts.query else "")
    return _CUT.sub("", f"{host}){rest or '/'}".lower())


class ArchiveWriter:
    """One ZIP file: records as they come, the index when it is closed."""

    def __init__(self, out, date: str):
        self.date, self.lines, self.at = date, [], 0
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(zipfile.ZipInfo(_DATA), "w", force_zip64=True)

    def add(self, row: dict) -> None:
        packed = gzip.compress(record_bytes(row, self.date), 6, mtime=0)
        self.data.write(packed)
        stamp = re.sub(r"\D", "", self.date)
        about = {"url": row["url"], "mime": "warc/revisit" if row["record_type"] == REVISIT else "text/html", "status": "200"}
        about |= {"digest": f"sha1:{_base32(row['sha1'])}", "length": str(len(packed)), "offset": str(self.at)}
        about |= {"filename": _DATA.rpartition("/")[2]}
        self.lines.append(f"{_url_key(row['url'] or '')} {stamp} {json.dumps(about)}\n")
        self.at += len(packed)

    def close(self) -> None:
        self.data.close()
        with self.zip.open(zipfile.ZipInfo(_INDEX), "w", force_zip64=True) as index:
            for line in sorted(self.lines):
                index.write(line.encode())
        self.zip.close()


def write_warc(records: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write the rows of :func:`payload_records` where they are, and give the manifest: ``path``, ``n_records``, ``n_bytes``.

    Every row is a record, in no particular order; no rows give no file. ``date`` is that of all records, by default the present.
    """
    folder = qualified(records.sparkSession, folder)
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, out, path = None, None, ""

        def closed() -> pa.RecordBatch:
            writer.close()
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "n_records": len(writer.lines), "n_bytes": writer.at}])

        for batch in batches:
            for i in range(len(batch)):
                if writer is None:
                    path = f"{folder}/part-{TaskContext.get().partitionId():08d}-{uuid.uuid4().hex}.zip"
                    out = _opened(path, write=True)
                    writer = ArchiveWriter(out, date)
                writer.add(batch.slice(i, 1).to_pylist()[0])
                if writer.at >= FILE_BYTES:
                    yield closed()
                    writer = None
        if writer is not None:
            yield closed()

    return landed(records.mapInArrow(run, _MANIFEST), "manifest")


def _index_places(index: Iterator[bytes]) -> Iterator[tuple[str, int, int]]:
    """File name, offset and length of the records that an index lists."""
    for line in index:
        brace = line.find(b"{")
        if brace >= 0:
            about = json.loads(line[brace:])
            yield about["filename"], int(about["offset"]), int(about["length"])


def archive_ranges(file: pa.NativeFile) -> Iterator[tuple[bool, int, int]]:
    """Ranges of a ZIP file that hold whole records, and whether they are packed; members that no index covers are one range each."""
    archive = ZipReader(file)
    listed: dict[str, list[tuple[int, int]]] = {}
    for name in archive.members:
        if re.search(r"\.cdxj?(\.gz)?$", name):
            stream = io.BufferedReader(Span(file, *archive.place(name)))
            for of, offset, length in _index_places(gzip.GzipFile(fileobj=stream) if name.endswith(".gz") else stream):
                listed.setdefault(of, []).append((offset, length))
    for name in archive.members:
        if not re.search(r"\.warc(\.gz)?$", name):
            continue
        start, size = archive.place(name)
        packed = name.endswith(".gz")
        places = sorted(set(listed.get(name.rpartition("/")[2], [(0, size)])))
        low = high = None
        for offset, length in places:
            if low is not None and (offset != high or high + length - low > RANGE_BYTES):
                yield packed, start + low, high - low
                low = None
            low, high = offset if low is None else low, offset + length
        if low is not None and high > low:
            yield packed, start + low, high - low


def _head(stream) -> tuple[bytes, dict[str, str]]:
    first = stream.readline()
    fields = {}
    while (line := stream.readline().rstrip(b"\r\n")):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return first, fields


def read_records(stream) -> Iterator[dict]:
    """Records one after another, with their payload unpacked from HTTP; only responses hold one."""
    while first := stream.peek(1)[:1]:
        if first in b"\r\n":
            stream.readline()
            continue
        version, fields = _head(stream)
        if not version.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should be: {version[:40]!r}")
        block = stream.read(int(fields["content-length"]))
        kind = fields["warc-type"]
        if kind not in (RESPONSE, REVISIT):
            continue
        inner = io.BytesIO(block)
        _, page = _head(inner)
        payload = inner.read()
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
        if kind == RESPONSE:
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if digest not in (None, own):
                raise ValueError(f"payload of {fields['warc-record-id']} differs from its digest")
            digest = own
        yield {
            "id": _id(fields["warc-record-id"]),
            "url": fields.get("warc-target-uri"),
            "record_type": kind,
            "refers_to": _id(fields.get("warc-refers-to")),
            "payload_digest": digest,
            "payload_bytes": len(payload) if kind == RESPONSE else int(page.get("content-length", 0)),
            "payload": payload if kind == RESPONSE else None,
        }


def read_warc(archives: DataFrame) -> DataFrame:
    """Rows ``id, url, record_type, refers_to, payload_digest, payload_bytes, payload`` of all responses and revisits in the ZIP files
    that the column ``path`` names.

    Digest and bytes are those of the whole payload, revisits have a null payload. Ids are text. A file that is no ZIP file, a
    packed member, or a payload that does not fit its digest fails the job. A file named twice is read twice; no files give no rows.
    """

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _opened(path) as file:
                    found = [{"path": path, "packed": p, "offset": o, "length": n} for p, o, n in archive_ranges(file)]
                if found:
                    yield pa.RecordBatch.from_pylist(found)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("id", "url", "record_type", "refers_to", "payload_digest")
        schema = pa.schema([*((f, pa.string()) for f in fields), ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for row in batch.to_pylist():
                with _opened(row["path"]) as file:
                    stream = io.BufferedReader(Span(file, row["offset"], row["length"]), 1 << 20)
                    if row["packed"]:
                        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
                    held, size = [], 0
                    for record in read_records(stream):
                        held.append(record)
                        size += len(record["payload"] or b"") + 200
                        if size >= _FLUSH_BYTES:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    parts = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = archives.select("path").repartition(parts, "path", F.monotonically_increasing_id())
    # By number, so that ranges of one file stay apart.
    return paths.mapInArrow(ranges, _RANGES).repartition(parts, "path", "offset").mapInArrow(records, _RECORDS)


def with_payloads(records: DataFrame) -> DataFrame:
    """Revisits with the payload of the response that they refer to; records whose response is not there keep a null payload."""
    of = records.filter(F.col("record_type") == RESPONSE).select(
        F.col("id").alias("__id"), F.col("payload_digest").alias("__digest"), F.col("payload").alias("__payload")
    )
    single = landed(of.groupBy("__id", "__digest").agg(F.first("__payload").alias("__payload")), "payloads")
    same = F.col("refers_to").eqNullSafe(F.col("__id")) & (F.col("payload_digest") == F.col("__digest"))
    joined = records.join(single, same & (F.col("record_type") == REVISIT), "left")
    return joined.withColumn("payload", F.coalesce("payload", "__payload")).drop("__id", "__digest", "__payload")
