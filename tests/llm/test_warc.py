import base64
import gzip
import hashlib
import io
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scrivel.llm import warc
from scrivel.llm.archives import BrokenArchive, Span, ZipReader
from scrivel.llm.landing import new_path
from scrivel.llm.warc import archive_ranges, payload_records, read_records, read_warc, with_payloads, write_warc

SCHEMA = "page_id long, url string, html string"


class _Forward(io.RawIOBase):
    """A stream that cannot go back, as those of file stores."""

    def __init__(self):
        self.data = bytearray()

    def writable(self):
        return True

    def write(self, data):
        self.data += data
        return len(data)


def _zip(members, comment=b"", wide=False, out=None, method=zipfile.ZIP_STORED):
    out = out or io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        z.comment = comment
        for name, data in members:
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=wide) as f:
                f.write(data)
    return bytes(out.data) if isinstance(out, _Forward) else out.getvalue()


def _reader(data):
    return ZipReader(pa.BufferReader(data))


@pytest.mark.parametrize("wide", [False, True])
@pytest.mark.parametrize("front", [b"", b"#!/bin/sh\nPK\5\6 not the end\n"])
@pytest.mark.parametrize("comment", [b"", b"PK\5\6 within a comment", b"c" * 65535])
def test_members_are_found_in_place(wide, front, comment):
    members = [("a.txt", b"first"), ("dir/b.bin", bytes(range(256)) * 40), ("漢.txt", b"")]
    for out in (None, _Forward()):
        data = front + _zip(members, comment, wide, out)
        reader = _reader(data)
        assert list(reader.members) == [name for name, _ in members]
        for name, content in members:
            at, size = reader.place(name)
            assert data[at : at + size] == content


def test_more_members_than_the_plain_form_counts():
    data = _zip([(f"m{i}", str(i).encode()) for i in range(66_000)])
    for shifted in (data, b"front" + data):
        reader = _reader(shifted)
        assert len(reader.members) == 66_000
        at, size = reader.place("m65999")
        assert shifted[at : at + size] == b"65999"


def test_broken_and_packed_archives():
    with pytest.raises(BrokenArchive, match="end"):
        _reader(b"PK\3\4 no directory")
    with pytest.raises(BrokenArchive):
        _reader(b"")
    data = _zip([("a.warc", b"x" * 100)], method=zipfile.ZIP_STORED)
    with pytest.raises(BrokenArchive):
        _reader(data[40:])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a.warc", b"x" * 100)
    with pytest.raises(BrokenArchive, match="packed"):
        _reader(out.getvalue()).place("a.warc")


def _record(name, payload, url="http://a.example/"):
    row = {"id": name, "url": url, "record_type": "response", "refers_to": None, "size": len(payload), "payload": payload}
    return warc.record_bytes(row | {"sha1": hashlib.sha1(payload).hexdigest()}, "2024-01-01T00:00:00Z")


@pytest.mark.parametrize("packed", [False, True])
def test_members_without_an_index(packed):
    records = [_record(str(i), b"p" * i) for i in range(5)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    name, data = ("x.warc.gz", b"".join(map(gzip.compress, [info, *records]))) if packed else ("x.warc", b"".join([info, *records]))
    file = pa.BufferReader(_zip([("readme.txt", b"no"), (name, data)]))
    ranges = list(archive_ranges(file))
    assert [(p, n) for p, _, n in ranges] == [(packed, len(data))]
    stream = io.BufferedReader(Span(file, *ranges[0][1:]))
    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if packed else stream
    assert [(r["id"], r["payload"]) for r in read_records(stream)] == [(str(i), b"p" * i) for i in range(5)]


def test_a_payload_that_differs_from_its_digest():
    broken = _record("1", b"good").replace(b"good", b"evil")
    with pytest.raises(ValueError, match="digest"):
        list(read_records(io.BufferedReader(io.BytesIO(broken))))
    with pytest.raises(ValueError, match="no WARC record"):
        list(read_records(io.BufferedReader(io.BytesIO(b"HTTP/1.1 200 OK\r\n\r\n"))))


def _pages():
    rng = random.Random(5)
    rows = [(i, f"http://s{i % 7}.example/p?q={i}", f"<p>{rng.random()}</p>" * rng.choice([1, 30])) for i in range(60)]
    rows += [(60 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(40)]  # copies under other ids
    rows += [rows[5]] * 9 + [rows[70]] * 3  # the same rows again
    rows += [(None, "http://n.example", rows[1][2]), (None, None, "only without id"), (None, None, "only without id")]
    rows += [(200, None, None), (201, "bad url\r\nWARC-Type: x", ""), (202, "http://[bad", "ünï 漢 🙂"), (-3, "u", "ünï 漢 🙂")]
    rng.shuffle(rows)
    return rows


def _expected(rows, least=0):
    first, out = {}, []
    for name, _, html in rows:
        key = (name is None, name or 0)
        first[html or ""] = min(first.get(html or "", key), key)
    taken = set()
    for name, _, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        html = html or ""
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        if len(data) < least or html not in taken:
            out.append((name, len(data), digest, "response", None))
        else:
            out.append((name, len(data), digest, "revisit", None if first[html][0] else first[html][1]))
        taken.add(html)
    return sorted(out, key=repr)


def _read(records):
    columns = F.col("id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")
    return sorted((tuple(r) for r in records.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("least", [0, 40])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_pages_come_back(spark, least, threshold, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    monkeypatch.setattr(warc, "RANGE_BYTES", 700)
    monkeypatch.setattr(warc, "COPIES", 2)
    rows = _pages()
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("id", F.lit(7))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        manifest = write_warc(payload_records(pages, least_bytes=least), new_path(spark, "warc"), "2024-01-01T00:00:00Z")
        records = read_warc(manifest)
        assert _read(records) == _expected(rows, least)
        assert manifest.agg(F.sum("n_records")).first()[0] == len(rows)
        whole = with_payloads(records).select(F.col("id").cast("long"), "payload").collect()
        assert sorted(((r[0], bytes(r[1]).decode()) for r in whole), key=repr) == sorted(((r[0], r[2] or "") for r in rows), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_urls_stay(spark):
    rows = [(1, "http://a.example/x y", "p"), (2, None, "q"), (3, "a\r\nb", "r")]
    manifest = write_warc(payload_records(spark.createDataFrame(rows, SCHEMA)), new_path(spark, "warc"))
    urls = {r["id"]: r["url"] for r in read_warc(manifest).collect()}
    assert urls == {"1": "http://a.example/x%20y", "2": None, "3": "a%0D%0Ab"}


def test_no_pages(spark):
    manifest = write_warc(payload_records(spark.createDataFrame([], SCHEMA)), new_path(spark, "warc"))
    assert manifest.count() == 0
    assert read_warc(manifest).collect() == []
