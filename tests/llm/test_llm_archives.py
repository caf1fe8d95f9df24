"""Operator 5: archives written and read back, and the directory parser on hostile input."""

import gzip
import io
import struct
import zipfile

import pytest

from quayside.llm import warc

PAGES = "page_id long, url string, html string, extra string"


def reader(data):
    return (lambda at, n: data[at:at + n]), len(data)


def zipped(members, comment=b"", force=False, method=zipfile.ZIP_STORED):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, data in members.items():
            with z.open(zipfile.ZipInfo(name) if method == zipfile.ZIP_STORED else name, "w", force_zip64=force) as f:
                f.write(data)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("force", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 not the end", b"x" * 60_000])
def test_directory(force, comment):
    members = {"archive/data.warc.gz": b"d" * 1000, "indexes/index.cdxj": b"", "é.txt": b"1"}
    data = zipped(members, comment, force)
    found = warc.directory(*reader(data))
    assert {m.name: data[m.offset:m.offset + m.size] for m in found} == members


def test_zip64_end_record():
    """An end record whose fields are full sends the reader to the ZIP64 one."""
    data = zipped({"a": b"hello"})
    at = data.rfind(b"PK\x05\x06")
    n, length, start = struct.unpack_from("<H2I", data, at + 10)
    end64 = struct.pack("<4sQ2H2I4Q", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, length, start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, at, 1)
    end = struct.pack("<4s4H2IH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    wide = data[:at] + end64 + locator + end
    (member,) = warc.directory(*reader(wide))
    assert wide[member.offset:member.offset + member.size] == b"hello"
    with pytest.raises(warc.BadArchive):
        warc.directory(*reader(data[:at] + end))


def test_zip64_fields():
    extra = struct.pack("<2HI", 9, 4, 0) + struct.pack("<2H2Q", 1, 16, 5 << 32, 7 << 32)
    full = 0xFFFFFFFF
    assert warc.zip64_fields(extra, 3, full, full) == (3, 5 << 32, 7 << 32)


@pytest.mark.parametrize("data", [b"", b"PK\x05\x06", zipped({"a": b"x" * 500}, method=zipfile.ZIP_DEFLATED),
                                  zipped({"a": b"x"})[:-1]])
def test_bad_archives(data):
    with pytest.raises(warc.BadArchive):
        warc.directory(*reader(data))


def test_records_round_trip():
    for payload in (b"", b"x", b"a\r\n\r\nb" * 50):
        raw = warc.record(7, "http://x/é \r\nEvil: 1", payload, "d", None, False)
        headers, body = warc.parse_record(gzip.decompress(gzip.compress(raw)))
        assert body == payload and headers["page-id"] == "7" and "evil" not in headers
    with pytest.raises(warc.BadArchive):
        warc.parse_record(raw[:-20])


def test_write_and_read(spark):
    same = "<p>" + "same page " * 30
    rows = [(5, "http://a", same, "x"), (3, "http://b", same, None), (9, None, same, None), (1, "u", "short", None),
            (2, "u", "short", None), (4, "http://c", None, None), (6, "http://d", "é" * 50, None), (None, "n", same, None)]
    rows += [(100 + i, f"http://p/{i}", f"page {i} " * 40, None) for i in range(300)]
    pages = spark.createDataFrame(rows, PAGES).repartition(5)
    archives = warc.write_archives(pages, archive_bytes=20_000)
    assert archives.count() > 5 and archives.groupBy().sum("records").first()[0] == len(rows)
    got = {r["page_id"]: r for r in warc.read_archives(archives, block_bytes=2_000).collect()}
    assert len(got) == len(rows)
    for page_id, _, html, _ in rows:
        data = (html or "").encode()
        r = got[page_id]
        assert r["payload_bytes"] == len(data)
        if html == same and page_id != 3:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 3, None)
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, data)
    assert len({got[i]["payload_digest"] for i in (5, 3, 9)}) == 1


def test_no_pages(spark):
    archives = warc.write_archives(spark.createDataFrame([], PAGES))
    assert archives.collect() == [] and warc.read_archives(archives).collect() == []


def test_archive_of_another_writer(spark, tmp_path):
    """Two data members and two indexes with names and fields of their own, ZIP64 entries, HTTP headers."""
    def rec(kind, url, body, more=""):
        return gzip.compress((f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\n{more}"
                              f"Content-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n")

    http = "Content-Type: application/http; msgtype=response\r\n"
    one = [rec("warcinfo", "", b"software: x"), rec("response", "http://a/", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n<p>a</p>", http)]
    two = [rec("response", "http://b/", b"plain", "WARC-Payload-Digest: sha1:ABC\r\n"), rec("request", "http://b/", b"GET /")]
    lines = {"one.warc.gz": [], "archive/two.warc.gz": []}
    for name, records in zip(lines, (one, two)):
        at = 0
        for r in records:
            lines[name].append(f'com,x)/ 2024 {{"offset": "{at}", "length": "{len(r)}", "filename": "{name}"}}')
            at += len(r)
    data = zipped({"archive/one.warc.gz": b"".join(one), "archive/two.warc.gz": b"".join(two),
                   "indexes/a.cdxj": "\n".join(['!meta {"format": "x"}', *lines["one.warc.gz"]]).encode(),
                   "indexes/b.cdxj": "\n".join(lines["archive/two.warc.gz"]).encode(), "datapackage.json": b"{}"}, force=True)
    path = tmp_path / "foreign.zip"
    path.write_bytes(data)
    archives = spark.createDataFrame([(str(path),)], "archive string")
    for block_bytes in (1, 10**6):
        got = warc.read_archives(archives, block_bytes=block_bytes).collect()
        assert sorted((r.record_type, r.url, bytes(r.payload), r.page_id, r.payload_bytes) for r in got) == [
            ("request", "http://b/", b"GET /", None, 5), ("response", "http://a/", b"<p>a</p>", None, 8),
            ("response", "http://b/", b"plain", None, 5), ("warcinfo", "", b"software: x", None, 11)]


@pytest.mark.parametrize("index", [None, 'x 1 {"offset": 0, "length": 1, "filename": "gone.warc.gz"}',
                                   'x 1 {"offset": 0, "length": 99, "filename": "data.warc.gz"}'])
def test_archives_with_bad_indexes(index):
    members = {"archive/data.warc.gz": b"d" * 10} | ({} if index is None else {"indexes/i.cdxj": index.encode()})
    with pytest.raises(warc.BadArchive):
        warc.archive_blocks(*reader(zipped(members)), 1000)


def test_blocks_are_dealt_to_tasks(spark):
    """Small rows of blocks are not folded into one task."""
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 50, None) for i in range(400)], PAGES).repartition(2)
    archives = warc.write_archives(pages)
    held = warc.read_archives(archives, block_bytes=2_000)
    assert held.rdd.getNumPartitions() >= 8 and held.count() == 400
