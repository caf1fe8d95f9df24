"""WARC records in ZIP archives (operator 5): writer, and a reader that seeks instead of extracting.

Writing: pages are digested; equal payloads of at least ``MIN_PAYLOAD`` bytes
are grouped (partial counts, then a join that AQE can split), and all but the
smallest id become revisit records without a payload. Each task writes ZIP
archives of at most ``ARCHIVE_BYTES`` of payload to the shared folder: a
stored member ``archive/data.warc.gz`` with one gzip member per record, and a
stored member ``indexes/index.cdxj`` with offset and length of each record.
Every attempt writes files of its own name; only the files named by the
finished table count, so a lost executor leaves at most unused files.

Reading: a task reads the end of an archive, its end record (the ZIP64 one
where the fields say so) and its central directory, and yields the stored
members. Every index member gives record ranges in the data members it names,
grouped into blocks of ``BLOCK_BYTES``; blocks are dealt to the tasks,
``BLOCKS_PER_TASK`` each, so a large archive is read by many. Each block is one
range read of the shared store, and each record is unpacked on its own.

Cases: a null payload is empty. A null id orders above every id. Rows that
repeat an id and a payload are records of their own with the same verdict. An
empty table writes no archive. A member that is compressed by ZIP itself, a
damaged directory, a missing index or an index of a member that is not there
raise ``BadArchive``. Records of other writers need no page id, length or
SHA-256 digest: the id is then null and the others are taken from the payload.
Other columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Stager, ship_package

MIN_PAYLOAD = 100
ARCHIVE_BYTES = 128 << 20
BLOCK_BYTES = 8 << 20
BLOCKS_PER_TASK = 2
ARCHIVES, INDEXES = "archive/", "indexes/"
DATA, INDEX = f"{ARCHIVES}data.warc.gz", f"{INDEXES}index.cdxj"
DATE = "2024-02-01T00:00:00Z"  # records carry the fixed as-of date, so reruns agree
NO_ID = "null"

# Fixed values of the ZIP format: signatures and record layouts.
_END, _END64, _LOCATOR64, _ENTRY, _LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
_FULL16, _FULL32 = 0xFFFF, 0xFFFFFFFF


class BadArchive(ValueError):
    """The bytes are not a readable archive of stored members."""


def open_store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a URI or a plain path."""
    if "://" in uri:
        return pyarrow.fs.FileSystem.from_uri(uri)
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pyarrow.fs.LocalFileSystem(), uri


# ---- records


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool) -> bytes:
    """One WARC record; a revisit has headers only."""
    name = NO_ID if page_id is None else str(page_id)
    body = b"" if revisit else payload
    headers = [("WARC-Type", "revisit" if revisit else "response"),
               ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + name)}>"),
               ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")),
               ("WARC-Payload-Digest", f"sha256:{digest}"), ("Content-Type", "text/html"),
               ("Content-Length", str(len(body))), ("Page-Id", name), ("Payload-Length", str(len(payload)))]
    if revisit:
        headers += [("WARC-Refers-To-Page-Id", NO_ID if refers_to is None else str(refers_to)),
                    ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"WARC/1.1\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and body of one unpacked record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or not lines[0].startswith("WARC/"):
        raise BadArchive("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    length = int(headers["content-length"])
    if len(rest) < length:
        raise BadArchive("the record is cut short")
    return headers, rest[:length]


# ---- writing


class ArchiveWriter:
    """One ZIP archive: the data member is streamed, the index member follows."""

    def __init__(self, folder: str, part: int):
        self.uri = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.zip"
        store, path = open_store(self.uri)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED)
        # The size is not known beforehand, so the entry has ZIP64 fields.
        self.data = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.size = self.payload = 0

    def add(self, page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> None:
        packed = gzip.compress(record(page_id, url, payload, digest, refers_to, revisit), 6, mtime=0)
        self.data.write(packed)
        entry = {"url": url or "", "mime": "warc/revisit" if revisit else "text/html", "digest": f"sha256:{digest}",
                 "offset": self.size, "length": len(packed), "filename": DATA.rpartition("/")[2]}
        self.index.append(f"{quote(url or '', safe='')} 20240201000000 {json.dumps(entry, sort_keys=True)}")
        self.size += len(packed)
        self.payload += len(payload)

    def close(self) -> tuple[str, int]:
        self.data.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.index))
        self.zip.close()
        self.out.close()
        return self.uri, len(self.index)


class _Forward(io.RawIOBase):
    """A write-only stream without seeking, for stores that only append."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def writable(self):
        return True

    def write(self, data):
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def tell(self):
        return self.at

    def flush(self):
        pass


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, writer, done = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for page_id, url, payload, digest, refers_to, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or ArchiveWriter(folder, part)
                writer.add(page_id, url, payload or b"", digest, refers_to, revisit)
                if writer.payload >= archive_bytes:
                    done.append(writer.close())
                    writer = None
        if writer:
            done.append(writer.close())
        yield pa.record_batch([pa.array([u for u, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())],
                              names=["archive", "records"])
    return run


def write_archives(pages: DataFrame, min_payload: int = MIN_PAYLOAD, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``pages``; one row per archive: archive (its URI), records."""
    ship_package(pages.sparkSession)
    stage = Stager(pages.sparkSession)
    payload = F.coalesce(pages["html"], F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    large = F.octet_length("payload") >= min_payload
    same = stage(rows.where(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
                 .where("n > 1").drop("n"), "same")
    # Groups grow with the input, so they are merged and never broadcast.
    judged = rows.join(same.hint("merge"), "digest", "left")
    # Only groups of large payloads are in the table, so a match is enough.
    revisit = (~F.col("page_id").eqNullSafe(F.col("first"))) & F.col("first").isNotNull()
    ready = judged.select("page_id", "url", "payload", "digest",
                          F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    return stage(ready.mapInArrow(_write(f"{stage.folder}/archives", archive_bytes), "archive string, records long"),
                 "archives")


# ---- reading


@dataclass
class Member:
    name: str
    offset: int  # of the member's first byte
    size: int


def directory(read, size: int) -> list[Member]:
    """Stored members of an archive; ``read(offset, length)`` reads a range."""
    tail_at = max(0, size - 22 - _FULL16 - 20)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(_END)
    while at >= 0 and (len(tail) < at + 22 or at + 22 + struct.unpack_from("<H", tail, at + 20)[0] != len(tail)):
        at = tail.rfind(_END, 0, at)
    if at < 0:
        raise BadArchive("no end record")
    entries, length, start = struct.unpack_from("<H2I", tail, at + 10)
    if entries == _FULL16 or length == _FULL32 or start == _FULL32:
        if at < 20 or tail[at - 20:at - 16] != _LOCATOR64:
            raise BadArchive("no ZIP64 locator")
        end64 = read(struct.unpack_from("<Q", tail, at - 12)[0], 56)
        if end64[:4] != _END64:
            raise BadArchive("no ZIP64 end record")
        entries, length, start = struct.unpack_from("<3Q", end64, 32)
    central, members, at = read(start, length), [], 0
    for _ in range(entries):
        if central[at:at + 4] != _ENTRY:
            raise BadArchive("damaged central directory")
        method, = struct.unpack_from("<H", central, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<2I3H", central, at + 20)
        local, = struct.unpack_from("<I", central, at + 42)
        name = central[at + 46:at + 46 + n_name].decode()
        extra = central[at + 46 + n_name:at + 46 + n_name + n_extra]
        packed, plain, local = zip64_fields(extra, packed, plain, local)
        if method or packed != plain:
            raise BadArchive(f"{name} is not stored")
        head = read(local, 30)
        if head[:4] != _LOCAL:
            raise BadArchive(f"{name} has no local header")
        n_name2, n_extra2 = struct.unpack_from("<2H", head, 26)
        members.append(Member(name, local + 30 + n_name2 + n_extra2, plain))
        at += 46 + n_name + n_extra + n_comment
    return members


def zip64_fields(extra: bytes, packed: int, plain: int, local: int) -> tuple[int, int, int]:
    """The sizes and offset, from the ZIP64 extra field where the short ones are full."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{n // 8}Q", extra, at + 4))
            plain = next(wide) if plain == _FULL32 else plain
            packed = next(wide) if packed == _FULL32 else packed
            local = next(wide) if local == _FULL32 else local
        at += 4 + n
    return packed, plain, local


def record_ranges(index: str, members: list[Member]) -> dict[str, list[tuple[int, int]]]:
    """(offset in the archive, length) of each record that the index names, by the member that holds it."""
    by_name = {m.name: m for m in members} | {m.name.rpartition("/")[2]: m for m in members if m.name.startswith(ARCHIVES)}
    found: dict[str, list[tuple[int, int]]] = {}
    for line in index.splitlines():
        if not line.strip() or line.startswith("!"):   # a header line of the index format
            continue
        entry = json.loads(line.split(" ", 2)[2])
        offset, length, name = int(entry["offset"]), int(entry["length"]), entry["filename"]
        if (member := by_name.get(name)) is None:
            raise BadArchive(f"the index names {name}, which the archive does not hold")
        if offset + length > member.size:
            raise BadArchive("the index points past its member")
        found.setdefault(member.name, []).append((member.offset + offset, length))
    return {name: sorted(ranges) for name, ranges in found.items()}


def archive_blocks(read, size: int, block_bytes: int) -> list[list[tuple[int, int]]]:
    """Neighbouring records of an archive, by about ``block_bytes``; all its indexes and data members."""
    members = directory(read, size)
    indexes = [m for m in members if m.name.startswith(INDEXES) and m.name.endswith((".cdxj", ".cdx"))]
    if not indexes:
        raise BadArchive("the archive holds no index")
    blocks: list[list[tuple[int, int]]] = []
    for index in indexes:
        for ranges in record_ranges(read(index.offset, index.size).decode(), members).values():
            block: list[tuple[int, int]] = []
            for at, n in ranges:
                if block and at + n - block[0][0] > block_bytes:
                    blocks.append(block)
                    block = []
                block.append((at, n))
            blocks.append(block)
    return blocks


def _locate(block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_store(uri)
                with store.open_input_file(path) as f:
                    blocks = archive_blocks(lambda at, n: f.read_at(n, at), f.size(), block_bytes)
                yield pa.record_batch([pa.array([uri] * len(blocks), pa.string()),
                                       pa.array([[a for a, _ in b] for b in blocks], pa.list_(pa.int64())),
                                       pa.array([[n for _, n in b] for b in blocks], pa.list_(pa.int64()))],
                                      names=["archive", "offsets", "lengths"])
    return run


_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                   ("refers_to", pa.int64())])
PAGE = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, " \
       "refers_to long"


def _number(text: str | None) -> int | None:
    return None if text in (None, NO_ID) else int(text)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri, offsets, lengths in zip(*(c.to_pylist() for c in batch.columns)):
            store, path = open_store(uri)
            with store.open_input_file(path) as f:
                block = f.read_at(offsets[-1] + lengths[-1] - offsets[0], offsets[0])
            rows = []
            for at, n in zip(offsets, lengths):
                headers, body = parse_record(gzip.decompress(block[at - offsets[0]:at - offsets[0] + n]))
                if headers.get("content-type", "").startswith("application/http"):
                    body = body.partition(b"\r\n\r\n")[2]   # what follows the HTTP headers
                revisit = headers.get("warc-type") == "revisit"
                # Archives of others may name no page, another kind of digest or no length.
                kind, _, digest = headers.get("warc-payload-digest", "").partition(":")
                own = None if revisit else hashlib.sha256(body).hexdigest()
                if kind == "sha256" and len(digest) == 64 and own not in (None, digest.lower()):
                    raise BadArchive(f"the payload of {headers.get('warc-target-uri')} does not match its digest")
                rows.append((_number(headers.get("page-id")), headers.get("warc-target-uri"), None if revisit else body,
                             int(headers.get("payload-length", len(body))), own or digest, headers.get("warc-type"),
                             _number(headers.get("warc-refers-to-page-id"))))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _PAGE)], schema=_PAGE)


def read_archives(archives: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per record of the archives (column ``archive`` has their URIs)."""
    spark: SparkSession = archives.sparkSession
    ship_package(spark)
    blocks = Stager(spark)(archives.select("archive").mapInArrow(
        _locate(block_bytes), "archive string, offsets array<bigint>, lengths array<bigint>"), "blocks")
    # Blocks, not archives, are dealt to the tasks: the number keeps the few small rows from ending up in one.
    tasks = -(-blocks.count() // BLOCKS_PER_TASK)
    return blocks.repartition(max(1, tasks)).mapInArrow(_read, PAGE)
