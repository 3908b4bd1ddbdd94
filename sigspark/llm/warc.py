"""WARC records in ZIP packages, written from a table and read by ranges.

A package is a ZIP archive with two stored members: ``archive/data.warc.gz``, one
gzip member per record, and ``indexes/index.cdxj``, a line with record id,
offset and length for each record. Every task writes packages of about PACKAGE bytes in the
folder given, under a name of its own; the rows it returns name them, so files of
a lost or repeated attempt are never read.

The reader knows nothing of the writer: it finds the end-of-directory record at
the end of a package (the ZIP64 one where a field overflows), parses the
central directory, locates the stored members and the index, and turns index
lines into ranges. Ranges are dealt to tasks, as many as there are ranges for, which read and inflate them one by
one; nothing is extracted to disk. Without an index the record stream is walked. Index lines may be those of other tools (a key, a timestamp and
JSON), and records of any type: see ``parse``.

Of records with equal payloads of at least LEAST bytes, the one with the largest
page_id is a response and the others revisit it; smaller ones are responses.
Equality is that of SHA-256 and length; only these narrow keys are shuffled
to find the response, combined before the shuffle.

Files are opened with pyarrow's file systems by URI, so the folder can be any
store that they reach (a shared mount, HDFS, S3).

Defined cases: null html is an empty payload; rows with the largest page_id of
a group are all responses; a row without page_id is a response if no
row of its group has one, else a revisit; repeated rows are records each; other columns are
ignored; an empty table writes no package and reads none.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import small_batches
from sigspark.session import scratch_path, stored

LEAST = 1000
PACKAGE = 64 << 20
#: Bytes that one range read takes at most, unless a record is longer.
RANGE = 4 << 20
#: Bytes of an index that are read at a time, and ranges that a task reads where there are very many.
PIECE, RANGES = 1 << 20, 16
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Fixed value: any date makes a valid record; a constant keeps repeated tasks equal.
DATE = "2024-01-01T00:00:00Z"


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or plain path."""
    return fs.FileSystem.from_uri(uri.replace("file:", "file://", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)


# ---- records


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    name = "none" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(url.split())}",
        "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(data: bytes) -> tuple[dict[str, str], int]:
    """Header fields by lower-case name, and where the block begins."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + 4


def page_of(urn: str | None) -> int | None:
    name = (urn or "").strip("<>").rpartition(":")[2]
    return int(name) if name.lstrip("-").isdigit() else None


def sha1_of(digest: str | None) -> str | None:
    """Lower-case hex of a labelled SHA-1 digest, in base 32 or hex; None for other digests."""
    name, _, value = (digest or "").partition(":")
    if name.strip().lower() not in ("sha1", "sha-1"):
        return None
    value = value.strip()
    try:
        return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()
    except ValueError:
        return None


def parse(data: bytes) -> dict:
    """What a record says.

    Records of any type are read. The payload of a response is its HTTP body, that of others their block; revisits have none. A payload is
    checked against its SHA-1 where the record states one, unless it was transferred in chunks; a record
    that states none gets that of its payload.
    """
    if not data.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields, at = headers(data)
    kind = fields.get("warc-type", "").lower()
    block = data[at : at + int(fields["content-length"])] if "content-length" in fields else data[at:].removesuffix(b"\r\n\r\n")
    http, body = {}, 0
    if kind in ("response", "revisit") and fields.get("content-type", "application/http").startswith("application/http") and b"\r\n\r\n" in block:
        http, body = headers(block)
    payload = None if kind == "revisit" else block[body:]
    stated, size = sha1_of(fields.get("warc-payload-digest")), http.get("content-length", "")
    own = None if payload is None else hashlib.sha1(payload).hexdigest()
    if own and stated and own != stated and "transfer-encoding" not in http:
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    return {
        "page_id": page_of(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri", ""),
        "payload_bytes": len(payload) if payload is not None else int(size) if size.isdigit() else None,
        "payload_digest": stated or own,
        "record_type": kind,
        "refers_to": page_of(fields.get("warc-refers-to")),
        "payload": payload,
        "record_id": fields.get("warc-record-id", ""),
    }


# ---- packages


class PackageWriter:
    """A ZIP package that grows record by record; only index lines stay in memory."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.wacz"
        store, path = open_store(self.path)
        store.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(ARCHIVE), "w", force_zip64=True)
        self.size, self.lines = 0, []

    def add(self, page_id: int | None, data: bytes) -> None:
        packed = gzip.compress(data, 1, mtime=0)
        self.lines.append(json.dumps({"filename": ARCHIVE, "id": page_id, "offset": self.size, "length": len(packed)}))
        self.member.write(packed)
        self.size += len(packed)

    def close(self) -> str:
        self.member.close()
        self.zip.writestr(zipfile.ZipInfo(INDEX), "\n".join(self.lines))
        self.zip.close()
        self.out.close()
        return self.path


def directory(file) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP archive: name -> (offset of the local header, stored size, method)."""
    size = file.size()
    tail_at = max(0, size - 65_557)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, at = struct.unpack("<HII", tail[end + 10 : end + 20])
    if count == 0xFFFF or length == 0xFFFFFFFF or at == 0xFFFFFFFF:
        file.seek(tail_at + end - 20)
        locator = file.read(20)
        if locator[:4] != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        file.seek(struct.unpack("<Q", locator[8:16])[0])
        wide = file.read(56)
        if wide[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, at = struct.unpack("<QQQ", wide[32:56])
    file.seek(at)
    data = file.read(length)
    members, p = {}, 0
    for _ in range(count):
        if data[p : p + 4] != b"PK\x01\x02":
            raise ValueError("damaged central directory")
        flags, method = struct.unpack("<HH", data[p + 8 : p + 12])
        packed, whole = struct.unpack("<II", data[p + 20 : p + 28])
        n_name, n_extra, n_note = struct.unpack("<HHH", data[p + 28 : p + 34])
        (offset,) = struct.unpack("<I", data[p + 42 : p + 46])
        name = data[p + 46 : p + 46 + n_name].decode("utf-8" if flags & 0x800 else "cp437")
        extra = data[p + 46 + n_name : p + 46 + n_name + n_extra]
        q = 0
        while q + 4 <= len(extra):
            kind, n = struct.unpack("<HH", extra[q : q + 4])
            if kind == 1:  # ZIP64: those of the three that overflow, in this order
                wide = iter(struct.unpack(f"<{n // 8}Q", extra[q + 4 : q + 4 + n // 8 * 8]))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                packed = next(wide) if packed == 0xFFFFFFFF else packed
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            q += 4 + n
        members[name] = (offset, packed, method)
        p += 46 + n_name + n_extra + n_note
    return members


def data_range(file, member: tuple[int, int, int]) -> tuple[int, int]:
    """Where a stored member's bytes lie: (offset, length)."""
    offset, length, method = member
    if method != 0:
        raise ValueError("the member is compressed: it can't be read by ranges")
    file.seek(offset)
    head = file.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack("<HH", head[26:30])
    return offset + 30 + n_name + n_extra, length


def locate(path: str) -> Iterator[tuple[int, int]]:
    """(offset, length) in the package of every record, from its index members or by walking."""
    store, at = open_store(path)
    with store.open_input_file(at) as file:
        members = directory(file)
        for name, member in members.items():
            if not (name.startswith("archive/") and name.endswith(".warc.gz")):
                continue
            begin, length = data_range(file, member)
            indexes = [m for n, m in members.items() if n.startswith("indexes/") and n.endswith(".cdxj") and m[2] == 0]
            if indexes:
                found = {e[1:] for m in indexes for e in entries(file, *data_range(file, m)) if name in (e[0], f"archive/{e[0]}")}
                yield from ((begin + offset, size) for offset, size in sorted(found))
            else:
                yield from walk(file, begin, length)


def entries(file, at: int, length: int) -> Iterator[tuple[str, int, int]]:
    """(file name, offset, length) of the lines of an index: JSON alone, or after a key and a timestamp; read by PIECE bytes."""
    left, end = b"", at + length
    while at < end or left:
        if at < end:
            file.seek(at)
            data = file.read(min(PIECE, end - at))
            if not data:
                raise ValueError("cut index")
            at += len(data)
            lines = (left + data).split(b"\n")
            left = lines.pop()
        else:
            lines, left = [left], b""
        for line in lines:
            begin = line.find(b"{")
            if begin >= 0 and not line.startswith(b"!"):
                entry = json.loads(line[begin:])
                if "offset" in entry and "length" in entry:
                    yield entry.get("filename", ARCHIVE), int(entry["offset"]), int(entry["length"])


def walk(file, begin: int, length: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of the gzip members of a record stream."""
    at, end = begin, begin + length
    while at < end:
        unpack, read = zlib.decompressobj(31), 0
        file.seek(at)
        while not unpack.eof:
            data = file.read(min(1 << 16, end - at - read))
            if not data:
                raise ValueError("cut record")
            read += len(data)
            unpack.decompress(data)
        own = read - len(unpack.unused_data)
        yield at, own
        at += own


def spans(path: str) -> list[tuple[int, int, list[int]]]:
    """Neighbouring records joined to ranges of about RANGE bytes: (offset, length, record lengths)."""
    out: list[tuple[int, int, list[int]]] = []
    for offset, length in locate(path):
        if out and out[-1][0] + out[-1][1] == offset and out[-1][1] + length <= RANGE:
            first, total, lengths = out[-1]
            lengths.append(length)
            out[-1] = (first, total + length, lengths)
        else:
            out.append((offset, length, [length]))
    return out


# ---- Spark


def with_refers_to(pages: DataFrame) -> DataFrame:
    """page_id, url, html, refers_to."""
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), html.alias("html"))
    long = keyed.withColumn("size", F.octet_length("html")).filter(F.col("size") >= LEAST)
    narrow = stored(long.select("page_id", F.sha2("html", 256).alias("sha"), "size"), "payload-keys")
    groups = narrow.groupBy("sha", "size").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND largest IS NOT NULL")
    revisits = narrow.join(groups, ["sha", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("largest")))
    links = revisits.select(F.col("page_id").alias("__id"), "sha", F.col("largest").alias("refers_to")).distinct()
    same = F.col("page_id").eqNullSafe(F.col("__id")) & (F.sha2("html", 256) == F.col("sha"))
    return keyed.join(links, same, "left").select("page_id", "url", "html", "refers_to")


def write_packages(pages: DataFrame, folder: str) -> DataFrame:
    """Writes the packages; returns path and records of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, done = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                writer = writer or PackageWriter(folder)
                writer.add(page_id.as_py(), record(page_id.as_py(), url.as_py(), html.as_buffer().to_pybytes(), refers_to.as_py()))
                if writer.size >= PACKAGE:
                    done.append((writer.close(), len(writer.lines)))
                    writer = None
        if writer:
            done.append((writer.close(), len(writer.lines)))
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["path", "records"])

    return stored(small_batches(with_refers_to(pages)).mapInArrow(run, "path string, records long"), "packages")


def read_packages(packages: DataFrame) -> DataFrame:
    """A row per record of the packages named in ``path``; payload is null for revisits."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                found = spans(path)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(found), pa.string()), pa.array([f[0] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                    ["path", "offset", "lengths"],
                )

    fields = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload", "record_id"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, offset, lengths in zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "lengths")), strict=True):
                store, at = open_store(path)
                with store.open_input_file(at) as file:
                    file.seek(offset)
                    data = io.BytesIO(file.read(sum(lengths)))
                rows = [parse(gzip.decompress(data.read(n))) for n in lengths]
                yield pa.RecordBatch.from_arrays([pa.array([r[f] for r in rows], k) for f, k in zip(fields, kinds, strict=True)], fields)

    # ranges are a few numbers each: how many tasks read them must not follow from their own size
    most = int(packages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = packages.select("path").repartition(max(1, min(most, packages.count())), "path")
    # indexes are read twice, for the number of ranges and for the ranges: they are small beside the records
    spread = paths.mapInArrow(find, "path string, offset long, lengths array<long>")
    n = spread.count()
    dealt = spread.repartition(max(1, min(n, max(most, -(-n // RANGES)))), F.xxhash64("path", "offset"))
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, record_id string"
    return dealt.mapInArrow(read, schema)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Writes ``pages`` as packages in ``folder`` (default: a new one in the shared folder) and reads them back."""
    return read_packages(write_packages(pages, folder or scratch_path(pages.sparkSession, "warc")))
