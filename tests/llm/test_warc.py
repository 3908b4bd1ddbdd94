"""WARC packages: exact round trip, ZIP64, and archives that other tools wrote."""
import gzip
import hashlib
import io
import zipfile

import pytest

from sigspark.llm import warc

SCHEMA = "page_id long, url string, html string, sha string, size int, refers_to string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y") for i, u, h in rows], SCHEMA)


ROWS = [
    (1, "http://a/1", "x" * 1000), (2, "http://a/2", "x" * 1000), (9, None, "x" * 1000), (3, "http://a/3", "x" * 999), (4, "http://a/4", "x" * 999),
    (5, "http://a/\r\nX: y", None), (6, "", ""), (7, "http://é/ü", "é" * 500), (8, "http://a/8", "é" * 500), (10, "http://a/10", "WARC/1.1\r\n\r\n" * 40_000),
    (11, "http://a/11", "\r\n\r\nWARC"), (-5, "http://a/-5", "y" * 2000), (-6, "http://a/-6", "y" * 2000),
]


def by_hand(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        most = max(j for j, _, g in rows if (g or "") == (h or ""))
        revisit = len(data) >= 1000 and i != most
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", most if revisit else None))
    return sorted(out)


def read(frame):
    return sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in frame.collect())


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "PACKAGE", 100)
    got = warc.round_trip(frame(spark, ROWS), f"{tmp_path}/some/folder")
    assert read(got) == by_hand(ROWS)
    payloads = {r.page_id: r.payload for r in got.collect()}
    assert all(payloads[i] == (h or "").encode() for i, _, h in ROWS if payloads[i] is not None)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "u", "z" * 1500), (2, "u", "z" * 1500), (2, "u", "z" * 1500), (None, "u", "z" * 1500), (None, "u", "short")]
    got = warc.round_trip(frame(spark, rows)).collect()
    assert sorted([(r.page_id, r.record_type, r.refers_to) for r in got], key=str) == sorted(
        [(1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "revisit", 2), (None, "response", None)], key=str
    )
    assert warc.round_trip(frame(spark, [])).count() == 0


def test_records_follow_the_form():
    data = warc.record(7, "http://a/ b", b"<p>", None)
    assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"<p>\r\n\r\n")
    assert warc.parse(data)["payload"] == b"<p>"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"<p>", b"<q>"))


def package(path, index=True, stored=True, wide=False):
    """A package written with the standard library only."""
    records = [gzip.compress(warc.record(i, "http://a", b"body %d" % i, None)) for i in range(5)]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as out:
        out.writestr("datapackage.json", "{}")
        with out.open(warc.ARCHIVE, "w", force_zip64=wide) as member:
            member.write(b"".join(records))
        if index:
            at, lines = 0, []
            for r in records:
                lines.append('{"filename": "%s", "offset": %d, "length": %d}' % (warc.ARCHIVE, at, len(r)))
                at += len(r)
            out.writestr(warc.INDEX, "\n".join(lines))
        out.comment = b"a note PK"
    return path


def test_reads_packages_of_others(spark, tmp_path):
    paths = [package(f"{tmp_path}/{k}.wacz", index=k % 2 == 0, wide=k > 1) for k in range(4)]
    got = warc.read_packages(spark.createDataFrame([(p,) for p in paths], "path string")).collect()
    assert sorted((r.page_id, r.payload) for r in got) == sorted((i, b"body %d" % i) for i in range(5) for _ in paths)
    squeezed = package(f"{tmp_path}/z.wacz", stored=False)
    with pytest.raises(ValueError):
        list(warc.locate(squeezed))


class Sparse(io.RawIOBase):
    """A huge file of which only a few ranges are written."""

    def __init__(self, size, parts):
        self.length, self.parts, self.at = size, parts, 0

    def size(self):
        return self.length

    def seek(self, at, whence=0):
        self.at = at

    def read(self, n=-1):
        out = bytearray(min(n, self.length - self.at))
        for begin, data in self.parts.items():
            low, high = max(begin, self.at), min(begin + len(data), self.at + len(out))
            if low < high:
                out[low - self.at : high - self.at] = data[low - begin : high - begin]
        self.at += len(out)
        return bytes(out)


def test_zip64_directory():
    """A member of 5 GB at 6 GB: every field overflows into the ZIP64 records."""
    import struct

    big, at, name = 5 << 30, 6 << 30, warc.ARCHIVE.encode()
    local = b"PK\x03\x04" + bytes(22) + struct.pack("<HH", len(name), 20) + name + bytes(20)
    directory = at + len(local) + big
    extra = struct.pack("<HHQQQ", 1, 24, big, big, at)
    entry = b"PK\x01\x02" + bytes(4) + struct.pack("<HH", 0, 0) + bytes(8) + struct.pack("<II", 0xFFFFFFFF, 0xFFFFFFFF)
    entry += struct.pack("<HHH", len(name), len(extra), 0) + bytes(8) + struct.pack("<I", 0xFFFFFFFF) + name + extra
    wide = b"PK\x06\x06" + struct.pack("<Q", 44) + bytes(12) + struct.pack("<QQQQ", 1, 1, len(entry), directory)
    end = directory + len(entry)
    wide = b"PK\x06\x06" + struct.pack("<Q", 44) + bytes(12) + struct.pack("<QQQQ", 1, 1, len(entry), directory)
    tail = wide + b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1) + b"PK\x05\x06" + bytes(4) + struct.pack("<HHIIH", 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    file = Sparse(end + len(tail), {at: local, directory: entry, end: tail})
    members = warc.directory(file)
    assert members == {warc.ARCHIVE: (at, big, 0)}
    assert warc.data_range(file, members[warc.ARCHIVE]) == (at + len(local), big)


FOREIGN = [
    b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:0a>\r\nContent-Type: application/warc-fields\r\nContent-Length: 16\r\n\r\nsoftware: x/1\r\n\n\r\n\r\n",
    b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <urn:uuid:0b>\r\nWARC-Target-URI: http://b/\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: 31\r\n\r\nHTTP/1.1 200 OK\r\nA: b\r\n\r\nhello!\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:0c>\r\nWARC-Payload-Digest: sha1:WRONGWRONGWRONGWRONGWRONGWRONGWR\r\nContent-Length: 52\r\n\r\nHTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n0\r\n\r\n\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:uuid:0d>\r\nContent-Type: application/http;msgtype=request\r\nContent-Length: 18\r\n\r\nGET / HTTP/1.1\r\n\r\n\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: revisit\r\nWARC-Record-ID: <urn:uuid:0e>\r\nWARC-Payload-Digest: sha256:aa\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:0f>\r\nWARC-Payload-Digest: sha1:da39a3ee5e6b4b0d3255bfef95601890afd80709\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
]


def test_records_of_other_tools():
    rows = [warc.parse(r) for r in FOREIGN]
    assert [r["record_type"] for r in rows] == ["warcinfo", "response", "response", "request", "revisit", "resource"]
    assert [r["payload"] for r in rows] == [b"software: x/1\r\n\n", b"hello!", b"0\r\n\r\n", b"GET / HTTP/1.1\r\n\r\n", None, b""]
    assert [r["payload_bytes"] for r in rows] == [16, 6, 5, 18, None, 0] and rows[1]["payload_digest"] == hashlib.sha1(b"hello!").hexdigest()
    assert rows[4]["payload_digest"] is None and rows[1]["url"] == "http://b/" and {r["page_id"] for r in rows} == {None}


@pytest.mark.parametrize("index", ["none", "cdxj", "two"])
def test_archives_of_other_tools(spark, tmp_path, index, monkeypatch):
    monkeypatch.setattr(warc, "PIECE", 37)
    packed = [gzip.compress(r) for r in FOREIGN]
    starts = [sum(map(len, packed[:k])) for k in range(len(packed))]
    path = f"{tmp_path}/a.wacz"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as out:
        out.writestr("archive/rec-1.warc.gz", b"".join(packed))
        # a key, a timestamp and JSON with numbers as text, sorted by key; only responses are listed
        line = lambda k: 'com,b)/%d 2024010100000%d {"url": "http://b/{", "filename": "rec-1.warc.gz", "offset": "%d", "length": "%d"}' % (9 - k, k, starts[k], len(packed[k]))
        if index != "none":
            out.writestr("indexes/index.cdxj", "!meta 0 {}\n" + "\n".join(sorted([line(1), line(2)])) + "\n")
        if index == "two":
            out.writestr("indexes/more.cdxj", line(5) + "\n" + line(1))
    got = {r.record_id: r.record_type for r in warc.read_packages(spark.createDataFrame([(path,)], "path string")).collect()}
    every = {f"<urn:uuid:0{c}>": t for c, t in zip("abcdef", ["warcinfo", "response", "response", "request", "revisit", "resource"])}
    wanted = {"none": "abcdef", "cdxj": "bc", "two": "bcf"}[index]
    assert got == {k: v for k, v in every.items() if k[-2] in wanted}


def test_ranges_are_read_by_many_tasks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "RANGE", 1)
    found = warc.round_trip(frame(spark, [(i, "u", f"page {i} " * 50) for i in range(40)]), f"{tmp_path}/p")
    assert found.rdd.getNumPartitions() == 8 and found.count() == 40
