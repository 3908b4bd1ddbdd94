"""Sequences of at most CAPACITY tokens: bounded-space online best-fit.

A document's tokens are the ids of its text by a public byte-level BPE file,
and one closing id. A document of more than CAPACITY tokens is cut into
pieces of CAPACITY, the first piece being the shorter one; others are one piece.

``pieces`` makes a narrow row per piece; texts and ids aren't shuffled.
``packed`` deals the pieces by a hash into parts of about PART rows and packs every
part online: at most OPEN bins are open, a bit set holds which amounts of free
space occur, and its lowest set bit at or above the piece's length is the best
fit. A full bin closes at once. If a piece fits nowhere and OPEN bins are open, the
fullest one closes first. The memory of a task is OPEN bins, whatever the
input. Of two bins open at the end of a part at most one is half empty, so
a part wastes little.

Defined cases: null and empty texts are one piece with the closing id only;
a string of a special token in a text has that token's id, as the tokenizer library gives it; repeated rows are packed
each; a row without doc_id is packed like others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm.common import map_texts
from sigspark.session import stored

CAPACITY = 2048
CLOSING = 0
OPEN = 512
PART = 250_000
#: Chunks of text whose ids a worker remembers, twice at most.
REMEMBERED = 100_000


class OddSpace(Exception):
    """A chunk that doesn't begin and end with visible characters."""


class Encoder:
    """Ids of texts, remembered by space-separated chunk.

    Where a plain space stands between two visible characters, byte-level BPE
    begins a new word whatever the neighbours are, so chunks can be encoded alone.
    A text with any other space next to a plain space is encoded whole.

    The vocabulary file's tokens, ranked by id, drive the fast encoder; the
    first chunks of a worker are compared with the file's own library, which
    takes over if the file's merges aren't ranked by id. A text that holds one of the file's
    special strings is the library's work from the start: it gives such a string one id.
    """

    def __init__(self, file: bytes):
        import tiktoken

        self.file, self.own = file, None
        spec = json.loads(file)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
        special = {t["content"] for t in spec.get("added_tokens", [])}
        self.special = re.compile("|".join(re.escape(t) for t in sorted(special, key=len, reverse=True)) or r"(?!)")
        ranks = {bytes(signs[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        # Fixed value: the word pattern of byte-level BPE
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("chunks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.tested, self.agree = 0, True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def library(self, text: str) -> list[int]:
        """Ids by the file's own library."""
        if self.own is None:
            from tokenizers import Tokenizer

            self.own = Tokenizer.from_str(self.file.decode())
        return self.own.encode(text, add_special_tokens=False).ids

    def ids(self, text: str) -> list[int]:
        if not self.agree:
            return self.library(text)
        found = self.fast.encode_ordinary(text)
        if self.tested < 1000:
            self.tested += 1
            own = self.library(text)
            if own != found:
                self.agree, self.young, self.old = False, {}, {}
                return own
            if self.tested == 1000:
                self.own = None  # its memory is given back, until a special string needs it
        return found

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk with the space before it, as little-endian 32-bit values."""
        data = self.old.get(chunk)
        if data is None:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                raise OddSpace
            data = packed_ids(self.ids(" " + chunk))
        if len(chunk) <= 64:
            if len(self.young) >= REMEMBERED:
                self.old, self.young = self.young, {}
            self.young[chunk] = data
        return data

    def encode(self, text: str) -> bytes:
        if self.special.search(text):
            return packed_ids(self.library(text))
        first, *chunks = text.split(" ")
        if not chunks or not first or first[-1].isspace():
            return packed_ids(self.ids(text))
        try:
            rest = [self.young.get(c) or self.chunk(c) for c in chunks]
        except OddSpace:
            return packed_ids(self.ids(text))
        return packed_ids(self.ids(first)) + b"".join(rest)


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_ENCODERS: dict[int, Encoder] = {}


def encoder(file: bytes) -> Encoder:
    key = zlib.crc32(file)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(file)
    return _ENCODERS[key]


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``length`` tokens."""
    head = length % capacity or min(length, capacity)
    return [(0, head), *((at, capacity) for at in range(head, length, capacity))]


def tokenizer_file(spark: SparkSession, path: str):
    """The vocabulary file's bytes, sent to the tasks once (under 2 MB)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    file = tokenizer_file(docs.sparkSession, path)
    closing = packed_ids([CLOSING])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encode = encoder(file.value).encode
        column = batch.column("text")
        rows, number, starts, lengths, sums = [], [], [], [], []
        for i in range(batch.num_rows):
            data = encode(column[i].as_py() or "") + closing
            for k, (start, length) in enumerate(cut(len(data) // 4, capacity)):
                rows.append(i)
                number.append(k)
                starts.append(start)
                lengths.append(length)
                sums.append(zlib.crc32(memoryview(data)[4 * start : 4 * (start + length)]))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(number, pa.int32()), *(pa.array(x, pa.int64()) for x in (starts, lengths, sums))],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(rows, run, "doc_id long, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Open bins of a part, found by their free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.free = 0  # bit f: a bin with f free is open
        self.by_free: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            del self.by_free[free]
            self.free &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fits = self.free >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            if self.open >= self.most:
                self._take((self.free & -self.free).bit_length() - 1)
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - free


def packed(rows: DataFrame, capacity: int = CAPACITY, most: int = OPEN, part: int = PART) -> DataFrame:
    """``rows`` (with ``length``, doc_id and piece) and the place of each: sequence_id, offset."""
    rows = stored(rows, "pieces")
    parts = max(1, -(-rows.count() // part))
    spot = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = rows.repartition(parts, spot).sortWithinPartitions(spot, "doc_id", "piece", "ids_crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, most)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            places = [bins.place(n) for n in batch.column("length").to_pylist()]
            columns = [pa.array([base + b for b, _ in places], pa.int64()), pa.array([at for _, at in places], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "sequence_id", "offset"])

    names = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
    return dealt.mapInArrow(run, f"{names}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece."""
    return packed(pieces(docs, path))
