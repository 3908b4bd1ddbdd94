"""Wav files as a Spark data source, for reading and writing.

    register(spark)
    spark.read.format("wav").load("/library")                                   # every column
    read_wav(spark, "/library", columns=["path", "sample_rate"])                # only headers are read
    clips.write.format("wav").option("encoding", "float").mode("append").save("/derived")

Reading. The driver lists the folder; tasks open the files. What a query does not ask for is not read: with only listing
columns no file is opened, without ``x`` only headers are read. Conditions on ``path``, ``name`` (the path in lower case) and ``length`` are
applied to the listing, so files they rule out are never opened. Small files share a task of about ``taskBytes``; a file above
``rangeBytes`` is cut into ranges of whole samples, a row each, with the position of the row's first sample in ``start``. A file that
is no wav file gives one row with status ``unreadable``.

Writing. Rows have ``name`` and ``x``. A task writes its files into a folder of its own attempt and moves them
together at its end; the job's commit is one rename of the folder that holds all of them. A failed or repeated task, or a failed job, leaves
nothing. ``append`` adds a folder named after the job, ``overwrite`` replaces the whole path. The sink is meant for file systems whose
rename of a folder is one step.

Paths may be URIs that pyarrow's file systems open.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as D
from pyspark.sql import types as T

from sigspark.functions import wav

LISTING = ("path", "name", "length", "modified")
HEADER = ("status", "sample_rate", "channels", "bits", "encoding", "n_samples")
SAMPLES = ("start", "x")
COLUMNS = {
    "path": "string", "name": "string", "length": "bigint", "modified": "timestamp", "status": "string", "sample_rate": "int",
    "channels": "int", "bits": "int", "encoding": "string", "n_samples": "bigint", "start": "bigint", "x": "array<float>",
}
#: Bytes of files that one task reads, and that one row holds at most.
TASK_BYTES, RANGE_BYTES = 128 << 20, 16 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def schema_of(columns) -> str:
    return ", ".join(f"{c} {COLUMNS[c]}" for c in columns)


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), posixpath.abspath(path)


@dataclass
class Piece:
    """A file, or the bytes from ``first`` up to ``last`` of it."""

    path: str
    length: int
    modified: object
    first: int
    last: int


class Pieces(D.InputPartition):
    def __init__(self, pieces: list[Piece]):
        super().__init__(None)
        self.pieces = pieces


def holds(condition: D.Filter, row: dict) -> bool | None:
    """Whether a listed file meets a pushed condition; None for conditions that aren't about the listing."""
    if isinstance(condition, D.Not):
        inner = holds(condition.child, row)
        return None if inner is None else not inner
    column = getattr(condition, "attribute", (None,))
    if len(column) != 1 or column[0] not in row:
        return None
    value, asked = row[column[0]], getattr(condition, "value", None)
    tests = {
        D.EqualTo: lambda: value == asked,
        D.In: lambda: value in asked,
        D.IsNotNull: lambda: True,
        D.StringContains: lambda: asked in value,
        D.StringStartsWith: lambda: value.startswith(asked),
        D.StringEndsWith: lambda: value.endswith(asked),
        D.GreaterThan: lambda: value > asked,
        D.GreaterThanOrEqual: lambda: value >= asked,
        D.LessThan: lambda: value < asked,
        D.LessThanOrEqual: lambda: value <= asked,
    }
    test = tests.get(type(condition))
    return None if test is None else test()


class WavReader(D.DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path = options["path"]
        self.names = schema.fieldNames()
        if bad := [f.name for f in schema if COLUMNS.get(f.name) != f.dataType.simpleString()]:
            raise ValueError(f"a wav file has no such column: {', '.join(bad)}")
        self.task_bytes = int(options.get("taskBytes", TASK_BYTES))
        self.range_bytes = int(options.get("rangeBytes", RANGE_BYTES))
        self.conditions: list[D.Filter] = []

    def pushFilters(self, filters):
        sample = {"path": "", "name": "", "length": 0}
        for condition in filters:
            try:
                known = holds(condition, sample) is not None
            except TypeError:  # a value of another type
                known = False
            if known:
                self.conditions.append(condition)
            else:
                yield condition

    def listed(self) -> list[Piece]:
        fs, path = open_path(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = [f for f in found if f.type == pafs.FileType.File and f.path.lower().endswith(".wav") and not self.hidden(f.path[len(path) :])]
        pieces = [Piece(f.path, f.size, f.mtime, 0, f.size) for f in sorted(files, key=lambda f: f.path)]
        return [p for p in pieces if all(holds(c, {"path": p.path, "name": p.path.lower(), "length": p.length}) for c in self.conditions)]

    @staticmethod
    def hidden(below: str) -> bool:
        return any(part.startswith(("_", ".")) for part in below.split("/"))

    def partitions(self) -> list[Pieces]:
        cut = set(self.names) & set(SAMPLES)
        pieces = []
        for file in self.listed():
            step = self.range_bytes if cut else max(file.length, 1)
            pieces += [Piece(file.path, file.length, file.modified, at, min(at + step, file.length)) for at in range(0, max(file.length, 1), step)]
        groups, size = [], self.task_bytes + 1
        for piece in pieces:
            cost = piece.last - piece.first if cut else 4096
            if size + cost > self.task_bytes:
                groups.append([])
                size = 0
            groups[-1].append(piece)
            size += cost
        return [Pieces(g) for g in groups] or [Pieces([])]

    def rows(self, piece: Piece, fs: pafs.FileSystem) -> dict | None:
        row = {"path": piece.path, "name": piece.path.lower(), "length": piece.length, "modified": piece.modified}
        row |= dict.fromkeys(HEADER + SAMPLES)
        if not set(self.names) - set(LISTING):
            return row
        # one small read for the header; larger buffers only for samples
        with fs.open_input_file(piece.path) as f:
            try:
                head = wav.read_header(f, piece.length)
            except Exception:  # any damage of the header is the same outcome
                return row | {"status": "unreadable"} if piece.first == 0 else None
            row |= {"status": "ok", "sample_rate": head.rate, "channels": head.channels, "bits": head.bits}
            row |= {"encoding": head.encoding, "n_samples": head.n_samples}
            if set(self.names) & set(SAMPLES):
                # samples whose first byte lies in the piece
                begin = min(max(-(-(piece.first - head.data_start) // head.step), 0), head.n_samples)
                end = min(max(-(-(piece.last - head.data_start) // head.step), 0), head.n_samples)
                if piece.first > 0 and begin == end:
                    return None
                row["start"] = begin
                if "x" in self.names:
                    f.seek(head.data_start + begin * head.step)
                    row["x"] = wav.to_mono(f.read((end - begin) * head.step), head)
            return row

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        fs, _ = open_path(self.path)
        held, size = [], 0
        for piece in partition.pieces:
            row = self.rows(piece, fs)
            if row is not None:
                held.append(row)
                size += 256 + (0 if row["x"] is None else row["x"].nbytes)
            if size > 2 * self.range_bytes:
                yield self.batch(held)
                held, size = [], 0
        if held:
            yield self.batch(held)

    def batch(self, rows: list[dict]) -> pa.RecordBatch:
        kinds = {
            "modified": pa.timestamp("us", "UTC"), "length": pa.int64(), "n_samples": pa.int64(), "start": pa.int64(),
            "sample_rate": pa.int32(), "channels": pa.int32(), "bits": pa.int32(), "x": pa.list_(pa.float32()),
        }
        columns = [pa.array([r[n] for r in rows], kinds.get(n, pa.string())) for n in self.names]
        return pa.RecordBatch.from_arrays(columns, self.names)


@dataclass
class Moved(D.WriterCommitMessage):
    files: int


class WavWriter(D.DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.rate, self.encoding = int(options.get("sampleRate", 22050)), options.get("encoding", "pcm")
        if self.encoding not in ("pcm", "float"):
            raise ValueError("encoding is pcm or float")
        self.overwrite, self.job = overwrite, uuid.uuid4().hex
        above, last = posixpath.split(self.path)
        self.staging = f"{above}/_{last}-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Moved:
        fs, staging = open_path(self.staging)
        attempt = f"{staging}/attempts/{uuid.uuid4().hex}"
        fs.create_dir(attempt, recursive=True)
        names = []
        for batch in iterator:
            for name, x in zip(batch.column("name").to_pylist(), batch.column("x")):
                if not name or "/" in name or name.startswith((".", "_")):
                    raise ValueError(f"not a file name: {name!r}")
                with fs.open_output_stream(f"{attempt}/{name}") as out:
                    out.write(wav.encode(x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.empty(0), self.rate, self.encoding))
                names.append(name)
        if len(set(names)) < len(names):
            raise ValueError("two rows have the same name")
        fs.create_dir(f"{staging}/files", recursive=True)
        for name in names:
            fs.move(f"{attempt}/{name}", f"{staging}/files/{name}")
        return Moved(len(names))

    def commit(self, messages: list) -> None:
        fs, staging = open_path(self.staging)
        _, path = open_path(self.path)
        fs.create_dir(f"{staging}/files", recursive=True)
        there = fs.get_file_info(f"{staging}/files")
        found = len(fs.get_file_info(pafs.FileSelector(f"{staging}/files"))) if there.type == pafs.FileType.Directory else 0
        if found != sum(m.files for m in messages if m is not None):
            self.abort(messages)
            raise ValueError("two rows of different tasks have the same name")
        if not self.overwrite:
            fs.create_dir(path, recursive=True)
            fs.move(f"{staging}/files", f"{path}/{self.job}")
        else:
            old = fs.get_file_info(path).type != pafs.FileType.NotFound
            if old:
                fs.move(path, f"{staging}/old")
            else:
                fs.create_dir(posixpath.dirname(path), recursive=True)
            fs.move(f"{staging}/files", path)
        fs.delete_dir(staging)

    def abort(self, messages: list) -> None:
        fs, staging = open_path(self.staging)
        if fs.get_file_info(staging).type != pafs.FileType.NotFound:
            fs.delete_dir(staging)


class WavSource(D.DataSource):
    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return schema_of(COLUMNS)

    def reader(self, schema: T.StructType) -> WavReader:
        return WavReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> WavWriter:
        kinds = {f.name: f.dataType.simpleString() for f in schema}
        if kinds.get("name") != "string" or kinds.get("x") not in ("array<float>", "array<double>"):
            raise ValueError("the sink takes the columns name (string) and x (array of float or double)")
        return WavWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session, with conditions pushed to the listing."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(WavSource)


def read_wav(spark: SparkSession, path: str, columns: list[str] | None = None, **options) -> DataFrame:
    """Wav files below a path; only what ``columns`` need is read."""
    register(spark)
    return spark.read.format("wav").schema(schema_of(columns or COLUMNS)).options(**options).load(path)


def write_wav(clips: DataFrame, path: str, sample_rate: int, encoding: str = "pcm", mode: str = "append") -> None:
    """Rows (name, x) as wav files that appear together or not at all."""
    register(clips.sparkSession)
    rows = clips.select("name", clips["x"].cast("array<float>").alias("x"))
    rows.write.format("wav").option("sampleRate", sample_rate).option("encoding", encoding).mode(mode).save(path)
