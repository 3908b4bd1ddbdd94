"""The wav data source: formats, pruned reads, ranges, and the sink's commits."""

import io
import os
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clips import tone, wav_bytes
from sigspark.functions import wav
from sigspark.sources import wav as source


def chunk(name, body):
    return struct.pack("<4sI", name, len(body)) + body + b"\0" * (len(body) & 1)


def riff(*chunks):
    body = b"WAVE" + b"".join(chunks)
    return struct.pack("<4sI", b"RIFF", len(body)) + body


def fmt(code, channels, rate, bits, more=b""):
    step = channels * bits // 8
    return chunk(b"fmt ", struct.pack("<HHIIHH", code, channels, rate, rate * step, step, bits) + more)


def extensible(code, channels, rate, bits):
    guid = struct.pack("<H", code) + bytes.fromhex("000000001000800000aa00389b71")
    return fmt(0xFFFE, channels, rate, bits, struct.pack("<HHI", 22, bits, 3) + guid)


def plain(data):
    head = wav.read_header(io.BytesIO(data), len(data))
    return head, wav.to_mono(data[head.data_start : head.data_start + head.n_samples * head.step], head)


X = tone(440, 0.05).astype("float32")


@pytest.mark.parametrize(
    "data,near",
    [
        (wav_bytes(X, width=2), 1e-4), (wav_bytes(X, width=3), 1e-6), (wav_bytes(X, channels=2), 1e-4),
        (riff(fmt(3, 1, 22050, 32), chunk(b"data", X.astype("<f4").tobytes())), 0),
        (riff(fmt(3, 2, 22050, 64), chunk(b"fact", b"abc"), chunk(b"data", np.repeat(X, 2).astype("<f8").tobytes())), 0),
        (riff(extensible(3, 1, 22050, 32), chunk(b"LIST", b"odd"), chunk(b"data", X.astype("<f4").tobytes()), chunk(b"id3 ", b"tail")), 0),
        (riff(extensible(1, 1, 22050, 32), chunk(b"data", (X.astype("f8") * 2**31).astype("<i4").tobytes())), 1e-6),
    ],
)
def test_formats(data, near):
    head, x = plain(data)
    assert head.rate == 22050 and len(x) == len(X) and np.abs(x - X).max() <= near


def test_a_data_chunk_cut_short_ends_at_a_whole_sample():
    data = wav_bytes(X, channels=2)
    head, x = plain(data[:-7])
    assert head.n_samples == len(X) - 2 == len(x)


@pytest.mark.parametrize("data", [b"", b"RIFF", b"RIFF0000WAVE", riff(fmt(85, 1, 44100, 16), chunk(b"data", b"ab")), riff(chunk(b"data", b"ab")), riff(fmt(1, 0, 8000, 16), chunk(b"data", b""))])
def test_no_wav(data):
    with pytest.raises(ValueError):
        wav.read_header(io.BytesIO(data), len(data))


def test_encoded_files_are_what_the_standard_library_reads():
    with wave.open(io.BytesIO(wav.encode(np.array([0, 0.5, -1, 2]), 8000))) as f:
        assert (f.getframerate(), f.getnchannels(), f.getsampwidth()) == (8000, 1, 2)
        assert np.frombuffer(f.readframes(9), "<i2").tolist() == [0, 16384, -32768, 32767]


@pytest.fixture
def library(tmp_path):
    files = {
        "a/kick 1.wav": wav_bytes(X), "a/Snare.WAV": wav_bytes(X, rate=44100, channels=2), "b/_hidden/no.wav": wav_bytes(X), "b/text.txt": b"no",
        "b/float.wav": wav.encode(X, 48000, "float"), "b/damaged.wav": b"RIFF nothing", "b/empty.wav": b"", "b/none.wav": wav.encode([], 8000), "b/roll.wav": b"must not be opened",
    }
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(data)
    return tmp_path


def test_read_matches_a_plain_decode(spark, library):
    rows = {os.path.relpath(r.path, library): r for r in source.read_wav(spark, str(library)).collect()}
    assert set(rows) == {"a/kick 1.wav", "a/Snare.WAV", "b/float.wav", "b/damaged.wav", "b/empty.wav", "b/none.wav", "b/roll.wav"}
    for name, r in rows.items():
        data = (library / name).read_bytes()
        assert r.length == len(data) and r.name == r.path.lower()
        if name in ("b/damaged.wav", "b/empty.wav", "b/roll.wav"):
            assert (r.status, r.x, r.sample_rate) == ("unreadable", None, None)
        else:
            head, x = plain(data)
            assert (r.status, r.sample_rate, r.channels, r.bits, r.encoding, r.n_samples, r.start) == ("ok", head.rate, head.channels, head.bits, head.encoding, len(x), 0)
            assert r.x == x.tolist()


@pytest.mark.parametrize("size", [1, 7, 45, 100, 5000])
def test_ranges_hold_every_sample_once(spark, library, size):
    cut = source.read_wav(spark, str(library), ["path", "start", "x", "status"], rangeBytes=size if size > 1 else 17, taskBytes=300).where("status = 'ok'")
    found = {}
    for r in cut.collect():
        found.setdefault(r.path, []).append((r.start, r.x))
    for path, parts in found.items():
        _, x = plain(open(path, "rb").read())
        parts.sort(key=lambda p: (p[0], len(p[1])))
        assert [s for s, _ in parts] == [sum(len(p) for _, p in parts[:k]) for k in range(len(parts))]
        assert [v for _, p in parts for v in p] == x.tolist()
    assert len(found) == 4


def opened(library, columns, *conditions):
    """Paths the reader opens for these columns, run as a task would."""
    kinds = {"string": T.StringType(), "bigint": T.LongType(), "int": T.IntegerType(), "array<float>": T.ArrayType(T.FloatType())}
    reader = source.WavReader({"path": str(library)}, T.StructType([T.StructField(c, kinds[source.COLUMNS[c]]) for c in columns]))
    left = list(reader.pushFilters(list(conditions)))
    seen = []

    class Watched:
        def open_input_file(self, path):
            f = io.BytesIO(open(path, "rb").read())
            counted = type("Counted", (), {"__enter__": lambda s: s, "__exit__": lambda s, *a: seen.append((os.path.relpath(path, library), s.n)), "n": 0,
                                           "read": lambda s, k: (setattr(s, "n", s.n + k), f.read(k))[1], "seek": f.seek, "tell": f.tell})
            return counted()

    rows = [reader.rows(p, Watched()) for part in reader.partitions() for p in part.pieces]
    return rows, dict(seen), left


def test_what_is_not_asked_for_is_not_read(library):
    rows, seen, _ = opened(library, ["path", "length"])
    assert len(rows) == 7 and seen == {}
    _, seen, _ = opened(library, ["path", "sample_rate"])
    assert len(seen) == 7 and max(seen.values()) < 60
    no_roll, long = D.Not(D.StringContains(("name",), "roll")), D.GreaterThan(("length",), 50)
    rows, seen, left = opened(library, ["path", "x"], no_roll, long, D.EqualTo(("status",), "ok"))
    assert set(seen) == {"a/kick 1.wav", "a/Snare.WAV", "b/float.wav"} and [type(c) for c in left] == [D.EqualTo]


def test_conditions_reach_the_listing(spark, library):
    clips = source.read_wav(spark, str(library)).where(~F.col("name").contains("roll") & F.col("name").endswith(".wav") & (F.col("status") == "ok") & (F.col("length") > 50))
    plan = clips._jdf.queryExecution().executedPlan().toString()
    assert "status" in plan.split("Filter", 1)[1].split("\n")[0] and "roll" not in plan.split("Filter", 1)[1].split("\n")[0]
    assert {os.path.basename(r.path) for r in clips.collect()} == {"kick 1.wav", "Snare.WAV", "float.wav"}


def test_unknown_columns_and_paths(spark, library):
    with pytest.raises(Exception, match="no such column"):
        spark.read.format("wav").schema("path string, colour string").load(str(library)).collect()
    with pytest.raises(Exception, match="nowhere"):
        source.read_wav(spark, str(library / "nowhere")).collect()


def clips_of(spark, n, parts=4):
    rows = [(f"clip{i:03d}.wav", (X * i / n).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "name string, x array<double>").repartition(parts)


@pytest.mark.parametrize("encoding", ["pcm", "float"])
def test_written_files_read_back(spark, tmp_path, encoding):
    out = str(tmp_path / "out")
    source.write_wav(clips_of(spark, 20), out, 22050, encoding)
    got = {os.path.basename(r.path): r for r in source.read_wav(spark, out).collect()}
    assert len(got) == 20 and {r.sample_rate for r in got.values()} == {22050}
    for i in range(20):
        want = (X * i / 20).astype("float64").astype("float32")
        assert np.abs(np.array(got[f"clip{i:03d}.wav"].x) - want).max() <= (0 if encoding == "float" else 2**-16)
    source.write_wav(clips_of(spark, 3), out, 8000, encoding)
    assert source.read_wav(spark, out, ["path"]).count() == 23
    source.write_wav(clips_of(spark, 5), out, 8000, encoding, mode="overwrite")
    assert source.read_wav(spark, out, ["path"]).count() == 5
    assert sorted(os.listdir(tmp_path)) == ["out"]


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    out = str(tmp_path / "out")
    bad = clips_of(spark, 20).withColumn("x", F.when(F.col("name") == "clip013.wav", F.raise_error(F.lit("broken"))).otherwise(F.col("x")))
    with pytest.raises(Exception, match="broken"):
        source.write_wav(bad, out, 22050)
    assert os.listdir(tmp_path) == []
    source.write_wav(clips_of(spark, 4), out, 22050)
    with pytest.raises(Exception, match="same name"):
        source.write_wav(clips_of(spark, 4).union(clips_of(spark, 4)), out, 22050, mode="overwrite")
    with pytest.raises(Exception, match="not a file name"):
        source.write_wav(clips_of(spark, 4).withColumn("name", F.lit("../x.wav")), out, 22050, mode="overwrite")
    assert source.read_wav(spark, out, ["path"]).count() == 4 and os.listdir(tmp_path) == ["out"]


def test_an_empty_table_writes_an_empty_folder(spark, tmp_path):
    source.write_wav(clips_of(spark, 4).where("name = ''"), str(tmp_path / "out"), 22050, mode="overwrite")
    assert source.read_wav(spark, str(tmp_path / "out")).collect() == []
