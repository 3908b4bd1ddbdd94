"""Frames of signals that arrive in pieces, against the same frames of whole signals."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from sigspark.operators import frames
from sigspark.streaming import samples

SCHEMA = "signal_id string, start long, x array<double>, total long, ts timestamp"
START = datetime(2024, 1, 1)
SIGNALS = {"a": 53, "b": 16, "c": 3, "d": 40}


def pieces(seed, know=True):
    """Pieces of 1 to 9 samples, some of them twice, in any order."""
    rng = np.random.default_rng(seed)
    rows = []
    for name, n in SIGNALS.items():
        x = np.random.default_rng(ord(name)).normal(size=n)
        at = 0
        while at < n:
            size = int(rng.integers(1, 10))
            rows += [(name, at, x[at : at + size].tolist(), n if know else None, START + timedelta(seconds=int(rng.integers(0, 60))))] * int(rng.integers(1, 3))
            at += size
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


def whole(spark, length, hop):
    rows = [(k, i, float(v)) for k, n in SIGNALS.items() for i, v in enumerate(np.random.default_rng(ord(k)).normal(size=n))]
    made = frames.frame_rms(spark.createDataFrame(rows, "signal_id string, pos long, x double"), length, hop)
    return {(r.signal_id, r.frame_idx): (r.n, r.rms, r.mean) for r in made.collect()}


def fed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def result(df):
    rows = df.collect()
    made = {(r.signal_id, r.frame_idx): (r.n, r.rms, r.mean) for r in rows}
    assert len(made) == len(rows)
    return made


def same(got, want):
    assert got.keys() == want.keys()
    assert np.allclose([got[k] for k in want], [want[k] for k in want])


@pytest.mark.parametrize("seed,length,hop", [(1, 8, 8), (2, 8, 4), (3, 6, 4)])
def test_any_order_gives_the_frames_of_whole_signals(spark, tmp_path, seed, length, hop):
    rows, folder = pieces(seed), str(tmp_path / "in")
    for part in np.array_split(np.arange(len(rows)), 4):
        fed(spark, folder, [rows[i] for i in part])
    got = samples.run_frames(stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "mark"), length, hop)
    same(result(got), whole(spark, length, hop))


def test_a_restarted_stream_goes_on(spark, tmp_path):
    rows, folder = pieces(5), str(tmp_path / "in")
    run = lambda: samples.run_frames(stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "mark"), 8)
    fed(spark, folder, rows[: len(rows) // 2])
    first = run().count()
    fed(spark, folder, rows[len(rows) // 2 :])
    same(result(run()), whole(spark, 8, 8))
    assert 0 < first < len(whole(spark, 8, 8))
    fed(spark, folder, rows)  # everything once more
    same(result(run()), whole(spark, 8, 8))


def test_quiet_signals_are_closed(spark, tmp_path):
    """Without a known length the last frames come once event time has moved on."""
    folder = str(tmp_path / "in")
    run = lambda: samples.run_frames(stream(spark, folder), str(tmp_path / "out"), str(tmp_path / "mark"), 8, idle="10 minutes", delay="5 minutes")
    fed(spark, folder, pieces(6, know=False))
    full = {k: v for k, v in whole(spark, 8, 8).items() if v[0] == 8}
    same(result(run()), full)
    for minutes in (60, 61):
        fed(spark, folder, [("z", 0, [1.0], None, START + timedelta(minutes=minutes))])
    same(result(run()), whole(spark, 8, 8))


def test_settings_of_the_session_come_back(spark):
    key = next(iter(samples.STORE))
    before = spark.conf.get(key)
    with samples.disk_state(spark):
        assert "RocksDB" in spark.conf.get(key)
    assert spark.conf.get(key) == before


class Kept:
    """A state variable in memory that counts the calls made to it."""

    def __init__(self):
        self.rows, self.calls = {}, 0

    def __getattr__(self, name):
        self.calls += 1
        rows = self.rows
        return {
            "containsKey": rows.__contains__, "getValue": rows.get, "updateValue": rows.__setitem__, "removeKey": lambda k: rows.pop(k, None),
            "keys": lambda: iter(list(rows)), "clear": rows.clear, "exists": lambda: () in rows, "get": lambda: rows[()], "update": lambda v: rows.__setitem__((), v),
        }[name]


class Handle:
    def __init__(self):
        self.made = []

    def getMapState(self, *_):
        self.made.append(Kept())
        return self.made[-1]

    getValueState = getMapState

    def registerTimer(self, due):
        pass

    deleteTimer = registerTimer


def test_calls_to_the_state_do_not_grow_with_the_frames():
    """Every other piece first, then the rest: a few calls for each block of frames, not for each frame."""
    import pandas as pd

    x, handle = np.random.default_rng(3).normal(size=4000), Handle()
    assembler = samples.FrameAssembler(8, 4, 1000)
    assembler.init(handle)
    made = []
    for part in (range(0, 4000, 10), range(5, 4000, 10)):
        pdf = pd.DataFrame([(at, x[at : at + 5], 4000, pd.Timestamp(START)) for at in part], columns=["start", "x", "total", "ts"])
        made += list(assembler.handleInputRows(("a",), iter([pdf]), None))
    got = pd.concat(made)
    assert got["frame_idx"].tolist() == list(range(1000)) and np.allclose(got["mean"], [x[f * 4 : f * 4 + 8].mean() for f in range(1000)])
    assert sum(kept.calls for kept in handle.made) < 200 and not handle.made[0].rows
