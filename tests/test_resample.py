"""Band-limited resampling, packed and as table work; float clips and late opening in the clip pipeline."""

import os

import numpy as np
import pytest
from clips import noise, tone, write
from pyspark.sql import functions as F

from sigspark.functions import dsp, wav
from sigspark.operators import series
from sigspark.plans import pipeline
from sigspark.sources import library
from sigspark.sources import wav as source


def sine(hz, rate, seconds=0.5):
    return np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)


def level(x):
    return np.sqrt(np.mean(np.square(x[200:-200])))


@pytest.mark.parametrize("rate,wanted", [(44100, 22050), (48000, 22050), (22050, 44100), (8000, 22050), (44101, 22050)])
def test_tones_below_the_limit_stay(rate, wanted):
    hz = 0.4 * min(rate, wanted)
    got = dsp.resample(sine(hz, rate), rate, wanted)
    assert len(got) == -(-int(rate * 0.5) * wanted // rate)
    want = sine(hz, wanted, 1)[: len(got)]
    assert np.abs(got - want)[200:-200].max() < 0.02
    assert np.allclose(dsp.resample(np.ones(5000), rate, wanted)[200:-200], 1)


@pytest.mark.parametrize("rate,hz", [(44100, 15000), (44100, 21000), (48000, 13500)])
def test_tones_above_the_limit_are_gone(rate, hz):
    assert level(dsp.resample(sine(hz, rate), rate, 22050)) < 1e-3
    assert level(np.interp(np.arange(11025) * rate / 22050, np.arange(int(rate * 0.5)), sine(hz, rate))) > 0.1  # what plain interpolation leaves


def test_blocks_of_targets_do_not_matter(monkeypatch):
    x = noise(1)
    whole = dsp.resample(x, 48000, 22050)
    monkeypatch.setattr(dsp, "BLOCK_TARGETS", 17)
    assert np.array_equal(whole, dsp.resample(x, 48000, 22050))
    assert len(dsp.resample(np.zeros(1), 44100, 22050)) == 1


@pytest.mark.parametrize("up,down,size", [(1, 2, 100), (2, 1, 64), (147, 320, 200), (3, 2, 4096)])
def test_table_equals_packed(spark, up, down, size):
    signals = {"a": noise(1, 0.03), "b": noise(2, 0.05)[:200], "c": np.array([0.5]), "d": noise(3, 0.05)[:401]}
    points = spark.createDataFrame([(k, i, float(v)) for k, x in signals.items() for i, v in enumerate(x)], "signal_id string, pos long, x double")
    got = {}
    for r in series.resample(points, up, down, size=size).orderBy("signal_id", "j").collect():
        got.setdefault(r.signal_id, []).append((r.j, r.x))
    for k, x in signals.items():
        want = dsp.resample(x, down, up)
        assert [j for j, _ in got[k]] == list(range(len(want)))
        assert np.allclose([v for _, v in got[k]], want, atol=1e-6)


def test_table_in_short_chunks_is_refused(spark):
    points = spark.createDataFrame([("a", 0, 1.0)], "signal_id string, pos long, x double")
    with pytest.raises(ValueError, match="shorter"):
        series.resample(points, 1, 2, size=64)


@pytest.fixture
def folder(tmp_path):
    write(tmp_path / "lib" / "kick.wav", tone(60))
    write(tmp_path / "lib" / "snare roll.wav", noise(2))
    write(tmp_path / "lib" / "clap.wav", noise(5))
    (tmp_path / "lib" / "tom broken.wav").write_bytes(b"RIFFxxxxWAVE" + b"no audio at all" * 10)
    (tmp_path / "lib" / "hat roll.wav").write_bytes(b"text")
    (tmp_path / "lib" / "snare float.wav").write_bytes(wav.encode(noise(1), 44100, "float"))
    return tmp_path / "lib"


def test_float_clips_are_described(spark, folder):
    rows = pipeline.describe_files(library.scan_library(spark, str(folder))).collect()
    assert {os.path.basename(r.path): r.reason for r in rows}["snare float.wav"] is None


def test_late_opening_gives_the_same_and_leaves_files_closed(spark, folder, tmp_path):
    asked = library.list_clips(spark, str(folder)).withColumn("_open", ~F.col("path").contains("roll"))
    held = {os.path.basename(r.path): r.content for r in library.with_content(asked, "_open").collect()}
    assert held["hat roll.wav"] is None and held["snare roll.wav"] is None and len(held["kick.wav"]) > 1000
    outcome = lambda df: {os.path.basename(r.path): (r.label, r.reason) for r in df.collect()}
    late = outcome(pipeline.build_catalog(spark, str(tmp_path / "run"), "20240101-000000-lib", str(folder), open_late=True))
    early = outcome(pipeline.describe_files(library.scan_library(spark, str(folder))))
    assert late.pop("hat roll.wav")[1] == "blacklisted" and early.pop("hat roll.wav")[1] == "unreadable"
    assert late == early and len(late) == 5


def test_a_file_that_has_gone_is_unreadable(spark, folder):
    listed = spark.createDataFrame(library.list_clips(spark, str(folder)).toArrow())
    os.remove(folder / "kick.wav")
    os.remove(folder / "snare roll.wav")
    rows = {os.path.basename(r.path): r.reason for r in pipeline.describe_files(listed).collect()}
    assert rows["kick.wav"] == "unreadable" and rows["snare roll.wav"] == "blacklisted"


def test_derived_clips_are_written_as_audio(spark, folder, tmp_path):
    from dataclasses import replace

    accepted, _ = pipeline.split_outcome(pipeline.describe_files(library.scan_library(spark, str(folder))))
    few, audio = replace(pipeline.DEFAULT, min_per_class=4), str(tmp_path / "audio")
    made = pipeline.augment_library(spark, accepted, str(tmp_path / "more"), str(folder), settings=few, root=str(folder), audio=audio)
    files = {os.path.basename(r.path): r for r in source.read_wav(spark, audio).collect()}
    rows = {r.new_name: r for r in made.collect()}
    assert len(rows) == 6 and set(files) == set(rows)
    for name, r in rows.items():
        assert np.abs(np.clip(r.x, -1, 1) - np.array(files[name].x)).max() < 2**-15 and files[name].sample_rate == 22050
