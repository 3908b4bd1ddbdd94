import numpy as np
import pytest
from clips import RATE, noise, tone, wav_bytes, write
from pyspark.sql import functions as F

from sigspark.functions import dsp
from sigspark.operators import clips, features, onsets
from sigspark.plans import pipeline
from sigspark.sources import library, registry


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("lib")
    write(root / "Kicks" / "deep.wav", tone(60))
    write(root / "snares" / "one.wav", noise(1))
    write(root / "snares" / "Snare roll.wav", noise(2))
    write(root / "that clap.wav", noise(3))
    write(root / "that snare.wav", noise(4))
    write(root / "clap.wav", noise(5))
    write(root / "hat long.wav", tone(3000, seconds=6, fade=False))
    write(root / "hat quiet.wav", tone(3000, level=0.001))
    write(root / "tom stereo.wav", tone(120, rate=44100), rate=44100, channels=2)
    (root / "tom broken.wav").write_bytes(b"RIFFxxxxWAVE" + b"no audio at all" * 10)
    (root / "tom text.wav").write_bytes(b"text")
    (root / "notes.txt").write_text("kick")
    return root


@pytest.fixture(scope="module")
def described(spark, folder):
    return pipeline.describe_files(library.scan_library(spark, str(folder)))


def test_outcomes(described, folder):
    got = {r.path[len(str(folder)) + 1 :]: (r.label, r.reason) for r in described.collect()}
    assert got == {
        "Kicks/deep.wav": ("kick", None),
        "snares/one.wav": ("snare", None),
        "snares/Snare roll.wav": (None, "blacklisted"),
        "that clap.wav": (None, "ignored"),
        "that snare.wav": ("snare", None),
        "clap.wav": (None, "unlabelled"),
        "hat long.wav": ("hat", "too_long"),
        "hat quiet.wav": ("hat", "too_quiet"),
        "tom stereo.wav": ("tom", None),
        "tom broken.wav": ("tom", "unreadable"),
        "tom text.wav": ("tom", "unreadable"),
    }


def test_eval_mode_has_no_label_or_length_rule(spark, folder):
    rows = pipeline.describe_files(library.scan_library(spark, str(folder)), training=False).collect()
    reasons = {r.path[len(str(folder)) + 1 :]: r.reason for r in rows}
    assert reasons["hat long.wav"] is None and reasons["clap.wav"] is None
    assert reasons["tom text.wav"] == "unreadable" and reasons["hat quiet.wav"] == "too_quiet"


def test_feature_rows(spark, described, tmp_path):
    made = pipeline.extract_features(described)
    names = features.feature_names()
    assert len(names) == 119 and made.columns == ["signal_id", "label", *names, "mel"]
    rows = {r.signal_id.rsplit("/", 1)[1]: r for r in made.collect()}
    assert len(rows) == 4
    kick, snare = rows["deep.wav"], rows["one.wav"]
    assert kick.log_spec_cent_avg < snare.log_spec_cent_avg
    assert kick.spec_flat_avg < snare.spec_flat_avg
    assert kick.zcr_avg < 0.02 < snare.zcr_avg
    assert len(kick.mel) == 128
    # 44.1 kHz stereo comes in at the common rate: its 120 Hz tone lies between the other two
    tom = rows["tom stereo.wav"]
    assert kick.log_spec_cent_loudest < tom.log_spec_cent_loudest < snare.log_spec_cent_loudest
    assert 10**tom.log_spec_rolloff_15_loudest < 200


def test_known_spectra():
    length, k = 2048, 100
    x = np.sin(2 * np.pi * k * np.arange(length * 8) / length)
    mag = next(dsp.spectra(x, length, 512))[8:12]
    made = dsp.series_of(mag, length, RATE, 13)
    assert np.allclose(made["centroid"], k * RATE / length, rtol=1e-2)
    white = dsp.series_of(np.ones((2, 1025)), length, RATE, 13)
    assert np.allclose(white["flatness"], 1) and np.allclose(white["coef"], 0)
    # Hann window: power 3/8 of the plain frame
    assert np.allclose(made["rms"], np.sqrt(0.5 * 3 / 8), rtol=1e-2)


def test_frame_series_match_plain_maths():
    x = noise(9, seconds=0.3)
    n, hop = 2048, 512
    padded = np.pad(x, n // 2, mode="reflect")
    w = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)
    s = np.array([np.abs(np.fft.rfft(padded[i : i + n] * w)) for i in range(0, len(padded) - n + 1, hop)])
    got = np.concatenate(list(dsp.spectra(x, n, hop)))
    assert got.shape[0] == 1 + len(x) // hop and np.allclose(got, s)
    edge = np.pad(x, n // 2, mode="edge")
    z = [np.mean(np.diff(np.signbit(edge[i : i + n]).astype(int), prepend=np.signbit(edge[i])) != 0) for i in range(0, len(edge) - n + 1, hop)]
    assert np.allclose(dsp.zero_crossings(x, n, hop), z)


def test_long_recordings_in_blocks(monkeypatch):
    x = noise(3, seconds=1.0)
    whole = dsp.onset_flux(x, RATE, 2048, 110, 128)
    monkeypatch.setattr(dsp, "BLOCK_FRAMES", 13)
    assert np.allclose(dsp.onset_flux(x, RATE, 2048, 110, 128), whole)


@pytest.mark.parametrize("width", [1, 2, 3])
def test_decode_widths(width):
    x = tone(440, 0.1, fade=False)
    rate, y = dsp.decode_wav(wav_bytes(x, width=width))
    assert rate == RATE and np.allclose(x, y, atol=0.02 if width == 1 else 1e-3)


def test_two_clicks_give_two_onsets(spark):
    x = np.zeros(RATE * 2)
    for at in (0.5, 1.2):
        i = int(at * RATE)
        x[i : i + 2000] = 0.8 * np.exp(-np.arange(2000) / 300) * np.random.default_rng(0).uniform(-1, 1, 2000)
    files = spark.createDataFrame([("a", bytearray(wav_bytes(x)))], "signal_id string, content binary")
    decoded = library.decode(files).cache()
    packed = clips.with_spans(decoded).select("start_time", "end_time").first()
    assert abs(packed.start_time - 0.49) < 0.03 and abs(packed.end_time - 1.19) < 0.03
    # the same through frame rows and windows
    rows = decoded.select("signal_id", F.posexplode("flux").alias("frame_idx", "flux"))
    moved = clips.packed_strength(F.col("flux"), 9)
    long = decoded.select("signal_id", F.posexplode(moved).alias("frame_idx", "strength"))
    found = onsets.sound_span(onsets.first_two_onsets(long, 6, 20, 0.07, 6), 110 / RATE, 1.0, 0.01).first()
    assert rows.count() == long.count()
    assert abs(found.start_time - packed.start_time) < 1e-9 and abs(found.end_time - packed.end_time) < 1e-9


def test_stretch_keeps_frequency():
    x = tone(440, 1.0, fade=False)
    y = dsp.stretch(x, 1.25)
    assert abs(len(y) - len(x) / 1.25) <= 1

    def peak(a):
        a = a[2000:-2000]
        return np.argmax(np.abs(np.fft.rfft(a * np.hanning(len(a)), 1 << 17))) * RATE / (1 << 17)

    assert abs(peak(y) - 440) < 3
    z = dsp.shift_pitch(x, 12)
    assert len(z) == len(x) and abs(peak(z[: len(z) * 3 // 4]) - 880) < 8


def test_runs(spark, folder, tmp_path):
    root = str(tmp_path)
    described = pipeline.build_catalog(spark, root, "20240101-000000-lib", str(folder))
    accepted = registry.read_dataset(spark, root, "catalog")
    rejects = registry.read_dataset(spark, root, "rejects")
    assert accepted.count() + rejects.count() == described.count() == 11
    table = pipeline.store_features(spark, root, "20240101-000000-lib", pipeline.extract_features(described))
    assert table.count() == accepted.count()
    reports = registry.runs(spark, root)
    assert reports.count() == 2
    last = registry.latest(reports).first().report
    assert '"n_columns":"122"' in last and "mfcc_11_d_avg" in last and "sample_library_path" in last
    calls = []
    again = registry.run_or_load(spark, root, "catalog", "20240101-000000-lib", lambda: calls.append(1), False)
    assert again.count() == 4 and not calls
    with pytest.raises(ValueError):
        registry.run_or_load(spark, root, "catalog", None, lambda: None, False)


def test_augmented_library(spark, folder, described, tmp_path):
    from dataclasses import replace

    accepted, _ = pipeline.split_outcome(described)
    made = pipeline.augment_library(
        spark, accepted, str(tmp_path / "more"), str(folder), settings=replace(pipeline.DEFAULT, min_per_class=5), root=str(folder)
    )
    counts = {r.label: r["count"] for r in made.groupBy("label").count().collect()}
    assert counts == {"kick": 4, "snare": 3, "tom": 4}
    names = [r.new_name for r in made.collect()]
    assert len(set(names)) == 11 and any(n.endswith("_Kicks__deep.wav") for n in names)
    assert made.where("method = 'stretch' and size(x) = 0").count() == 0


def test_keyed_scan(spark, folder):
    want = [("0", f"{folder}/Kicks/deep.wav"), ("1", f"{folder}/none.wav")]
    got = library.scan_keyed(spark, spark.createDataFrame(want, "key string, path string"), str(folder))
    rows = {r.key: r.length is not None for r in got.collect()}
    assert rows == {"0": True, "1": False}
    one = library.scan_library(spark, f"{folder}/Kicks/deep.wav")
    assert one.count() == 1
    plan = library.scan_library(spark, str(folder)).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_knn_on_clips(spark, folder, described, tmp_path):
    """Clip ids are paths: training, keeping and keyed prediction of the nearest-rows model."""
    from dataclasses import replace

    from sigspark.plans import predict

    root, run = str(tmp_path), "20240101-000000-lib"
    names = features.feature_names()
    rows = pipeline.extract_features(described).drop("mel")
    # each clip a few times, so that both parts of the split hold every class
    copies = rows.crossJoin(spark.range(8).withColumnRenamed("id", "copy"))
    many = copies.withColumn("signal_id", F.concat("signal_id", F.lit("#"), F.col("copy").cast("string"))).select("signal_id", "label", *names)
    registry.write_dataset(many, root, "features", run)
    settings = replace(pipeline.DEFAULT, neighbours=1, impute_rounds=1)
    made, report, model_id = predict.train_run(spark, root, run, "knn", settings)
    assert report.where("name = 'kick'").count() == 1 and model_id.startswith("KNN_")
    asked = spark.createDataFrame([("0", f"{folder}/Kicks/deep.wav"), ("1", f"{folder}/snares/one.wav"), ("2", f"{folder}/tom text.wav"), ("3", f"{folder}/none.wav")], "key string, path string")
    kept = predict.load_model(spark, root, run, model_id)
    outcome = {r.key: r.outcome for r in predict.predict_keyed(spark, asked, kept, str(folder)).collect()}
    assert outcome == {"0": "kick", "1": "snare", "2": "Unreadable", "3": "Unreadable"}
