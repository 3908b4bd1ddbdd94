"""The transform in array expressions against numpy's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.functions import dsp, fft


@pytest.mark.parametrize("n", [4, 8, 16, 64, 2048])
def test_spectra_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    frames = [rng.normal(size=n + 3) for _ in range(4)] + [np.zeros(n), np.eye(n)[1], np.cos(np.arange(n)), 1e6 * np.ones(n)]
    df = spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(frames)], "i int, f array<double>")
    out = df.select("i", fft.rfft(F.col("f"), n).alias("s"), fft.magnitude(F.col("f"), n).alias("m"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for r in out.collect():
        want = np.fft.rfft(frames[r.i][:n])
        scale = 1e-9 * (1 + np.abs(want).max())
        assert len(r.s.re) == n // 2 + 1 and np.abs(np.array(r.s.re) + 1j * np.array(r.s.im) - want).max() < scale
        assert np.abs(np.array(r.m) - np.abs(np.fft.rfft(frames[r.i][:n] * dsp.window(n)))).max() < scale


def test_short_frames_and_odd_lengths(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([],)], "f array<double>")
    assert [r.m for r in df.select(fft.magnitude(F.col("f"), 4).alias("m")).collect()] == [None, None, None]
    for n in (2, 6, 100):
        with pytest.raises(ValueError, match="power of two"):
            fft.rfft(F.col("f"), n)
