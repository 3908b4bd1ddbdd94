"""Row-local maths on packed arrays: spectra, cepstra, mel bands, tensors.

All of it is built-in Spark functions, so a frame never leaves its row: no
explode, no shuffle. Small bases (DFT, DCT, mel) are literals in the plan.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit_array(values) -> Column:
    """A constant array, made in one call however long it is."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def lit_matrix(rows) -> Column:
    return F.array(*[lit_array(r) for r in rows])


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, also when ``use`` needs it per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


# ---- spectra -----------------------------------------------------------------


def hann(n: int) -> list[float]:
    """Periodic Hann window."""
    return [0.5 - 0.5 * math.cos(2 * math.pi * i / n) for i in range(n)]


def dft(frame: Column, n: int, window: bool = True) -> tuple[list[Column], list[Column]]:
    """Real and imaginary parts of bins 0..n/2 for short frames, as plain arithmetic."""
    w = hann(n) if window else [1.0] * n
    points = [F.get(frame, F.lit(i)) for i in range(n)]
    re, im = [], []
    for k in range(n // 2 + 1):
        cos = [w[i] * math.cos(2 * math.pi * k * i / n) for i in range(n)]
        sin = [-w[i] * math.sin(2 * math.pi * k * i / n) for i in range(n)]
        re.append(sum((p * F.lit(c) for p, c in zip(points[1:], cos[1:])), points[0] * F.lit(cos[0])))
        im.append(sum((p * F.lit(s) for p, s in zip(points[1:], sin[1:])), points[0] * F.lit(sin[0])))
    return re, im


def dft_magnitude(frame: Column, n: int) -> Column:
    re, im = dft(frame, n)
    return F.zip_with(F.array(*re), F.array(*im), lambda a, b: F.sqrt(a * a + b * b))


def rms_of_spectrum(mag: Column, n: int) -> Column:
    """Frame RMS from magnitudes; the first bin, and the last when n is even, count half."""
    bins = n // 2 + 1
    weights = [1.0] * bins
    weights[0] = 0.5
    if n % 2 == 0:
        weights[-1] = 0.5
    power = total(F.zip_with(mag, lit_array(weights), lambda m, w: m * m * w))
    return F.sqrt(2 * power / float(n * n))


def bin_hz(bins: int, sample_rate: int) -> list[float]:
    n = 2 * (bins - 1)
    return [k * sample_rate / n for k in range(bins)]


def centroid(mag: Column, hz: Column) -> Column:
    return F.try_divide(dot(mag, hz), total(mag))


def bandwidth(mag: Column, hz: Column, center: Column) -> Column:
    def spread(c: Column) -> Column:
        return total(F.zip_with(mag, hz, lambda m, f: m * (f - c) * (f - c)))

    return F.sqrt(F.try_divide(let(center, spread), total(mag)))


def flatness(mag: Column, floor: float = 1e-10) -> Column:
    power = F.transform(mag, lambda m: F.greatest(m * m, F.lit(floor)))
    n = F.size(mag)
    return F.exp(total(F.transform(power, lambda p: F.log(p))) / n) / (total(power) / n)


def rolloff(mag: Column, hz: Column, share: float) -> Column:
    """Lowest frequency where the running sum of magnitudes reaches ``share`` of all."""

    def bins_below(goal: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("below"))
        return F.aggregate(
            mag,
            start,
            lambda acc, m: F.struct(
                (acc["sum"] + m).alias("sum"),
                (acc["below"] + F.when(acc["sum"] + m < goal, 1).otherwise(0)).alias("below"),
            ),
            lambda acc: acc["below"],
        )

    return F.get(hz, let(share * total(mag), bins_below))


def dct_row(c: int, n: int) -> list[float]:
    """Row ``c`` of the orthonormal DCT-II of length n."""
    scale = math.sqrt((1.0 if c == 0 else 2.0) / n)
    return [scale * math.cos(math.pi * c * (2 * k + 1) / (2 * n)) for k in range(n)]


def cepstrum(mag: Column, n: int, first: int = 1, last: int = 12) -> Column:
    """Coefficients first..last; coefficient 0 is mostly volume and left out by default."""
    return F.array(*[dot(mag, lit_array(dct_row(c, n))) for c in range(first, last + 1)])


def mel_points(bands: int, top_hz: float) -> list[float]:
    """bands + 2 frequencies evenly spaced on the Slaney mel scale."""
    step, knee = 200.0 / 3, 1000.0
    log_step = math.log(6.4) / 27.0

    def to_mel(f: float) -> float:
        return f / step if f < knee else knee / step + math.log(f / knee) / log_step

    def to_hz(m: float) -> float:
        return m * step if m < knee / step else knee * math.exp(log_step * (m - knee / step))

    top = to_mel(top_hz)
    return [to_hz(top * i / (bands + 1)) for i in range(bands + 2)]


def mel_weights(bands: int, bins: int, sample_rate: int) -> list[list[float]]:
    """Triangles over the bins, each scaled to unit area."""
    hz = bin_hz(bins, sample_rate)
    points = mel_points(bands, sample_rate / 2)
    rows = []
    for b in range(bands):
        left, mid, right = points[b], points[b + 1], points[b + 2]
        rows.append(
            [
                max(0.0, min((f - left) / (mid - left), (right - f) / (right - mid))) * 2.0 / (right - left)
                for f in hz
            ]
        )
    return rows


def mel_bands(mag: Column, weights: list[list[float]]) -> Column:
    return F.array(*[dot(mag, lit_array(row)) for row in weights])


# ---- tensors and scores ---------------------------------------------------------


def fit_width(row: Column, width: int) -> Column:
    """Cut to ``width`` or fill with zeros at the end."""
    return F.slice(F.concat(row, F.array_repeat(F.lit(0.0), width)), 1, width)


def normalise(matrix: Column, mean: Column, std: Column) -> Column:
    return F.transform(matrix, lambda row: F.transform(row, lambda v: (v - mean) / std))


def with_channel(matrix: Column) -> Column:
    return F.array(matrix)


def lead_silence(x: Column, points: int) -> Column:
    return F.concat(F.array_repeat(F.lit(0.0), points), x)


def steps(n: int, first: float = 0.0, last: float = 1.0) -> Column:
    """n evenly spaced values; a single one is ``first``."""
    gap = (last - first) / (n - 1) if n > 1 else 0.0
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.lit(first) + i * gap)


def log_softmax(scores: Column) -> Column:
    def shifted(top: Column) -> Column:
        norm = top + F.log(total(F.transform(scores, lambda s: F.exp(s - top))))
        return let(norm, lambda n: F.transform(scores, lambda s: s - n))

    return let(F.array_max(scores), shifted)


def decibel_array(x: Column, floor: float = 1e-5, range_db: float = 80.0) -> Column:
    """Amplitudes in dB, nothing lower than the highest minus ``range_db``."""
    db = F.transform(x, lambda v: 20 * F.log10(F.greatest(v, F.lit(floor))))
    low = lambda top: F.transform(db, lambda v: F.greatest(v, top - range_db))
    return let(F.array_max(db), low)


def first_argmax(scores: Column) -> Column:
    """0-based place of the largest score, the first when tied."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
