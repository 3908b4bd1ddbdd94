"""Time stretch and pitch shift of long signals as table work.

Frames, bins and steps are rows, so one signal is spread over many tasks:
neighbour frames meet in windows over chunks, phases are chunk-wise running sums,
and the output is an overlap-add by (signal, pos).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.functions.arrays import dft, hann, lit_array, lit_matrix
from sigspark.operators.frames import KEY, frame_arrays
from sigspark.operators.segments import attach, running_sum, with_halo
from sigspark.operators.series import lengths, resample_linear


def reflected(points: DataFrame, pad: int, size: int | None = None) -> DataFrame:
    """Points with ``pad`` mirrored points at both ends; adds n, the length before."""
    known = attach(points.select(KEY, "pos", "x"), lengths(points), [KEY], "pos", "n", size)
    mirror = F.array_compact(
        F.array(
            F.col("pos"),
            F.when(F.col("pos").between(1, pad), -F.col("pos")),
            F.when(F.col("pos").between(F.col("n") - 1 - pad, F.col("n") - 2), 2 * (F.col("n") - 1) - F.col("pos")),
        )
    )
    return known.withColumn("pos", F.explode(mirror)).withColumn("pos", F.col("pos") + pad)


def inverse_rows(n: int) -> tuple[list[list[float]], list[list[float]]]:
    """What a bin's real and imaginary part add to each point of a windowed frame of n points (n even)."""
    w = hann(n)
    cos, sin = [], []
    for k in range(n // 2 + 1):
        scale = (1.0 if k in (0, n // 2) else 2.0) / n
        cos.append([w[i] * scale * math.cos(2 * math.pi * k * i / n) for i in range(n)])
        sin.append([-w[i] * scale * math.sin(2 * math.pi * k * i / n) for i in range(n)])
    return cos, sin


def time_stretch(points: DataFrame, rate: float, length: int = 8, size: int | None = None) -> DataFrame:
    """Signal of length n / rate with the same pitch. Signals shorter than a frame are left out."""
    hop = length // 4
    padded = reflected(points, length // 2, size)
    packed = frame_arrays(padded, length, hop).where(F.col("n") == length)
    re, im = dft(F.col("frame"), length)
    polar = lambda a, b: F.struct(F.sqrt(a * a + b * b).alias("mag"), F.atan2(b, a).alias("angle"))
    spectra = packed.select(KEY, "frame_idx", F.zip_with(F.array(*re), F.array(*im), polar).alias("spec"))
    silent = F.transform("spec", lambda s: F.struct(F.lit(0.0).alias("mag"), F.lit(0.0).alias("angle")))
    w = Window.partitionBy(KEY, "_chunk").orderBy("frame_idx")
    pairs = with_halo(spectra, "frame_idx", 0, 1, size).withColumn("spec_next", F.lead("spec").over(w))
    pairs = pairs.where("_home").drop("_chunk", "_home").withColumn("spec_next", F.coalesce("spec_next", silent))
    first = F.ceil(F.col("frame_idx") / rate)
    last = F.ceil((F.col("frame_idx") + 1) / rate) - 1
    wanted = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    steps = pairs.withColumn("j", F.explode(wanted)).withColumn("share", F.col("j") * rate - F.col("frame_idx"))
    both = F.arrays_zip("spec", "spec_next")
    rows = steps.select(KEY, "j", "share", F.posexplode(both).alias("bin", "b")).select(
        KEY, "j", "share", "bin", F.col("b.spec.mag").alias("m0"), F.col("b.spec.angle").alias("a0"),
        F.col("b.spec_next.mag").alias("m1"), F.col("b.spec_next.angle").alias("a1"),
    )
    step = F.lit(math.pi * hop) * F.col("bin") / (length // 2)
    turn = F.col("a1") - F.col("a0") - step
    turn = step + turn - 2 * math.pi * F.rint(turn / (2 * math.pi))
    # phase of step j: the angle of the first frame and all turns before j
    moved = rows.withColumn("turn", turn).withColumn("start", F.when(F.col("j") == 0, F.col("a0")).otherwise(F.lit(0.0)))
    moved = moved.withColumn("part", F.col("turn") + F.col("start"))
    summed = running_sum(moved, [KEY, "bin"], "j", {"upto": "part"}, size)
    phase = F.col("upto") - F.col("turn")
    mag = (1 - F.col("share")) * F.col("m0") + F.col("share") * F.col("m1")
    # the inverse transform and the overlap-add are both sums: one exchange does both
    cos, sin = inverse_rows(length)
    re_out, im_out = mag * F.cos(phase), mag * F.sin(phase)
    adds = F.zip_with(
        F.get(lit_matrix(cos), F.col("bin")), F.get(lit_matrix(sin), F.col("bin")), lambda c, s: F.col("re") * c + F.col("im") * s
    )
    cells = summed.select(KEY, "j", "bin", re_out.alias("re"), im_out.alias("im")).withColumn("y", adds)
    placed = cells.select(KEY, "j", "bin", F.posexplode("y").alias("i", "v"))
    weight = F.when(F.col("bin") == 0, F.get(lit_array([v * v for v in hann(length)]), F.col("i"))).otherwise(F.lit(0.0))
    added = placed.groupBy(KEY, (F.col("j") * hop + F.col("i") - length // 2).alias("pos")).agg(
        F.sum("v").alias("v"), F.sum(weight).alias("w")
    )
    value = F.coalesce(F.try_divide(F.col("v"), F.when(F.col("w") > 1e-10, F.col("w"))), F.col("v"))
    out = added.where(F.col("pos") >= 0).select(KEY, "pos", value.alias("x"))
    # cut to round(n / rate); output positions run a frame past the end at most
    ends = lengths(points).select(
        KEY, F.greatest(F.col("n"), F.ceil(F.col("n") / rate) + 2 * length).alias("n"), F.round(F.col("n") / rate).alias("wanted")
    )
    return attach(out, ends, [KEY], "pos", "n", size).where(F.col("pos") < F.col("wanted")).select(KEY, "pos", "x")


def pitch_shift(points: DataFrame, semitones: float, length: int = 8, size: int | None = None) -> DataFrame:
    """Signal of the same length with a moved pitch: stretch, then resample back."""
    rate = 2.0 ** (-semitones / 12)
    moved = resample_linear(time_stretch(points, rate, length, size), 1.0 / rate).select(KEY, F.col("j").alias("pos"), "x")
    whole = points.select(KEY, "pos").join(moved, [KEY, "pos"], "left")
    return whole.select(KEY, "pos", F.coalesce("x", F.lit(0.0)).alias("x"))
