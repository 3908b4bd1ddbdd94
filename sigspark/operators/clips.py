"""Packed clips: onset span, slice and frame series, all without a shuffle of samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.config import DEFAULT, Settings
from sigspark.functions import dsp
from sigspark.functions.arrays import let, total

SERIES = ("rms", "zcr", "centroid", "bandwidth", "flatness", "rolloff_15", "rolloff_85")
FRAME = T.StructType(
    [T.StructField("frame_idx", T.LongType())]
    + [T.StructField(n, T.DoubleType()) for n in SERIES]
    + [T.StructField("coef", T.ArrayType(T.DoubleType()))]
)


def packed_strength(flux: Column, shift: int) -> Column:
    """Onset strength 0..1 of a flux array, moved right by ``shift`` frames."""
    moved = F.slice(F.concat(F.array_repeat(F.lit(0.0), shift), flux), F.lit(1), F.size(flux))

    def scaled(a: Column) -> Column:
        low, span = F.array_min(a), F.array_max(a) - F.array_min(a)
        return let(F.struct(low.alias("l"), span.alias("s")), lambda b: F.transform(a, lambda v: F.coalesce(F.try_divide(v - b["l"], b["s"]), F.lit(0.0))))

    return let(moved, scaled)


def packed_onsets(strength: Column, settings: Settings = DEFAULT) -> Column:
    """(first, second) onset frame of a strength array; the same rules as for frame rows."""
    s = settings

    def near(a: Column, i: Column, back: int, ahead: int) -> Column:
        first = F.greatest(i - back, F.lit(0))
        return F.slice(a, first + 1, i + ahead + 1 - first)

    def peaks(a: Column) -> Column:
        def is_peak(v: Column, i: Column) -> Column:
            around = near(a, i, s.onset_average, s.onset_average)
            mean = let(around, lambda r: total(r) / F.size(r))
            return (v == F.array_max(near(a, i, s.onset_pre_max, 0))) & (v >= mean + s.onset_delta)

        # the cheap test first: no peak without the least rise over a mean that is never negative
        at = F.transform(a, lambda v, i: F.when(v >= s.onset_delta, F.when(is_peak(v, i), i)))
        return F.array_compact(at)

    def first_two(p: Column) -> Column:
        first = F.array_min(p)
        later = let(first, lambda f: F.filter(p, lambda v: v > f + s.onset_wait))
        return F.struct(first.alias("first_onset"), F.array_min(later).alias("second_onset"))

    return let(let(strength, peaks), first_two)


def with_spans(clips: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Add start_time, end_time, orig_duration and new_duration."""
    s = settings
    strength = packed_strength(F.col("flux"), s.frame_length // (2 * s.onset_hop))
    found = clips.withColumn("_o", packed_onsets(strength, s)).drop("flux")
    back, step = s.onset_silence + s.onset_margin, s.onset_hop / s.sample_rate
    start = F.coalesce(F.greatest(F.col("_o.first_onset") * step - back, F.lit(0.0)), F.lit(0.0))
    timed = found.withColumn("start_time", start).withColumn("end_time", F.col("_o.second_onset") * step - back)
    timed = timed.withColumn("orig_duration", F.size("x") / F.lit(float(s.sample_rate)))
    return timed.withColumn(
        "new_duration", F.coalesce("end_time", "orig_duration") - F.col("start_time")
    ).drop("_o")


def slice_clip(x: Column, offset: Column, seconds: Column, rate: int) -> Column:
    """Samples of [offset, offset + seconds); NULL when more than one sample is missing."""
    n = F.floor(seconds * rate).cast("int")
    part = F.slice(x, F.floor(offset * rate).cast("int") + 1, F.greatest(n, F.lit(0)))
    return let(part, lambda p: F.when((F.size(p) + 1 >= n) & (F.size(p) > 0), p))


def frame_series(clips: DataFrame, settings: Settings = DEFAULT, mel: bool = True) -> DataFrame:
    """Frame series and mel matrix per clip from column ``x``; clips of under 4 samples give NULL.

    One Arrow step makes all series; samples stop here and only the narrow
    series go on. Long recordings are transformed a block of frames at a time.
    """
    s = settings
    keep = [f for f in clips.schema.fields if f.name != "x"]
    schema = T.StructType(
        [
            *keep,
            T.StructField("frame_length", T.IntegerType()),
            T.StructField("frames", T.ArrayType(FRAME)),
            T.StructField("mel", T.ArrayType(T.ArrayType(T.FloatType()))),
        ]
    )

    def one(x: np.ndarray | None):
        if x is None or len(x) < s.hop_divisor:
            return None, None, None
        length = min(s.frame_length, len(x))
        hop = length // s.hop_divisor
        blocks, mels = [], []
        for mag in dsp.spectra(np.asarray(x, "float64"), length, hop):
            blocks.append(dsp.series_of(mag, length, s.sample_rate, s.n_cepstral))
            if mel:
                mels.append(mag @ dsp.mel_matrix(s.n_mels, mag.shape[1], s.sample_rate).T)
        made = {n: np.concatenate([b[n] for b in blocks]) for n in blocks[0]}
        made["zcr"] = dsp.zero_crossings(np.asarray(x, "float64"), length, hop)[: len(made["rms"])]
        rows = [
            {"frame_idx": i, **{n: float(made[n][i]) for n in SERIES}, "coef": made["coef"][i]}
            for i in range(len(made["rms"]))
        ]
        return length, rows, list(np.concatenate(mels).T.astype("float32")) if mel else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [one(x) for x in pdf["x"]]
            out = pdf.drop(columns="x")
            for i, name in enumerate(("frame_length", "frames", "mel")):
                out[name] = pd.Series([m[i] for m in made], index=out.index, dtype=object)
            yield out

    return clips.mapInPandas(run, schema)


def derive_clips(jobs: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """New samples for (x, method, factor) rows: pitch shifts and stretches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [
                dsp.shift_pitch(np.asarray(x), f) if m == "pitch" else dsp.stretch(np.asarray(x), f)
                for x, m, f in zip(pdf["x"], pdf["method"], pdf["factor"])
            ]
            yield pdf.assign(x=pd.Series(made, index=pdf.index, dtype=object))

    return jobs.mapInPandas(run, jobs.schema)
