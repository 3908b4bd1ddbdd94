"""Feature groups: each takes a frame table and gives one row per signal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.functions.scalars import log10_pos
from sigspark.functions.summaries import SUMMARY_OPS, at_loudest, summaries
from sigspark.operators.frames import KEY, gradients, loud_span

N_CEPSTRAL = 12


def envelope(frames: DataFrame, hop_seconds: Column | float, share: float) -> DataFrame:
    """Attack, temporal centroid, duration and release over the loud span (all frames)."""
    hop = hop_seconds if isinstance(hop_seconds, Column) else F.lit(float(hop_seconds))
    span = loud_span(frames.withColumn("hop_s", hop), share)
    power = F.col("rms") * F.col("rms")
    length = F.col("last") - F.col("first") + 1
    where_in_span = F.coalesce(F.try_divide(F.col("frame_idx") - F.col("first"), length - 1), F.lit(0.0))
    sums = span.groupBy(KEY).agg(
        F.sum(power).alias("p"),
        F.sum(power * where_in_span).alias("pw"),
        F.first("peak").alias("peak"),
        F.first("first").alias("first"),
        F.first("last").alias("last"),
        F.first("hop_s").alias("hop"),
    )
    attack = (F.col("peak") - F.col("first")) * F.col("hop")
    attack_or_half = F.when(attack > 0, attack).otherwise(F.col("hop") / 2)
    centroid = F.when(F.col("p") > 0, F.col("pw") / F.col("p"))
    return sums.select(
        KEY,
        F.log10(attack_or_half).alias("log_attack_time"),
        centroid.alias("temporal_centroid"),
        F.when(centroid > 0, F.try_divide(F.log10(attack_or_half), centroid)).alias("lat_tc_ratio"),
        (F.col("hop") * (F.col("last") - F.col("first") + 1)).alias("duration"),
        (F.col("hop") * (F.col("last") - F.col("peak"))).alias("release"),
    )


def gradient_summaries(name: str, ops) -> list[Column]:
    return summaries(F.col(f"{name}_d"), f"{name}_d", ops, F.col(f"{name}_d_prev"))


def gradient_zcr_guard(features: DataFrame, name: str) -> DataFrame:
    """A single frame has no gradient, so no sign-change share either."""
    return features.withColumn(f"{name}_d_zcr", F.when(F.col(f"{name}_d_avg").isNotNull(), F.col(f"{name}_d_zcr")))


def crest() -> Column:
    return F.try_divide(F.max("rms"), F.avg("rms")).alias("crest_factor")


def rms_group() -> tuple[dict[str, Column], list[Column]]:
    log_rms = log10_pos("rms")
    ops = ["avg", "max", "min", "std", "zcr"]
    return {"log_rms": log_rms}, [
        crest(),
        *summaries(log_rms, "log_rms", ("avg", "std", "min", "max")),
        *gradient_summaries("log_rms", ops),
    ]


def zcr_group() -> list[Column]:
    return [
        *summaries(F.col("zcr"), "zcr", ("avg", "min", "max", "std")),
        at_loudest(F.col("zcr"), F.col("rms"), F.col("frame_idx"), "zcr_loudest"),
    ]


def spectral_group() -> tuple[dict[str, Column], list[Column]]:
    cent, band, flat = log10_pos("centroid"), log10_pos("bandwidth"), F.col("flatness")
    loud = lambda x, name: at_loudest(x, F.col("rms"), F.col("frame_idx"), name)
    aggs = [
        *summaries(cent, "log_spec_cent"),
        loud(cent, "log_spec_cent_loudest"),
        *gradient_summaries("log_spec_cent", ["avg", "max", "min", "std", "zcr"]),
        *summaries(band, "log_spec_band"),
        *gradient_summaries("log_spec_band", ["avg"]),
        *summaries(flat, "spec_flat"),
        loud(flat, "spec_flat_loudest"),
        *gradient_summaries("spec_flat", ["avg"]),
    ]
    for share in (15, 85):
        roll = log10_pos(f"rolloff_{share}")
        name = f"log_spec_rolloff_{share}"
        aggs += [loud(roll, f"{name}_loudest"), F.max(roll).alias(f"{name}_max"), F.min(roll).alias(f"{name}_min")]
    return {"log_spec_cent": cent, "log_spec_band": band, "spec_flat": flat}, aggs


def cepstral_group() -> tuple[dict[str, Column], list[Column]]:
    sources, aggs = {}, []
    for n in range(N_CEPSTRAL):
        coef = F.get("coef", F.lit(n))
        sources[f"mfcc_{n}"] = coef
        aggs += summaries(coef, f"mfcc_{n}")
        aggs.append(at_loudest(coef, F.col("rms"), F.col("frame_idx"), f"mfcc_{n}_loudest"))
        aggs += gradient_summaries(f"mfcc_{n}", ["avg"])
    return sources, aggs


def summary_features(valid: DataFrame, groups=("rms", "zcr", "spectral", "cepstral")) -> DataFrame:
    """All wanted groups over valid frames (with ``place``) in one aggregation.

    The gradient windows and the aggregation share their key, and the frame
    series are narrow, so this is the only heavy exchange after the framing.
    """
    sources: dict[str, Column] = {}
    aggs: list[Column] = []
    makers = {"rms": rms_group, "zcr": lambda: ({}, zcr_group()), "spectral": spectral_group, "cepstral": cepstral_group}
    for g in groups:
        src, made = makers[g]()
        sources |= src
        aggs += made
    rows = gradients(valid, sources) if sources else valid
    out = rows.groupBy(KEY).agg(*aggs)
    for name in ("log_rms", "log_spec_cent"):
        if f"{name}_d_zcr" in out.columns:
            out = gradient_zcr_guard(out, name)
    return out


def feature_names() -> list[str]:
    """The 119 numeric feature columns, in their fixed order."""
    names = ["log_attack_time", "temporal_centroid", "lat_tc_ratio", "duration", "release", "crest_factor"]
    names += [f"log_rms_{op}" for op in ("avg", "std", "min", "max")]
    names += [f"log_rms_d_{op}" for op in SUMMARY_OPS]
    names += [f"zcr_{op}" for op in ("avg", "min", "max", "std", "loudest")]
    names += [f"log_spec_cent_{op}" for op in ("avg", "min", "max", "std", "loudest")]
    names += [f"log_spec_cent_d_{op}" for op in SUMMARY_OPS]
    names += [f"log_spec_band_{op}" for op in ("avg", "min", "max", "std", "d_avg")]
    names += [f"spec_flat_{op}" for op in ("avg", "min", "max", "std", "loudest", "d_avg")]
    names += [f"log_spec_rolloff_{s}_{op}" for s in (15, 85) for op in ("loudest", "max", "min")]
    names += [f"mfcc_{n}_{op}" for n in range(N_CEPSTRAL) for op in ("avg", "min", "max", "std", "loudest", "d_avg")]
    return names
