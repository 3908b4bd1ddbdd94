"""Frames of a signal in long form, and series of frame values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.operators.segments import attach, with_halo, with_positions

KEY = "signal_id"


def into_frames(points: DataFrame, length: int, hop: int) -> DataFrame:
    """One row per point and frame the point belongs to: adds ``frame_idx``.

    Frame j covers points j*hop .. j*hop + length - 1.
    """
    pos = F.col("pos")
    if hop == length:
        return points.withColumn("frame_idx", F.floor(pos / length))
    first = F.greatest(F.ceil((pos - (length - 1)) / hop), F.lit(0).cast("long"))
    return points.withColumn("frame_idx", F.explode(F.sequence(first, F.floor(pos / hop))))


def frame_rms(points: DataFrame, length: int, hop: int | None = None) -> DataFrame:
    """RMS per frame, straight from the points."""
    framed = into_frames(points, length, hop or length)
    return framed.groupBy(KEY, "frame_idx").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.col("x") * F.col("x"))).alias("rms"), F.avg("x").alias("mean")
    )


def frame_arrays(points: DataFrame, length: int, hop: int | None = None) -> DataFrame:
    """Frames as packed arrays (at most ``length`` points each)."""
    framed = into_frames(points, length, hop or length)
    packed = F.sort_array(F.collect_list(F.struct("pos", "x")))
    return (
        framed.groupBy(KEY, "frame_idx")
        .agg(packed.alias("_p"))
        .select(KEY, "frame_idx", F.size("_p").alias("n"), F.col("_p.x").alias("frame"))
    )


def describe_arrays(packed: DataFrame, size: int | None = None) -> DataFrame:
    """rms and zcr of packed frames that do not overlap; signs are taken against the mean of the signal.

    The mean joins the frames, not the points: an eighth of the rows or less.
    """
    sums = packed.select(KEY, "frame_idx", "n", F.aggregate("frame", F.lit(0.0), lambda a, v: a + v).alias("s"))
    levels = sums.groupBy(KEY).agg(
        (F.sum("s") / F.sum("n")).alias("level"), (F.max("frame_idx") + 1).alias("n_frames")
    )
    known = attach(packed, levels, [KEY], "frame_idx", "n_frames", size)
    known = known.withColumn("y", F.transform("frame", lambda v: v - F.col("level")))
    return known.select(
        KEY,
        "frame_idx",
        "n",
        array_rms(F.col("frame")).alias("rms"),
        array_rms(F.col("y")).alias("rms_centred"),
        array_zcr(F.col("y")).alias("zcr"),
    )


def array_rms(frame: Column) -> Column:
    return F.sqrt(F.aggregate(frame, F.lit(0.0), lambda a, v: a + v * v) / F.size(frame))


def array_zcr(frame: Column) -> Column:
    """Share of the points in the frame that change sign against the point before."""
    pairs = F.zip_with(
        F.slice(frame, 2, F.greatest(F.size(frame) - 1, F.lit(0))),
        F.slice(frame, 1, F.greatest(F.size(frame) - 1, F.lit(0))),
        lambda a, b: F.when((a < 0) != (b < 0), 1).otherwise(0),
    )
    return F.aggregate(pairs, F.lit(0), lambda a, v: a + v) / F.size(frame)


def valid_frames(frames: DataFrame, min_rms: float, max_frames: int | None = None) -> DataFrame:
    """Frames loud enough to describe; only the first ``max_frames`` when given."""
    kept = frames.where(F.col("rms") >= min_rms)
    return kept.where(F.col("frame_idx") < max_frames) if max_frames is not None else kept


def signals_without(all_signals: DataFrame, kept: DataFrame) -> DataFrame:
    """Signals with no row in ``kept``."""
    return all_signals.select(KEY).distinct().join(kept.select(KEY).distinct(), KEY, "left_anti")


def too_quiet(frames: DataFrame, min_rms: float, max_frames: int | None = None) -> DataFrame:
    """Signals whose loudest frame is below the limit."""
    head = frames if max_frames is None else frames.where(F.col("frame_idx") < max_frames)
    return head.groupBy(KEY).agg(F.max("rms").alias("max_rms")).where(F.col("max_rms") < min_rms)


def ranked(frames: DataFrame, bounded: bool) -> DataFrame:
    """Number the frames that are left without holes (``place``).

    ``bounded`` says that a signal has few frames (the first 44, say); else the
    ranking is cut into ranges for heavy signals.
    """
    if bounded:
        w = Window.partitionBy(KEY).orderBy("frame_idx")
        return frames.withColumn("place", (F.row_number().over(w) - 1).cast("long"))
    return with_positions(frames, [KEY], "frame_idx", out="place")


def gradients(frames: DataFrame, columns: dict[str, Column], size: int | None = None) -> DataFrame:
    """Gradient of each column along ``place`` and the gradient of the row before.

    Inside (next - previous) / 2, one-sided at both ends, NULL for a single
    row. Adds ``<name>_d`` and ``<name>_d_prev``.
    """
    cut = with_halo(frames.withColumns({f"_v_{n}": c for n, c in columns.items()}), "place", 2, 1, size)
    w = Window.partitionBy(KEY, "_chunk").orderBy("place")
    slopes, previous = {}, {}
    for n in columns:
        here, back, ahead = F.col(f"_v_{n}"), F.lag(f"_v_{n}").over(w), F.lead(f"_v_{n}").over(w)
        has_back, has_ahead = F.lag("place").over(w).isNotNull(), F.lead("place").over(w).isNotNull()
        slopes[f"{n}_d"] = (
            F.when(has_back & has_ahead, (ahead - back) / 2)
            .when(has_ahead, ahead - here)
            .when(has_back, here - back)
        )
        previous[f"{n}_d_prev"] = F.lag(f"{n}_d").over(w)
    return (
        cut.withColumns(slopes)
        .withColumns(previous)
        .where("_home")
        .drop("_chunk", "_home", *[f"_v_{n}" for n in columns])
    )


def loud_span(frames: DataFrame, share: float, size: int | None = None) -> DataFrame:
    """Frames between the first and the last that reach ``share`` of the peak RMS.

    Adds peak (first loudest frame), first, last and n_frames of the signal.
    """
    peaks = frames.groupBy(KEY).agg(
        F.max("rms").alias("max_rms"),
        F.min(F.struct((-F.col("rms")).alias("r"), "frame_idx"))["frame_idx"].alias("peak"),
        (F.max("frame_idx") + 1).alias("n_frames"),
    )
    known = attach(frames, peaks, [KEY], "frame_idx", "n_frames", size)
    loud = F.when(F.col("rms") >= share * F.col("max_rms"), F.col("frame_idx"))
    spans = known.groupBy(KEY).agg(
        F.min(loud).alias("first"),
        F.max(loud).alias("last"),
        F.first("peak").alias("peak"),
        F.first("n_frames").alias("n_frames"),
    )
    spanned = attach(frames, spans, [KEY], "frame_idx", "n_frames", size)
    return spanned.where(F.col("frame_idx").between(F.col("first"), F.col("last")))
