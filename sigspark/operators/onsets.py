"""Onset strength per frame and the start and end of the first sound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.config import DEFAULT, Settings
from sigspark.functions.arrays import total
from sigspark.operators.frames import KEY


def day_bands(events: DataFrame, bands: tuple[str, ...]) -> DataFrame:
    """Energy per (user, day) and event type as band frames without holes.

    Windows over a user hold one row per day, however many events the user has.
    """
    day = F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01")))
    sums = [F.sum(F.when(F.col("event_type") == b, F.col("value")).otherwise(0.0)) for b in bands]
    days = events.groupBy(F.col("user_id").alias(KEY), day.alias("day")).agg(F.array(*sums).alias("power"))
    w = Window.partitionBy(KEY).orderBy("day")
    first = F.min("day").over(Window.partitionBy(KEY))
    until = F.coalesce(F.lead("day").over(w) - 1, F.col("day"))
    filled = days.withColumn("first", first).withColumn("until", until)
    filled = filled.withColumn("d", F.explode(F.sequence("day", "until")))
    silent = F.transform("power", lambda _: F.lit(0.0))
    power = F.when(F.col("d") == F.col("day"), F.col("power")).otherwise(silent)
    return filled.select(KEY, (F.col("d") - F.col("first")).cast("long").alias("frame_idx"), power.alias("power"))


def onset_envelope(frames: DataFrame, shift: int = 0, range_db: float = 80.0) -> DataFrame:
    """Mean positive dB rise between neighbour frames, scaled to 0..1.

    ``frames`` has ``power`` (one value per band). Windows hold the frames of
    one recording or the days of one user, both limited by time, not by rows.
    """
    db = F.transform("power", lambda p: 10 * F.log10(F.greatest(p, F.lit(1e-10))))
    whole = Window.partitionBy(KEY)
    order = whole.orderBy("frame_idx")
    loud = frames.select(KEY, "frame_idx", db.alias("db"))
    loud = loud.withColumn("floor", F.max(F.array_max("db")).over(whole) - range_db)
    loud = loud.select(
        KEY, "frame_idx", F.transform("db", lambda v: F.greatest(v, F.col("floor"))).alias("db")
    ).withColumn("before", F.lag("db").over(order))
    rise = F.zip_with("db", "before", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    flux = loud.select(
        KEY, "frame_idx", F.coalesce(total(rise) / F.size("db"), F.lit(0.0)).alias("flux")
    )
    flux = flux.withColumn("flux", F.coalesce(F.lag("flux", shift).over(order), F.lit(0.0)) if shift else F.col("flux"))
    low, high = F.min("flux").over(whole), F.max("flux").over(whole)
    return flux.withColumn("low", low).withColumn("high", high).select(
        KEY,
        "frame_idx",
        F.coalesce(F.try_divide(F.col("flux") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0)).alias("strength"),
    )


def first_two_onsets(envelope: DataFrame, pre_max: int, average: int, delta: float, wait: int) -> DataFrame:
    """First onset frame and the next one more than ``wait`` frames later.

    A frame is a peak when it is the largest of itself and the ``pre_max``
    frames before, and at least the local mean plus ``delta``.
    """
    order = Window.partitionBy(KEY).orderBy("frame_idx")
    top = F.max("strength").over(order.rowsBetween(-pre_max, 0))
    mean = F.avg("strength").over(order.rowsBetween(-average, average))
    peak = (F.col("strength") == F.col("top")) & (F.col("strength") >= F.col("mean") + delta)
    marked = envelope.withColumn("top", top).withColumn("mean", mean).withColumn("at", F.when(peak, F.col("frame_idx")))
    marked = marked.withColumn("first", F.min("at").over(Window.partitionBy(KEY)))
    later = F.when(F.col("at") > F.col("first") + wait, F.col("at"))
    return marked.groupBy(KEY).agg(F.min("at").alias("first_onset"), F.min(later).alias("second_onset"))


def sound_span(onsets: DataFrame, frame_seconds: Column | float, silence: float, margin: float) -> DataFrame:
    """Start and end in seconds: (0, NULL) without onsets; ends before the second onset."""
    step = frame_seconds if isinstance(frame_seconds, Column) else F.lit(float(frame_seconds))
    back = silence + margin
    start = F.greatest(F.col("first_onset") * step - back, F.lit(0.0))
    return onsets.withColumn("start_time", F.coalesce(start, F.lit(0.0))).withColumn(
        "end_time", F.col("second_onset") * step - back
    )


def clip_spans(bands: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Start and end of clips from their mel power frames at the onset hop."""
    s = settings
    env = onset_envelope(bands, shift=s.frame_length // (2 * s.onset_hop))
    found = first_two_onsets(env, s.onset_pre_max, s.onset_average, s.onset_delta, s.onset_wait)
    return sound_span(found, s.onset_hop / s.sample_rate, s.onset_silence, s.onset_margin)
