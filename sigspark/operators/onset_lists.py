"""All onsets of recordings of any length, in chunks.

``onset_envelope`` and ``peaks`` need neighbour frames and a few numbers per recording: windows over (key, chunk) with a halo, and
joins by (key, chunk). The wait rule - no onset until ``wait`` frames have passed since the one before - runs through a whole recording,
but what it carries from frame to frame is small: how many more frames are blocked, 0 to ``wait``. A chunk is thus a function on wait + 1
states. ``onsets`` makes that function for every chunk, composes the functions of FAN neighbours to one, and so on upwards; on the way
down every chunk learns the state it begins with and picks its onsets. No task holds more than one chunk or FAN functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.functions.arrays import total
from sigspark.operators.frames import KEY
from sigspark.operators.segments import attach, with_halo
from sigspark.session import stored

CHUNK_FRAMES = 4096
FAN = 64


def onset_envelope(frames: DataFrame, shift: int = 0, range_db: float = 80.0, size: int = CHUNK_FRAMES) -> DataFrame:
    """(signal_id, frame_idx, strength): mean positive dB rise between neighbour frames, moved by ``shift`` frames and scaled to 0..1.

    The same as ``operators.onsets.onset_envelope``, without a window over a recording. ``frames`` has ``power`` (a value per band) and frame numbers from 0 without gaps.
    """
    loud = frames.select(KEY, "frame_idx", F.transform("power", lambda p: 10 * F.log10(F.greatest(p, F.lit(1e-10)))).alias("db"))
    facts = loud.groupBy(KEY).agg((F.max("frame_idx") + 1).alias("n"), (F.max(F.array_max("db")) - range_db).alias("floor"))
    loud = attach(loud, facts, [KEY], "frame_idx", "n", size)
    loud = loud.select(KEY, "frame_idx", F.transform("db", lambda v: F.greatest(v, F.col("floor"))).alias("db"))
    cut = with_halo(loud, "frame_idx", 1, 0, size)
    before = F.lag("db").over(Window.partitionBy(KEY, "_chunk").orderBy("frame_idx"))
    rises = cut.withColumn("before", before).where("_home")
    rise = F.zip_with("db", "before", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    flux = rises.select(KEY, "frame_idx", F.coalesce(total(rise) / F.size("db"), F.lit(0.0)).alias("flux"))
    if shift:
        lengths = facts.select(KEY, "n")
        moved = attach(flux, lengths, [KEY], "frame_idx", "n", size).withColumn("frame_idx", F.col("frame_idx") + shift)
        still = lengths.select(KEY, F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(shift), F.col("n")) - 1)).alias("frame_idx"), F.lit(0.0).alias("flux"))
        flux = moved.where(F.col("frame_idx") < F.col("n")).select(KEY, "frame_idx", "flux").unionByName(still)
    ends = flux.groupBy(KEY).agg((F.max("frame_idx") + 1).alias("n"), F.min("flux").alias("low"), F.max("flux").alias("high"))
    scaled = F.try_divide(F.col("flux") - F.col("low"), F.col("high") - F.col("low"))
    return attach(flux, ends, [KEY], "frame_idx", "n", size).select(KEY, "frame_idx", F.coalesce(scaled, F.lit(0.0)).alias("strength"))


def peaks(envelope: DataFrame, pre_max: int, average: int, delta: float, size: int = CHUNK_FRAMES) -> DataFrame:
    """(signal_id, frame_idx) of the frames that are the largest of themselves and the ``pre_max`` before, and at least the local mean plus ``delta``."""
    cut = with_halo(envelope.select(KEY, "frame_idx", "strength"), "frame_idx", max(pre_max, average), average, size)
    order = Window.partitionBy(KEY, "_chunk").orderBy("frame_idx")
    top = F.max("strength").over(order.rowsBetween(-pre_max, 0))
    mean = F.avg("strength").over(order.rowsBetween(-average, average))
    marked = cut.withColumn("top", top).withColumn("mean", mean).where("_home")
    return marked.where((F.col("strength") == F.col("top")) & (F.col("strength") >= F.col("mean") + delta)).select(KEY, "frame_idx")


def _after(functions: Column, first: Column, last: Column, state: Column) -> Column:
    """The state behind place ``last``, from ``state`` at place ``first``, through sorted (at, f); a place without a function ends in state 0."""
    begin = F.struct((first - 1).alias("at"), state.alias("s"))

    def through(acc: Column, e: Column) -> Column:
        now = F.when(e["at"] == acc["at"] + 1, acc["s"]).otherwise(F.lit(0))
        return F.struct(e["at"].alias("at"), F.get(e["f"], now).alias("s"))

    return F.aggregate(functions, begin, through, lambda acc: F.when(acc["at"] == last, acc["s"]).otherwise(F.lit(0)))


def first_states(functions: DataFrame, wait: int, fan: int = FAN) -> DataFrame:
    """(signal_id, at, s): the state before every place of ``functions`` (signal_id, at, f), if recordings begin in state 0.

    The functions of ``fan`` places become one; their places are solved first, the same way.
    """
    group = F.floor(F.col("at") / fan)
    held = functions.groupBy(KEY, group.alias("g")).agg(F.sort_array(F.collect_list(F.struct("at", "f"))).alias("fs"))
    first, last = F.col("g") * fan, F.col("g") * fan + fan - 1
    if functions.where(F.col("at") >= fan).isEmpty():
        starts = held.withColumn("s", F.lit(0))
    else:
        states = F.transform(F.sequence(F.lit(0), F.lit(wait)), lambda s: _after(F.col("fs"), first, last, s))
        above = stored(held.select(KEY, F.col("g").alias("at"), states.alias("f")), "onset-functions")
        starts = held.join(first_states(above, wait, fan).withColumnRenamed("at", "g"), [KEY, "g"])
    each = F.transform("fs", lambda e: F.struct(e["at"].alias("at"), _after(F.filter("fs", lambda b: b["at"] < e["at"]), first, e["at"] - 1, F.col("s")).alias("s")))
    return starts.select(KEY, F.inline(each))


def onsets(marked: DataFrame, wait: int, size: int = CHUNK_FRAMES, fan: int = FAN) -> DataFrame:
    """(signal_id, frame_idx): of the peaks those more than ``wait`` frames after the onset before."""
    if size <= wait:
        raise ValueError("a chunk must be longer than the wait")
    chunk = F.floor(F.col("frame_idx") / size)
    place = (F.col("frame_idx") - chunk * size).cast("int")
    held = marked.groupBy(KEY, chunk.alias("at")).agg(F.sort_array(F.collect_list(place)).alias("peaks"))
    held = stored(held, "onset-peaks")
    # the first free place after all peaks, from the first free place at the start
    free = lambda s: F.aggregate("peaks", s, lambda b, p: F.when(p >= b, p + wait + 1).otherwise(b))
    states = F.transform(F.sequence(F.lit(0), F.lit(wait)), lambda s: F.greatest(free(s) - size, F.lit(0)))
    begun = held.join(first_states(held.select(KEY, "at", states.alias("f")), wait, fan), [KEY, "at"])
    start = F.struct(F.array().cast("array<int>").alias("found"), F.col("s").alias("b"))

    def pick(acc: Column, p: Column) -> Column:
        taken = F.struct(F.concat(acc["found"], F.array(p)).alias("found"), (p + wait + 1).alias("b"))
        return F.when(p >= acc["b"], taken).otherwise(acc)

    picked = F.aggregate("peaks", start, pick, lambda acc: acc["found"])
    return begun.select(KEY, "at", F.explode(picked).alias("p")).select(KEY, (F.col("at") * size + F.col("p")).alias("frame_idx"))


def onset_list(frames: DataFrame, pre_max: int, average: int, delta: float, wait: int, shift: int = 0, size: int = CHUNK_FRAMES, fan: int = FAN) -> DataFrame:
    """(signal_id, frame_idx) of every onset of recordings given as power frames."""
    envelope = onset_envelope(frames, shift, size=size)
    return onsets(peaks(envelope, pre_max, average, delta, size), wait, size, fan)
