"""Operators on signals in long form (signal_id, pos, x)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.functions.arrays import dot, let, lit_matrix
from sigspark.functions.dsp import ZEROS, sinc_phases
from sigspark.operators.frames import KEY
from sigspark.operators.segments import attach, with_halo

RESAMPLE_CHUNK = 4096


def lengths(points: DataFrame) -> DataFrame:
    return points.groupBy(KEY).agg((F.max("pos") + 1).alias("n"))


def peak_normalise(points: DataFrame, size: int | None = None) -> DataFrame:
    """Divide by the largest absolute value of the signal; a silent signal stays as it is."""
    peaks = points.groupBy(KEY).agg((F.max("pos") + 1).alias("n"), F.max(F.abs("x")).alias("peak"))
    scaled = F.coalesce(F.try_divide(F.col("x"), F.col("peak")), F.col("x"))
    return attach(points, peaks, [KEY], "pos", "n", size).withColumn("y", scaled)


def slice_points(points: DataFrame, bounds: DataFrame, size: int | None = None) -> DataFrame:
    """Points in [start, end) of each signal; ``bounds`` has start, end and n.

    A signal too short for its range (more than one point missing) is left out.
    """
    fits = bounds.where(F.least("end", "n") - F.col("start") + 1 >= F.col("end") - F.col("start"))
    cut = attach(points, fits, [KEY], "pos", "n", size)
    return cut.where((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("end")))


def centred(points: DataFrame, size: int | None = None) -> DataFrame:
    """Signal minus its mean."""
    means = points.groupBy(KEY).agg((F.max("pos") + 1).alias("n_points"), F.avg("x").alias("level"))
    return attach(points, means, [KEY], "pos", "n_points", size).withColumn("x", F.col("x") - F.col("level"))


def resample_linear(points: DataFrame, step: float) -> DataFrame:
    """Values at source positions 0, step, 2*step, ... by linear interpolation.

    Each point meets the next one by an equi-join on (signal, pos), then makes
    the target points that fall between the two: no group, no window.
    """
    here = points.select(KEY, "pos", "x")
    following = points.select(KEY, (F.col("pos") - 1).alias("pos"), F.col("x").alias("x_next"))
    pairs = here.join(following, [KEY, "pos"], "left")
    first = F.ceil(F.col("pos") / step)
    last = F.ceil((F.col("pos") + 1) / step) - 1
    wanted = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    targets = pairs.withColumn("j", F.explode(wanted))
    share = F.col("j") * step - F.col("pos")
    at_end = F.col("x_next").isNull()
    return targets.where(~at_end | (share == 0)).select(
        KEY, "j", F.when(at_end, F.col("x")).otherwise(F.col("x") + share * (F.col("x_next") - F.col("x"))).alias("x")
    )


def resample(points: DataFrame, up: int, down: int, zeros: int = ZEROS, size: int = RESAMPLE_CHUNK) -> DataFrame:
    """Band-limited change of the rate by up / down: (signal_id, j, x) for target positions j * down / up.

    Chunks of ``size`` points, with as many neighbour points as the filter reaches, become one array each; a target is the
    product of a slice of it with its phase's weights (``dsp.sinc_phases``). Only points near a chunk's edge are copied, so a
    signal of any length is spread over as many tasks as it has chunks. Silence is assumed before and after a signal.
    """
    weights = sinc_phases(up, down, zeros)
    reach = weights.shape[1] // 2
    if size <= 2 * reach:
        raise ValueError(f"chunks of {size} points are shorter than the filter, {2 * reach} points")
    cut = with_halo(points.select(KEY, "pos", "x"), "pos", reach, reach, size)
    held = cut.groupBy(KEY, "_chunk").agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col("x").cast("double").alias("x")))).alias("_s"),
        F.max(F.when(F.col("_home"), F.col("pos"))).alias("_last"),
    )
    held = held.where(F.col("_last").isNotNull())
    begin = F.col("_chunk") * size
    # the array starts reach points before the chunk; there is nothing before a signal and after its end
    ahead = F.array_repeat(F.lit(0.0), (F.col("_s")[0]["pos"] - (begin - reach)).cast("int"))
    whole = F.concat(ahead, F.transform("_s", lambda p: p["x"]), F.array_repeat(F.lit(0.0), 2 * reach))
    first, last = F.ceil(begin * up / down), F.ceil((F.col("_last") + 1) * up / down) - 1
    table = lit_matrix(weights)

    def target(a, j):
        base, phase = F.floor(j * down / up), F.pmod(j * down, F.lit(up)).cast("int")
        near = F.slice(a, (base - begin + 2).cast("int"), F.lit(2 * reach))
        return dot(near, F.get(table, phase))

    targets = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    made = let(whole, lambda a: F.transform(targets, lambda j: F.struct(j.alias("j"), target(a, j).alias("x"))))
    return held.select(KEY, F.inline(made))
