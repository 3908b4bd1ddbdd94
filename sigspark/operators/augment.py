"""Which clips to derive for small classes, and names of derived clips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.config import DEFAULT, Settings
from sigspark.functions.arrays import lit_array
from sigspark.functions.scalars import flat_name, hash60, stem, suffix
from sigspark.operators.ranking import class_counts
from sigspark.operators.segments import join_small, with_positions

BLOCK = 100_000


def augment_plan(
    clips: DataFrame, id_col: str, label: str, target: Column | int | None = None, settings: Settings = DEFAULT
) -> DataFrame:
    """(label, method, factor, job, id): derived clips that lift every class to ``target`` rows.

    Half of what is missing comes from pitch shifts, the rest from stretching.
    Clips are taken in seeded order, all clips once per parameter, and the
    neutral parameter is not used.
    """
    target = target if isinstance(target, Column) else F.lit(settings.min_per_class if target is None else target)
    counts = class_counts(clips, label)
    lack = counts.select(label, "n", F.greatest(target - F.col("n"), F.lit(0)).alias("lack"))
    pitch = F.floor(F.col("lack") / 2)
    halves = lack.select(
        label,
        "n",
        F.explode(
            F.array(
                F.struct(F.lit("pitch").alias("method"), pitch.alias("todo")),
                F.struct(F.lit("stretch").alias("method"), (F.col("lack") - pitch).alias("todo")),
            )
        ).alias("h"),
    ).select(label, "n", "h.*")
    # numbers 0 .. todo-1, made in blocks so that a large gap is not one task's work
    blocks = halves.where(F.col("todo") > 0).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("todo") - 1) / BLOCK)))
    )
    spread = blocks.repartition(label, "method", "block")
    last = F.least((F.col("block") + 1) * BLOCK, F.col("todo")) - 1
    jobs = spread.withColumn("job", F.explode(F.sequence(F.col("block") * BLOCK, last)))
    pitches = lit_array(p for p in settings.pitch_steps if p != 0)
    stretches = lit_array(s for s in settings.stretch_factors if s != 1.0)
    turn = F.floor(F.col("job") / F.col("n"))
    factor = F.when(F.col("method") == "pitch", F.get(pitches, turn % F.size(pitches))).otherwise(
        F.get(stretches, turn % F.size(stretches))
    )
    jobs = jobs.select(label, "method", factor.alias("factor"), (F.col("job") % F.col("n")).alias("_place"), "job")
    order = clips.select(label, id_col, hash60(F.lit(settings.seed), F.col(id_col)).alias("_h"))
    places = with_positions(order, [label], "_h", (id_col,), "_place").drop("_h")
    return jobs.join(places, [label, "_place"]).drop("_place")


def derived_name(factor: Column, path: Column | str, root: str = "") -> Column:
    """``<factor>_<path below the library, / as __>``."""
    return F.concat_ws("_", factor.cast("string"), flat_name(path, root))


def free_names(df: DataFrame, name: str, order: str, out: str = "new_name") -> DataFrame:
    """Make names unique by adding ``_new`` before the suffix as often as needed.

    Names that already end in ``_new`` belong to the row of names they would
    run into, so all names of one root share one numbering.
    """
    plain = F.regexp_replace(stem(name), "(_new)+$", "")
    level = ((F.length(stem(name)) - F.length(plain)) / 4).cast("int")
    parts = df.withColumn("_root", plain).withColumn("_suffix", suffix(name)).withColumn("_level", level)
    keys = ["_root", "_suffix"]
    sizes = parts.groupBy(*keys, "_level").agg(F.count(F.lit(1)).alias("_rows"))
    up = Window.partitionBy(*keys).orderBy("_level")
    before = F.coalesce(F.sum("_rows").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumn("_before", before).withColumn(
        "_start", F.col("_before") + F.max(F.col("_level") - F.col("_before")).over(up)
    )
    ranked = with_positions(parts, [*keys, "_level"], order, out="_rank")
    # only roots with several levels start later than their own level
    late = sizes.where(F.col("_start") != F.col("_level")).select(*keys, "_level", "_start")
    placed = join_small(ranked, late, [*keys, "_level"])
    times = (F.coalesce("_start", F.col("_level")) + F.col("_rank")).cast("int")
    made = F.concat("_root", F.repeat(F.lit("_new"), times), "_suffix")
    return placed.withColumn(out, made).select(*df.columns, out)
