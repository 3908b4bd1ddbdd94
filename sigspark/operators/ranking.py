"""Splits, caps and draws that are exact, repeatable and never sort a whole table in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.functions.scalars import hash60, hash_unit
from sigspark.operators.segments import join_small, with_positions

# hash values have 60 bits; the upper 16 choose the histogram slot
SLOT_SHIFT = 44
GROUP_LIMIT = 1000


def split_by_hash(
    df: DataFrame,
    id_col: str,
    wanted: Column,
    seed: int,
    by: list[str] | None = None,
    names: tuple[str, str] = ("test", "train"),
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Give the first ``wanted`` rows in hash order to ``names[0]``, per group.

    ``wanted`` is an expression of ``n``, the rows of the group, and of the columns of ``per_group``. The row where
    the count is reached is found from a histogram of hash slots and a ranking
    of the one slot it falls in; all rows are then compared with it.
    """
    by = list(by or [])
    keys = by or ["_all"]
    base = df if by else df.withColumn("_all", F.lit(0))
    rows = base.withColumn("_h", hash60(F.lit(seed), F.col(id_col)))
    slots = rows.groupBy(*keys, F.shiftright("_h", SLOT_SHIFT).alias("_slot")).agg(F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(*keys)
    upto = whole.orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    counted = slots.withColumn("n", F.sum("_rows").over(whole)).withColumn("_upto", F.sum("_rows").over(upto))
    if per_group is not None:
        counted = join_small(counted, per_group, keys)
    counted = counted.withColumn("_wanted", wanted.cast("long"))
    edge_slot = counted.where(
        (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_rows") < F.col("_wanted"))
    ).select(*keys, "_slot", (F.col("_wanted") - F.col("_upto") + F.col("_rows")).alias("_left"))
    slim = rows.select(*keys, "_h", id_col)
    in_slot = join_small(slim.withColumn("_slot", F.shiftright("_h", SLOT_SHIFT)), edge_slot, [*keys, "_slot"], "inner")
    w = whole.orderBy("_h", id_col)
    edge = in_slot.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == F.col("_left"))
    edge = edge.select(*keys, F.col("_h").alias("_edge_h"), F.col(id_col).alias("_edge_id"))
    marked = join_small(rows, edge, keys)
    first = (F.col("_h") < F.col("_edge_h")) | ((F.col("_h") == F.col("_edge_h")) & (F.col(id_col) <= F.col("_edge_id")))
    name = F.when(F.coalesce(first, F.lit(False)), names[0]).otherwise(names[1])
    return marked.select(*df.columns, name.alias("split"))


def random_split(df: DataFrame, id_col: str, share: float, seed: int) -> DataFrame:
    """ceil(share * n) rows become ``test``."""
    return split_by_hash(df, id_col, F.ceil(F.col("n") * share), seed)


def stratified_split(df: DataFrame, id_col: str, label: str, share: float, seed: int) -> DataFrame:
    """round(share * n) rows of every class become ``validation``."""
    return split_by_hash(df, id_col, F.round(F.col("n") * share), seed, [label], ("validation", "train"))


def apportion(counts: DataFrame, label: str, share: float) -> DataFrame:
    """(label, quota): ceil(share * rows) rows shared out over the classes of ``counts`` (label, n) in proportion.

    Every class gets the whole part of its due; what is left goes to the largest remainders, one each, ties to the
    smaller label. Remainders are integers, so nothing depends on rounding.
    """
    whole = counts.agg(F.sum("n").cast("long").alias("_n"))
    counts = counts.crossJoin(F.broadcast(whole)).withColumn("_total", F.ceil(F.col("_n") * share).cast("long"))
    due = F.col("_total") * F.col("n")
    rest = F.pmod(due, F.col("_n"))
    parts = counts.withColumns({"_base": ((due - rest) / F.col("_n")).cast("long"), "_less": -rest})
    spare = parts.agg((F.max("_total") - F.sum("_base")).alias("_spare"))
    ranked = with_positions(parts, [], "_less", (label,), "_rank").crossJoin(F.broadcast(spare))
    return ranked.select(label, (F.col("_base") + (F.col("_rank") < F.col("_spare")).cast("long")).alias("quota"))


def apportioned_split(df: DataFrame, id_col: str, label: str, share: float, seed: int) -> DataFrame:
    """ceil(share * n) rows become ``validation``, shared out over the classes by largest remainders."""
    quotas = apportion(class_counts(df, label), label, share)
    return split_by_hash(df, id_col, F.col("quota"), seed, [label], ("validation", "train"), quotas)


def cap_per_class(df: DataFrame, label: str, order: str, n: int) -> DataFrame:
    """The first n rows of each class.

    Up to GROUP_LIMIT rows the window keeps only n rows per class and task
    before the shuffle; beyond, heavy classes are ranked in ranges.
    """
    if n <= GROUP_LIMIT:
        w = Window.partitionBy(label).orderBy(order)
        ranked = df.withColumn("_rank", F.row_number().over(w))
        return ranked.where(F.col("_rank") <= n).drop("_rank")
    return with_positions(df, [label], order, out="_rank").where(F.col("_rank") < n).drop("_rank")


def label_codes(df: DataFrame, label: str, order: str) -> DataFrame:
    """(label, code) with codes in order of first appearance."""
    first = df.groupBy(label).agg(F.min(order).alias("first_row"))
    return with_positions(first, [], "first_row", (label,), "code").select(
        F.col(label).alias("label"), F.col("code").cast("int").alias("code")
    )


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """1 / class count on every row."""
    weights = class_counts(df, label).select(label, (1.0 / F.col("n")).alias("weight"))
    return join_small(df, weights, [label])


def balanced_sample(df: DataFrame, id_col: str, label: str, seed: int) -> DataFrame:
    """As many draws with replacement as there are rows, each class equally likely.

    Every row makes one draw: a hash chooses the class, another the row inside
    it; drawn rows are found by an equi-join on (class, rank in class).
    """
    ranked = with_positions(df, [label], id_col, out="_rank")
    counts = class_counts(df, label)
    choice = with_positions(counts, [], label, out="_class")
    n_classes = counts.agg(F.count(F.lit(1)).alias("k")).scalar()
    draws = df.select(F.col(id_col).alias("draw_id"))
    draws = draws.withColumn("_k", n_classes).withColumn(
        "_class", F.floor(hash_unit(F.lit(seed), F.lit("class"), F.col("draw_id")) * F.col("_k")).cast("long")
    )
    drawn = join_small(draws, choice, ["_class"], "inner").withColumn(
        "_rank", F.floor(hash_unit(F.lit(seed), F.lit("row"), F.col("draw_id")) * F.col("n")).cast("long")
    )
    return drawn.select("draw_id", label, "_rank").join(ranked, [label, "_rank"]).drop("_rank")
