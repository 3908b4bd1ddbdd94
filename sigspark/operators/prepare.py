"""From features to a training matrix: cap, codes, split, imputation, scaling, tensors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.config import DEFAULT, Settings
from sigspark.functions import arrays as A
from sigspark.operators.ranking import cap_per_class, label_codes, random_split
from sigspark.operators.segments import join_small
from sigspark.operators.spectral import cell_statistics

NOT_FEATURES = ("label", "code", "mel", "split")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that are there; other names do not matter."""
    return df.drop(*names)


def prepare(df: DataFrame, id_col: str, settings: Settings = DEFAULT, cap: int | None = None) -> DataFrame:
    """Cap rows per class, code the labels, split into train and test."""
    capped = cap_per_class(df, "label", id_col, cap or settings.cap_per_class)
    coded = join_small(capped, label_codes(capped, "label", id_col), ["label"])
    return random_split(coded, id_col, settings.test_share, settings.seed)


def feature_array(columns: list[str]) -> Column:
    """Feature columns as one array of doubles; NaN and infinities become NULL."""
    return F.transform(
        F.array(*[F.col(c).cast("double") for c in columns]),
        lambda v: F.when(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), v),
    )


def column_statistics(df: DataFrame, features: str = "features") -> DataFrame:
    """One row per feature (idx, mean, std, n_filled) over the filled cells.

    Cells are combined before the shuffle, so only one row per feature and
    task moves. A column that never varies gets std 1.
    """
    cells = df.select(F.posexplode(features).alias("idx", "v"))
    made = cells.groupBy("idx").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"), F.count("v").alias("n_filled")
    )
    return made.withColumn("std", F.when(F.col("std") > 0, F.col("std")).otherwise(F.lit(1.0)))


def as_arrays(statistics: DataFrame) -> DataFrame:
    """The per-feature rows (as many as features) as one row of arrays."""
    packed = F.sort_array(F.collect_list(F.struct("idx", "mean", "std")))
    return statistics.agg(packed.alias("p")).select(F.col("p.mean").alias("mean"), F.col("p.std").alias("std"))


def impute_mean(df: DataFrame, statistics: DataFrame, features: str = "features") -> DataFrame:
    """Fill gaps with the column means of ``statistics``."""
    means = as_arrays(statistics).select("mean").scalar()
    filled = df.withColumn("_mean", means)
    return filled.withColumn(features, F.zip_with(features, "_mean", lambda v, m: F.coalesce(v, m))).drop("_mean")


def standard_scale(df: DataFrame, statistics: DataFrame, features: str = "features") -> DataFrame:
    """(x - mean) / std per column, statistics from the training rows."""
    both = as_arrays(statistics)
    filled = df.withColumn("_mean", both.select("mean").scalar()).withColumn("_std", both.select("std").scalar())
    centred = F.zip_with(features, "_mean", lambda v, m: v - m)
    return filled.withColumn(features, F.zip_with(centred, "_std", lambda v, s: v / s)).drop("_mean", "_std")


def tensors(df: DataFrame, matrix: str = "mel", width: int | None = None) -> DataFrame:
    """Matrices scaled by the mean and std of all training cells, cut or filled to one width.

    Rows need ``split``; both parts use the training statistics. The result
    ``tensor`` has a channel level in front.
    """
    train = df.where(F.col("split") == "train").select(F.flatten(matrix).alias("_cells"))
    stats = cell_statistics(train, "_cells")
    known = df.withColumn("_mean", stats.select("mean").scalar()).withColumn("_std", stats.select("std").scalar())
    scaled = A.normalise(F.col(matrix), F.col("_mean"), F.col("_std"))
    fitted = F.transform(scaled, lambda row: A.fit_width(row, width or DEFAULT.tensor_width))
    return known.withColumn("tensor", A.with_channel(fitted)).drop("_mean", "_std")
