"""Reports on predictions and training runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.operators.segments import join_small


def pair_counts(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Rows per (true, predicted) pair: all reports start from this small table."""
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy, macro and weighted averages.

    Undefined values count as 0.
    """
    pairs = pair_counts(df, label, predicted)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").cast("string").alias("name"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("chosen"),
                    F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").cast("string").alias("name"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("chosen"),
                    F.lit(0).cast("long").alias("hit"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    per = sides.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("support", "chosen", "hit")])
    precision = F.coalesce(F.try_divide(F.col("hit"), F.col("chosen")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hit"), F.col("support")), F.lit(0.0))
    per = per.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    per = per.withColumn("f1", F.coalesce(f1, F.lit(0.0)))
    shares = ("precision", "recall", "f1")
    weighted = [F.coalesce(F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")), F.lit(0.0)) for c in shares]
    sums = per.agg(
        *[F.avg(c).alias(f"m_{c}") for c in shares],
        *[w.alias(f"w_{c}") for w, c in zip(weighted, shares)],
        F.coalesce(F.try_divide(F.sum("hit"), F.sum("support")), F.lit(0.0)).alias("acc"),
        F.sum("support").alias("support"),
    )

    def line(name: str, *values: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), *[v.alias(c) for v, c in zip(values, shares)], F.col("support"))

    acc = F.col("acc")
    overall = sums.select(
        F.explode(
            F.array(
                line("accuracy", acc, acc, acc),
                line("macro avg", *[F.col(f"m_{c}") for c in shares]),
                line("weighted avg", *[F.col(f"w_{c}") for c in shares]),
            )
        ).alias("l")
    ).select("l.*")
    return per.select("name", *shares, "support").unionByName(overall)


def confusion(df: DataFrame, classes: list, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Share of each true class that went to each predicted class, one column ``p_<class>`` per class."""
    pairs = pair_counts(df, label, predicted)
    wide = pairs.groupBy("label").agg(
        F.sum("n").alias("_all"),
        *[F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(f"p_{c}") for c in classes],
    )
    return wide.select("label", *[(F.col(f"p_{c}") / F.col("_all")).alias(f"p_{c}") for c in classes])


def class_accuracy(df: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """Percent right per class, and over all rows rounded to a whole number (class NULL)."""
    hit = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    made = pair_counts(df, label, predicted).rollup("label").agg(
        hit.alias("correct"), F.sum("n").alias("total"), F.grouping("label").alias("_g")
    )
    percent = 100.0 * F.col("correct") / F.col("total")
    return made.select(
        "label", "correct", "total", F.when(F.col("_g") == 1, F.round(percent)).otherwise(percent).alias("percent")
    )


def epoch_means(metrics: DataFrame) -> DataFrame:
    """Mean of the batch values per run, epoch and split."""
    return metrics.groupBy("run_id", "epoch", "split").agg(F.avg("value").alias("value"))


def early_stop(losses: DataFrame, patience: int) -> DataFrame:
    """Where each run stops: after ``patience`` epochs without a lower loss; and its best epoch until then.

    One row per epoch and run comes in, so a window holds the epochs of a run.
    """
    w = Window.partitionBy("run_id").orderBy("epoch")
    before = F.min("loss").over(w.rowsBetween(Window.unboundedPreceding, -1))
    better = F.when(before.isNull() | (F.col("loss") < before), F.col("epoch"))
    seen = losses.withColumn("_better", better).withColumn(
        "_last", F.max("_better").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    stop = F.min(F.when(F.col("epoch") - F.col("_last") >= patience, F.col("epoch"))).over(Window.partitionBy("run_id"))
    run = seen.withColumn("_stop", stop).where(F.col("_stop").isNull() | (F.col("epoch") <= F.col("_stop")))
    return run.groupBy("run_id").agg(
        F.max("_stop").alias("stop_epoch"),
        F.min(F.struct("loss", "epoch"))["epoch"].alias("best_epoch"),
        F.min("loss").alias("best_loss"),
    )


def histogram(df: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Rows per group and bin; equal bins from the smallest to the largest value of the group."""
    edges = df.where(F.col(value).isNotNull()).groupBy(group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    known = join_small(df.where(F.col(value).isNotNull()), edges, [group])
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_lo"), width)), F.lit(0))
    binned = known.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))
    return binned.groupBy(group, "bin").agg(F.count(F.lit(1)).alias("n"))


def best_score(scores: DataFrame, id_cols: list[str], score: str, choice: str) -> DataFrame:
    """Choice with the highest score per row id; the smallest choice when tied."""
    best = F.min(F.struct((-F.col(score)).alias("s"), F.col(choice).alias("c")))
    return scores.groupBy(*id_cols).agg(best["c"].alias("predicted"))
