"""Labels from path words, reject routing and catalog accounts."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.config import BLACK_WORDS, CLASSES, DEFAULT, IGNORE_WORDS, REASONS
from sigspark.functions.scalars import col, stem

FEW_WORDS = 64


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    """True when one of the words is a part of ``text``.

    Few words become a chain of plain tests; long lists one alternation, so
    the plan stays small and no join is needed.
    """
    if not words:
        return F.lit(False)
    if len(words) <= FEW_WORDS:
        return reduce(lambda a, b: a | b, [text.contains(w) for w in words])
    return text.rlike("|".join(re.escape(w) for w in words))


def first_class(text: Column, classes: tuple[str, ...]) -> Column:
    """The first class, in list order, whose word is a part of ``text``; NULL if none."""
    return F.coalesce(*[F.when(text.contains(c), F.lit(c)) for c in classes])


def label_rules(
    path: Column | str,
    classes: tuple[str, ...] = CLASSES,
    black: tuple[str, ...] = BLACK_WORDS,
    ignore: tuple[str, ...] = IGNORE_WORDS,
    match: str = "path",
    compat: bool = False,
) -> tuple[Column, Column]:
    """Label and reason columns for a path.

    No class word: unlabelled. Else a black word: blacklisted. Else an ignore
    word: it is cut out and the classes are tried again; nothing left: ignored.
    With ``compat`` the word stays in and only the first class of the list is
    tried again. ``match="stem_first"`` prefers a class word in the file name.
    """
    low = F.lower(col(path))

    def match_in(text: Column) -> Column:
        if match == "stem_first":
            return F.coalesce(first_class(stem(text), classes), first_class(text, classes))
        return first_class(text, classes)

    plain = match_in(low)
    is_black = contains_any(low, black)
    has_ignored = contains_any(low, ignore)
    if compat:
        again = F.when(low.contains(classes[0]), F.lit(classes[0]))
    else:
        again = match_in(reduce(lambda t, w: F.replace(t, F.lit(w), F.lit("")), ignore, low))
    label = F.when(plain.isNotNull() & ~is_black, F.when(has_ignored, again).otherwise(plain))
    reason = (
        F.when(plain.isNull(), F.lit("unlabelled"))
        .when(is_black, F.lit("blacklisted"))
        .when(has_ignored & again.isNull(), F.lit("ignored"))
    )
    return label, reason


def route(df: DataFrame, rules: list[tuple[str, Column]], out: str = "reason") -> DataFrame:
    """First matching reason in the order given; NULL means accepted."""
    reason = reduce(lambda acc, r: acc.when(r[1], F.lit(r[0])), rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))
    return df.withColumn(out, reason)


def durations(df: DataFrame) -> DataFrame:
    """new_duration = end (or the whole length) minus start."""
    return df.withColumn("new_duration", F.coalesce("end_time", "orig_duration") - F.col("start_time"))


def too_long(seconds: float = DEFAULT.max_seconds) -> Column:
    return F.col("new_duration") >= seconds


def name_table(df: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """A fixed list of names as rows."""
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias(column))


def class_balance(df: DataFrame, classes: tuple[str, ...] = CLASSES, label: str = "label") -> DataFrame:
    """Rows per class of the list, also for classes that never occur."""
    wanted = name_table(df, "label", classes)
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    joined = wanted.join(counts, "label", "left")
    return joined.select("label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def catalog_report(df: DataFrame, reasons: tuple[str, ...] = REASONS) -> DataFrame:
    """Count per outcome (``ok`` or a reason, zero included) and the total of all.

    The lists behind the counts stay rows (see ``catalog_lists``): a list of
    all paths with one reason has no size limit and does not fit in one cell.
    """
    outcome = df.select(F.coalesce("reason", F.lit("ok")).alias("outcome"))
    counts = outcome.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    names = name_table(df, "outcome", ("ok", *reasons))
    full = names.join(counts, "outcome", "left").select("outcome", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
    n_all = df.agg(F.count(F.lit(1)).alias("n_all")).scalar()
    return full.withColumn("n_all", n_all)


def catalog_lists(df: DataFrame) -> DataFrame:
    """Outcome of every path, one row each."""
    return df.select(F.coalesce("reason", F.lit("ok")).alias("outcome"), "path", "signal_id")


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows and rows that are not NULL."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.col("_rows").alias("n_rows"), F.col(c).alias("n_filled"))
            for c in df.columns
        ]
    )
    return counted.select(F.explode(rows).alias("r")).select("r.*")


def nth_row(df: DataFrame, n: int, *order: str) -> DataFrame:
    """Row number n (from 0) in the given order: a top-(n+1) and the last of it."""
    head = df.orderBy(*order).limit(n + 1)
    return head.orderBy(*[F.col(c).desc() for c in order]).limit(1)


def keyed_outcome(requested: DataFrame, scored: DataFrame, rejects: DataFrame) -> DataFrame:
    """Class or reject text for every requested key, by key and never by place."""
    found = requested.join(scored.select("signal_id", "predicted"), "signal_id", "left")
    found = found.join(rejects.select("signal_id", "reason"), "signal_id", "left")
    text = F.when(F.col("reason") == "too_quiet", F.lit("Too quiet"))
    return found.select(*requested.columns, F.coalesce("predicted", text, F.lit("Unreadable")).alias("outcome"))
