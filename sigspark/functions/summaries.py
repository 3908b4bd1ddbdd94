"""Named summaries of a frame series.

``SUMMARY_OPS`` maps a name to a function of a column (and, for sign changes,
the column of the row before) that gives an aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sign_changes(x: Column, previous: Column) -> Column:
    """Share of rows whose sign differs from the row before; sign(0) is 0."""
    moved = F.when(F.signum(x) != F.signum(previous), 1).otherwise(0)
    return F.sum(moved) / F.count(F.lit(1))


SUMMARY_OPS = {
    "avg": F.avg,
    "max": F.max,
    "min": F.min,
    "std": F.stddev_pop,
    "zcr": sign_changes,
}


def summaries(x: Column, prefix: str, ops=("avg", "min", "max", "std"), previous: Column | None = None) -> list[Column]:
    """One aggregate per operation, named ``<prefix>_<op>``."""
    made = []
    for op in ops:
        made.append((SUMMARY_OPS[op](x, previous) if op == "zcr" else SUMMARY_OPS[op](x)).alias(f"{prefix}_{op}"))
    return made


def at_loudest(x: Column, loudness: Column, idx: Column, name: str) -> Column:
    """Value of ``x`` in the loudest frame; the first one when several are equally loud."""
    return F.min_by(x, F.struct((-loudness).alias("l"), idx.alias("i"))).alias(name)
