"""The list of registered queries: each is a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column."""
    from pyspark.sql import functions as F

    return df.select(
        *[F.round(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )
