"""Run tables: catalogs, features, fitted parts, reports, each kept under a run id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.sources import snapshots


def write_dataset(df: DataFrame, root: str, name: str, run_id: str) -> None:
    """Store a table of one run; a rerun replaces its own part only, and readers see the old part until the new one is whole."""
    with snapshots.Transaction(df.sparkSession, root) as change:
        change.write(name, run_id, df)


def read_dataset(spark: SparkSession, root: str, name: str, run_id: str | None = None) -> DataFrame:
    """One run of a table, the newest one when none is named."""
    if run_id is None:
        run_id = latest(runs(spark, root)).head()["run_id"]
    return snapshots.read(spark, root, name, run_id)


def run_or_load(spark: SparkSession, root: str, name: str, run_id: str | None, build: Callable[[], DataFrame], reload: bool) -> DataFrame:
    """Rebuild and store when asked to, else read what is stored."""
    if run_id is None:
        raise ValueError("run_id is missing")
    if reload:
        write_dataset(build(), root, name, run_id)
    return read_dataset(spark, root, name, run_id)


def report_text(report: DataFrame) -> str:
    """The one-row report of a run as JSON text."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("t")).head()["t"]


def runs(spark: SparkSession, root: str) -> DataFrame:
    """(run_id, modified, report) of every report; readers take the newest entry."""
    return snapshots.reports(spark, root)


def latest(entries: DataFrame) -> DataFrame:
    """The newest entry: a top-1, not a sort of all."""
    return entries.orderBy(F.col("modified").desc(), F.col("run_id").desc()).limit(1)


def run_report(catalog: DataFrame, rejects: DataFrame, library: str, classes: tuple[str, ...], reasons: tuple[str, ...]) -> DataFrame:
    """One row: library, counts, class balance and columns of a run.

    The path lists are the catalog and reject tables themselves.
    """
    balance = catalog.agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.to_json(F.struct(*[F.count(F.when(F.col("label") == c, 1)).alias(c) for c in classes])).alias("classes"),
    )
    counts = rejects.agg(*[F.count(F.when(F.col("reason") == r, 1)).alias(f"n_{r}") for r in reasons])
    out = balance.select(
        F.lit(library).alias("sample_library_path"),
        "n_samples",
        F.from_json("classes", T.MapType(T.StringType(), T.LongType())).alias("classes"),
        F.lit(len(catalog.columns)).alias("n_columns"),
        F.array(*[F.lit(c) for c in catalog.columns]).alias("columns"),
    )
    for r in reasons:
        out = out.withColumn(f"n_{r}", counts.select(f"n_{r}").scalar())
    return out


def update_report(spark: SparkSession, root: str, run_id: str, columns: list[str]) -> None:
    """Add an entry with the column list the features brought; the older entry stays."""
    last = latest(runs(spark, root).where(F.col("run_id") == run_id)).select("report")
    kept = F.from_json("report", T.MapType(T.StringType(), T.StringType()))
    new = F.map_from_arrays(F.array(F.lit("n_columns"), F.lit("columns")), F.array(F.lit(str(len(columns))), F.to_json(F.array(*[F.lit(c) for c in columns]))))
    others = F.map_filter(kept, lambda k, _: ~k.isin("n_columns", "columns"))
    changed = last.select(F.to_json(F.map_concat(others, new)).alias("t")).head()
    with snapshots.Transaction(spark, root) as change:
        change.report(run_id, changed["t"])


def write_model_report(df: DataFrame, root: str, run_id: str, model: str) -> None:
    df.write.mode("overwrite").json(f"{root}/models/{run_id}/{model}/report")


def add_metrics(df: DataFrame, root: str) -> None:
    """Append (run_id, epoch, split, metric, value) rows."""
    df.write.mode("append").parquet(f"{root}/metrics")


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with names in the first row; numbers that do not parse become NULL."""
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.option("header", True).schema(text).csv(path)
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])
