"""Iterative imputation: every gappy column regressed on all others, a round at a time.

A round needs only the means and the covariance of the completed rows, which
Spark ML computes on the executors; the driver sees a p x p matrix. Rows are
completed by one Arrow step that applies all rounds so far to the raw row, so
no round builds on the stored result of another.

Filled cells lie on the regression surface of their column. Where the rounds
settle they therefore add nothing to its normal equations, and the solution
is the regression on the observed rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.config import DEFAULT
from sigspark.operators.prepare import column_statistics


def _raw(series: pd.Series) -> np.ndarray:
    return np.array([np.asarray(v, "float64") for v in series])


def complete(raw: np.ndarray, means: np.ndarray, rounds: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows after all rounds and after all but the last."""
    gaps = np.isnan(raw)
    x = np.where(gaps, means, raw)
    before = x
    for weights, shift in rounds:
        before, x = x, np.where(gaps, x @ weights + shift, raw)
    return x, before


def bayesian_ridge(xx: np.ndarray, xy: np.ndarray, yy: float, n: float) -> np.ndarray:
    """Ridge weights with strength chosen by evidence, from centred sums of products."""
    tiny = 1e-6
    values, vectors = np.linalg.eigh(xx)
    values = values.clip(min=0)
    turned = vectors.T @ xy
    alpha, lam, last = 1.0 / max(yy / n, 1e-300), 1.0, None
    for _ in range(300):
        w = vectors @ (turned / (values + lam / alpha))
        if last is not None and np.abs(last - w).sum() < 1e-3:
            break
        last = w
        used = (alpha * values / (lam + alpha * values)).sum()
        error = max(yy - 2 * w @ xy + w @ xx @ w, 0.0)
        lam = (used + 2 * tiny) / (w @ w + 2 * tiny)
        alpha = (n - used + 2 * tiny) / (error + 2 * tiny)
    return w


@dataclass
class IterativeImputer:
    kept: list[int]
    means: np.ndarray
    rounds: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)

    def _column(self, features: str, change: bool = False) -> Column:
        kept, means, rounds = self.kept, self.means, self.rounds

        @F.pandas_udf("array<double>")
        def filled(rows: pd.Series) -> pd.Series:
            if len(rows) == 0:
                return pd.Series([], dtype=object)
            x, before = complete(_raw(rows)[:, kept], means, rounds)
            if change:  # the step of the last round and the size of the known cells ride along
                raw = _raw(rows)[:, kept]
                size = np.where(np.isnan(raw), 0, np.abs(raw)).max(1)
                x = np.column_stack([x, np.abs(x - before).max(1), size])
            return pd.Series(list(x))

        return filled(F.col(features))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        return df.withColumn(features, self._column(features))

    def write(self, spark: SparkSession, path: str) -> None:
        rows = [(-1, self.kept, self.means.tolist(), [])]
        rows += [(i, [], w.ravel().tolist(), b.tolist()) for i, (w, b) in enumerate(self.rounds)]
        spark.createDataFrame(rows, "step int, kept array<int>, numbers array<double>, shift array<double>").coalesce(1).write.parquet(path)

    @staticmethod
    def read(spark: SparkSession, path: str) -> "IterativeImputer":
        rows = {r.step: r for r in spark.read.parquet(path).collect()}  # one row per round
        p = len(rows[-1].kept)
        rounds = [(np.array(rows[i].numbers).reshape(p, p), np.array(rows[i].shift)) for i in range(len(rows) - 1)]
        return IterativeImputer(list(rows[-1].kept), np.array(rows[-1].numbers), rounds)


def fit_imputer(
    train: DataFrame, features: str = "features", max_rounds: int = DEFAULT.impute_rounds, tolerance: float = DEFAULT.impute_tolerance
) -> IterativeImputer:
    """Fit on ``train``; columns without any value are dropped, as they tell nothing."""
    stats = column_statistics(train.select(features), features).orderBy("idx").collect()  # one row per column
    n_rows = train.count()
    known = [r for r in stats if r.n_filled > 0]
    model = IterativeImputer([r.idx for r in known], np.array([r["mean"] for r in known], dtype="float64"))
    gappy = [i for i, r in enumerate(known) if r.n_filled < n_rows]
    p = len(known)
    for step in range(max_rounds + 1):
        if not gappy:
            break
        extra = step > 0
        rows = train.select(model._column(features, change=extra).alias("v"))
        vectors = rows.select(array_to_vector(F.slice("v", 1, p)).alias("v"), F.get("v", F.lit(p)).alias("step"), F.get("v", F.lit(p + 1)).alias("size"))
        vectors = vectors.persist()  # two passes below; the Arrow step runs once per round
        facts = vectors.agg(
            Summarizer.mean(F.col("v")).alias("mean"), Summarizer.std(F.col("v")).alias("std"),
            F.count(F.lit(1)).alias("n"), F.max("step").alias("step"), F.max("size").alias("size"),
        ).first()
        if extra and facts["step"] < tolerance * facts["size"] or step == max_rounds:
            vectors.unpersist()
            break
        mean, std, n = facts["mean"].toArray(), facts["std"].toArray(), facts["n"]
        corr = np.nan_to_num(Correlation.corr(vectors.select("v"), "v").first()[0].toArray())
        products = corr * np.outer(std, std) * (n - 1)
        vectors.unpersist()
        np.fill_diagonal(products, std**2 * (n - 1))
        weights, shift = np.zeros((p, p)), np.zeros(p)
        for j in gappy:
            others = [i for i in range(p) if i != j]
            w = bayesian_ridge(products[np.ix_(others, others)], products[others, j], products[j, j], n)
            weights[others, j] = w
            shift[j] = mean[j] - mean[others] @ w
        model.rounds.append((weights, shift))
    return model
