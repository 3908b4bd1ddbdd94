"""Classifiers on prepared rows: fit, report, keep, score."""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.config import DEFAULT, Settings
from sigspark.operators import evaluate, impute, neighbours, prepare, ranking, trees
from sigspark.operators.segments import join_small
from sigspark.session import stored

FOURIER = 256
ROWS_PER_TASK = 20_000
# rows x trees of a forest fitted as one, and of a batch of a larger one
WHOLE_FOREST = 1_000_000
FOREST_BATCH = 2**16
# rows x trees above which trees that are wanted for their importances only are grown whole in tasks
GROWN_APART = 1_000_000
VOTES = "_votes"


class Forest:
    """A random forest, fitted in batches of trees side by side where it is large.

    Spark ML grows all trees of a forest in one chain of jobs with as many tasks as the rows have partitions: training rows
    in one partition keep one core busy. A batch is a forest of its own with its own seed, over all rows; votes of batches
    add up to those of the forest.
    """

    def __init__(self, whole: C.RandomForestClassifier):
        self.whole = whole

    def each(self, rows: DataFrame, use: Callable[[C.RandomForestClassificationModel], Any]) -> list:
        """``use`` of every fitted batch, in order; only what it returns is kept."""
        whole, n_rows = self.whole, max(1, rows.count())
        n_trees = whole.getNumTrees()
        if n_rows * n_trees <= WHOLE_FOREST:
            return [use(whole.fit(rows))]
        kept, size = merged(rows), max(1, FOREST_BATCH // n_rows)

        def fitted(start: int):
            part = {
                whole.numTrees: min(size, n_trees - start), whole.seed: whole.getSeed() + 1000 * start, whole.maxMemoryInMB: 128,
                whole.cacheNodeIds: True,  # else every task gets the trees so far, which the driver serialises one job at a time
                whole.rawPredictionCol: f"{VOTES}{start}", whole.probabilityCol: "", whole.predictionCol: "",
            }
            return use(whole.copy(part).fit(kept))

        spark = rows.sparkSession
        at_once = max(1, spark.sparkContext.defaultParallelism // kept.rdd.getNumPartitions())
        with ThreadPool(at_once) as pool:
            made = pool.map(inheritable_thread_target(spark)(fitted), range(0, n_trees, size), chunksize=1)
        kept.unpersist()
        return made

    def fit(self, rows: DataFrame) -> Model:
        made = self.each(rows, lambda model: model)
        return made[0] if len(made) == 1 else PipelineModel(made)


def voted(df: DataFrame) -> DataFrame:
    """The class with most votes over all batches, the first of equal ones; rows of other models as they are."""
    votes = [c for c in df.columns if c.startswith(VOTES)]
    if not votes:
        return df
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [vector_to_array(v) for v in votes])
    counted = df.withColumn("_total", total).drop(*votes)
    return counted.withColumn("prediction", (F.array_position("_total", F.array_max("_total")) - 1).cast("double")).drop("_total")


def random_forest(s: Settings, p: int, k: int) -> Forest:
    return Forest(C.RandomForestClassifier(
        labelCol="code", weightCol="weight", numTrees=s.forest_trees, maxDepth=30, featureSubsetStrategy="sqrt", seed=s.seed,
        maxMemoryInMB=1024,
    ))


def boosting(s: Settings, p: int, k: int) -> Estimator:
    tree = C.GBTClassifier(
        labelCol="code", weightCol="weight", maxIter=s.boost_rounds, stepSize=s.boost_rate, maxDepth=s.boost_depth, seed=s.seed
    )
    return C.OneVsRest(classifier=tree, labelCol="code", weightCol="weight", parallelism=4)


def support_vectors(s: Settings, p: int, k: int) -> Estimator:
    plane = C.LinearSVC(labelCol="code", weightCol="weight", regParam=1e-3, maxIter=50)
    return C.OneVsRest(classifier=plane, labelCol="code", weightCol="weight", parallelism=4)


def logistic(s: Settings, p: int, k: int) -> Estimator:
    return C.LogisticRegression(labelCol="code", weightCol="weight", family="multinomial", regParam=1e-3)


def least_squares(s: Settings, p: int, k: int) -> Estimator:
    return LinearRegression(labelCol="code", weightCol="weight", regParam=1e-6)


def feed_forward(s: Settings, p: int, k: int) -> Estimator:
    return C.MultilayerPerceptronClassifier(
        labelCol="code", layers=[p, *s.net_layers, k], maxIter=s.net_epochs, blockSize=s.net_batch, seed=s.seed
    )


# key -> builder of the estimator (settings, features, classes); knn has no fitted part
MODELS: dict[str, Callable[[Settings, int, int], Estimator | Forest] | None] = {
    "lr": logistic,
    "ols": least_squares,
    "svc": support_vectors,
    "rf": random_forest,
    "gb": boosting,
    "knn": None,
    "nn": feed_forward,
}


def fourier_features(df: DataFrame, p: int, seed: int, n: int = FOURIER, features: str = "features") -> DataFrame:
    """Random Fourier features of an RBF kernel with width 1/p (Rahimi and Recht 2007).

    Scaled columns have variance 1, so 1/p is the usual choice. The directions
    come from the seed alone: nothing has to be kept.
    """
    rng = np.random.default_rng(seed)
    directions = rng.normal(0, np.sqrt(2.0 / p), (p, n))
    shift = rng.uniform(0, 2 * np.pi, n)

    @F.pandas_udf("array<double>")
    def lifted(rows: pd.Series) -> pd.Series:
        if len(rows) == 0:
            return pd.Series([], dtype=object)
        x = np.array(rows.tolist(), dtype="float64")
        return pd.Series(list(np.sqrt(2.0 / n) * np.cos(x @ directions + shift)))

    return df.withColumn(features, lifted(F.col(features)))


@dataclass
class Trained:
    key: str
    imputer: impute.IterativeImputer
    scaler: DataFrame  # (idx, mean, std), one row per feature
    label_map: DataFrame  # (label, code), one row per class
    model: Model | None
    train_rows: DataFrame | None  # only for knn
    settings: Settings

    def ready(self, df: DataFrame) -> DataFrame:
        """Fill and scale with the fitted parts."""
        return prepare.standard_scale(self.imputer.transform(df), self.scaler)

    def score(self, df: DataFrame, id_col: str) -> DataFrame:
        """Add ``predicted`` (a class name) to rows with ``features``."""
        rows = self.ready(df)
        if self.key == "knn":
            coded = neighbours.knn_predict(rows, self.train_rows, id_col, self.settings.neighbours)
        else:
            if self.key == "svc":
                rows = fourier_features(rows, len(self.imputer.kept), self.settings.seed)
            made = voted(self.model.transform(rows.withColumn("features", array_to_vector("features"))))
            code = F.col("prediction")
            if self.key == "ols":
                k = self.label_map.count()
                code = F.greatest(F.lit(0.0), F.least(F.lit(k - 1.0), F.round(code)))
            coded = made.withColumn("predicted", code.cast("int"))
        names = self.label_map.select(F.col("code").alias("predicted"), F.col("label").alias("_name"))
        named = join_small(coded.select(*[c for c in df.columns if c != "features"], "predicted"), names, ["predicted"])
        return named.withColumn("predicted", F.col("_name")).drop("_name")

    def write(self, spark: SparkSession, path: str) -> None:
        self.imputer.write(spark, f"{path}/imputer")
        self.scaler.write.parquet(f"{path}/scaler")
        self.label_map.write.parquet(f"{path}/labels")
        if self.model is not None:
            self.model.write().save(f"{path}/model")
        if self.train_rows is not None:
            self.train_rows.write.parquet(f"{path}/rows")
        about = spark.createDataFrame([(self.key, json.dumps(self.settings.__dict__))], "model_name string, params string")
        about.coalesce(1).write.json(f"{path}/about")

    @staticmethod
    def read(spark: SparkSession, path: str) -> "Trained":
        about = spark.read.schema("model_name string, params string").json(f"{path}/about").first()
        values = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(about.params).items()}
        key = about.model_name
        return Trained(
            key,
            impute.IterativeImputer.read(spark, f"{path}/imputer"),
            spark.read.parquet(f"{path}/scaler"),
            spark.read.parquet(f"{path}/labels"),
            None if key == "knn" else DefaultParamsReader.loadParamsInstance(f"{path}/model", spark),
            spark.read.parquet(f"{path}/rows") if key == "knn" else None,
            Settings(**values),
        )


def merged(rows: DataFrame) -> DataFrame:
    """The rows, persisted in as many partitions as their number asks for.

    They are kept as they come first: else the one task of a merged partition would run the joins and sorts of all the
    shuffle partitions in it, and a sort takes a memory page however few its rows are.
    """
    apart = rows.persist()
    few = apart.coalesce(max(1, math.ceil(apart.count() / ROWS_PER_TASK))).persist()
    few.count()
    apart.unpersist()
    return few


def train(prepared: DataFrame, id_col: str, key: str, settings: Settings = DEFAULT, weighted: bool = False) -> Trained:
    """Fit imputer, scaler and model on the training part of prepared rows.

    ``weighted`` gives every row 1 / class count. The network takes no
    weights and gets a balanced sample instead.
    """
    if key not in MODELS:
        raise KeyError(f"unknown model {key!r}; known: {', '.join(MODELS)}")
    rows = prepared.where(F.col("split") == "train").select(id_col, "label", "code", "features")
    if weighted and key == "nn":
        rows = ranking.balanced_sample(rows, id_col, "label", settings.seed)
    rows = merged(rows)  # every fitted part below reads these rows many times
    imputer = impute.fit_imputer(rows, max_rounds=settings.impute_rounds, tolerance=settings.impute_tolerance)
    filled = imputer.transform(rows)
    spark = prepared.sparkSession
    scaler = spark.createDataFrame(prepare.column_statistics(filled).toArrow())  # one row per feature
    label_map = spark.createDataFrame(rows.select("label", "code").distinct().toArrow())  # one row per class
    ready = prepare.standard_scale(filled, scaler)
    p, k = len(imputer.kept), label_map.count()
    fitted, train_rows = None, None
    if key == "knn":
        # written: the model lives on without the rows kept above
        train_rows = stored(ready.select(id_col, F.col("code").alias("label"), "features"), "knn-train")
    else:
        if key == "svc":
            ready = fourier_features(ready, p, settings.seed)
        ready = ranking.class_weights(ready) if weighted else ready.withColumn("weight", F.lit(1.0))
        ready = ready.withColumn("features", array_to_vector("features")).withColumn("code", F.col("code").cast("double"))
        fitted = MODELS[key](settings, p, k).fit(ready.persist())
        ready.unpersist()
    rows.unpersist()
    return Trained(key, imputer, scaler, label_map, fitted, train_rows, settings)


def train_and_report(prepared: DataFrame, id_col: str, key: str, settings: Settings = DEFAULT, weighted: bool = False):
    """The fitted model and the class report of the test part."""
    made = train(prepared, id_col, key, settings, weighted)
    test = prepared.where(F.col("split") == "test")
    return made, evaluate.class_report(made.score(test, id_col))


def sweep_forest(ready: DataFrame, settings: Settings, trees=(100, 200, 500, 1000), depth: int = 10) -> DataFrame:
    """Accuracy on a held-out quarter per number of trees."""
    forest = C.RandomForestClassifier(labelCol="code", maxDepth=depth, featureSubsetStrategy="sqrt", seed=settings.seed)
    grid = ParamGridBuilder().addGrid(forest.numTrees, list(trees)).build()
    search = TrainValidationSplit(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="code", metricName="accuracy"),
        trainRatio=0.75,
        parallelism=2,
        seed=settings.seed,
    )
    found = search.fit(ready.withColumn("features", array_to_vector("features")))
    rows = [(int(t), depth, float(a)) for t, a in zip(trees, found.validationMetrics)]
    return ready.sparkSession.createDataFrame(rows, "n_trees int, depth int, accuracy double")


def _tree_importances(model: C.RandomForestClassificationModel) -> tuple[np.ndarray, np.ndarray]:
    """Importances of the forest, and of each tree."""
    return model.featureImportances.toArray(), np.array([t.featureImportances.toArray() for t in model.trees])


def _importance_table(parts: list[tuple[np.ndarray, np.ndarray]], names: list[str], spark: SparkSession) -> DataFrame:
    per_tree = np.concatenate([trees for _, trees in parts])
    whole = parts[0][0] if len(parts) == 1 else per_tree.sum(0) / max(per_tree.sum(), 1e-300)
    rows = [(n, float(whole[i]), float(per_tree[:, i].std())) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "feature string, importance double, std double")


def importance(model: Model, names: list[str], spark: SparkSession) -> DataFrame:
    """Importance of each feature and its population deviation over the trees."""
    batches = model.stages if isinstance(model, PipelineModel) else [model]
    return _importance_table([_tree_importances(m) for m in batches], names, spark)


def fitted_importance(forest: Forest, rows: DataFrame, names: list[str]) -> DataFrame:
    """``importance`` of the forest fitted to ``rows``; the driver keeps the numbers of its trees, not the trees.

    The trees of a large forest are grown by ``trees.tree_importances``: no model has to be made of them.
    """
    n_rows = rows.count()
    if n_rows * forest.whole.getNumTrees() > GROWN_APART:
        per_tree = trees.tree_importances(forest.whole, rows, n_rows)
        if per_tree is not None:
            return _importance_table([(per_tree.sum(0) / max(per_tree.sum(), 1e-300), per_tree)], names, rows.sparkSession)
    return _importance_table(forest.each(rows, _tree_importances), names, rows.sparkSession)


def top_features(table: DataFrame, n: int = 20) -> DataFrame:
    return table.orderBy(F.col("importance").desc(), "feature").limit(n)
