"""Training on stored features and scoring of new clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.config import Settings
from sigspark.functions.scalars import MODEL_TIME
from sigspark.operators import catalog, models, prepare
from sigspark.operators.features import feature_names
from sigspark.operators.segments import join_small
from sigspark.plans import pipeline
from sigspark.sources import library, registry


def feature_rows(table: DataFrame) -> DataFrame:
    """(signal_id, label, features) of a feature table; the mel matrix is not read."""
    return table.select("signal_id", "label", prepare.feature_array(feature_names()).alias("features"))


def train_run(
    spark: SparkSession, root: str, run_id: str, key: str, settings: Settings, weighted: bool = False
) -> tuple[models.Trained, DataFrame, str]:
    """Train on a stored run; keeps model, class report and settings under a new model id."""
    table = feature_rows(registry.read_dataset(spark, root, "features", run_id))
    ready = prepare.prepare(table, "signal_id", settings)
    made, report = models.train_and_report(ready, "signal_id", key, settings, weighted)
    stamp = spark.range(1).select(F.date_format(F.current_timestamp(), MODEL_TIME)).first()[0]
    model_id = f"{key.upper()}_{stamp}"
    made.write(spark, f"{root}/models/{run_id}/{model_id}")
    registry.write_model_report(report, root, run_id, model_id)
    return made, report, model_id


def load_model(spark: SparkSession, root: str, run_id: str, model_id: str) -> models.Trained:
    return models.Trained.read(spark, f"{root}/models/{run_id}/{model_id}")


def predict_files(files: DataFrame, model: models.Trained, settings: Settings | None = None) -> DataFrame:
    """(signal_id, path, predicted, reason): class of every clip or why it has none.

    No label and no length rule; the stored imputer and scaler always apply.
    """
    described = pipeline.describe_files(files, settings or model.settings, training=False, mel=False)
    rows = feature_rows(pipeline.extract_features(described, settings or model.settings, mel=False))
    scored = model.score(rows, "signal_id").select("signal_id", "predicted")
    facts = described.select("signal_id", "path", "reason")
    return facts.join(scored, "signal_id", "left").select("signal_id", "path", "predicted", "reason")


def predict_keyed(spark: SparkSession, requested: DataFrame, model: models.Trained, *paths: str) -> DataFrame:
    """Outcome for every (key, path) asked for, by key: a class, ``Too quiet`` or ``Unreadable``."""
    wanted = requested.select("key", library.plain_path(F.col("path")).alias("signal_id"))
    files = join_small(library.scan_library(spark, *paths), wanted.select("signal_id").distinct(), ["signal_id"], "left_semi")
    done = predict_files(files, model)
    return catalog.keyed_outcome(wanted, done.where("predicted is not null"), done.where("reason is not null"))
