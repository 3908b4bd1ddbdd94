"""Signal, spectrum, feature and path tables made from the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.operators.segments import with_positions

# Stand-ins for the class words and word lists when part names act as paths.
PART_CLASSES = ("ring", "bolt", "gear", "rod")
PART_BLACK = ("gizmo", "anvil", "old")
PART_IGNORE = ("large",)
GAP = 0.01


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sig_events(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """One signal per user: (signal_id, pos, x), points in time order."""
    events = read(spark, sf_dir, "events").select(
        F.col("user_id").alias("signal_id"), "ts", "event_id", F.col("value").alias("x"), *extra
    )
    return with_positions(events, ["signal_id"], "ts", ("event_id",)).select("signal_id", "pos", "x", *extra)


def spec_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One magnitude frame per vector: (signal_id, vec_id, mag)."""
    return read(spark, sf_dir, "embeddings").select(
        F.col("label").alias("signal_id"),
        "vec_id",
        F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("mag"),
    )


def number_frames(vectors: DataFrame) -> DataFrame:
    """Add frame_idx, the rank of the vector in its signal."""
    return with_positions(vectors, ["signal_id"], "vec_id", out="frame_idx")


def vector_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Magnitude frames without the frame number: (vec_id, mag)."""
    return read(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", lambda v: F.abs(v.cast("double"))).alias("mag")
    )


def feat_embeddings(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Feature rows (vec_id, label, features); with ``gaps`` tiny cells are NULL."""
    cell = (lambda v: F.when(F.abs(v.cast("double")) >= GAP, v.cast("double"))) if gaps else (lambda v: v.cast("double"))
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", F.transform("embedding", cell).alias("features"))


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("signal_id"), F.col("p_name").alias("path"))
