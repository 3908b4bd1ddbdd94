"""Clips and events as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigspark.config import Settings
from sigspark.operators.models import Trained
from sigspark.plans.predict import predict_files
from sigspark.sources.library import with_ids

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_clips(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Wav files dropped below a folder, each path once while the watermark remembers it."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.wav")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return distinct_paths(files)


def distinct_paths(files: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated paths that come within ``delay`` of each other."""
    return files.withWatermark("modificationTime", delay).dropDuplicatesWithinWatermark(["path"])


def score_arrivals(
    spark: SparkSession, folder: str, model: Trained, out: str, checkpoint: str, settings: Settings | None = None
) -> StreamingQuery:
    """Score all files not seen before, then stop; the checkpoint makes every file count once.

    Frame features need ranks, which streams do not allow, so each batch is
    scored as a batch. A batch that is run again replaces its own rows.
    """

    def score(batch: DataFrame, batch_id: int) -> None:
        outcome = predict_files(with_ids(batch.drop("modificationTime", "length")), model, settings)
        outcome.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        arriving_clips(spark, folder)
        .writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rolling_counts(rows: DataFrame, time: str, group: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Rows per time window and group; rows later than ``delay`` are dropped on a stream."""
    watched = rows.withWatermark(time, delay) if rows.isStreaming else rows
    counts = watched.groupBy(F.window(time, width).alias("w"), F.col(group).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("w.start").alias("start"), "name", "n")


def stream_counts(
    spark: SparkSession, stream: DataFrame, time: str, group: str, out: str, checkpoint: str, width: str = "1 day"
) -> DataFrame:
    """Run the counts over all that is there and give the newest count per window and group.

    Changed windows are appended per batch, so nothing is kept on the driver.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    run = (
        rolling_counts(stream, time, group, width)
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    kept = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    return kept.groupBy("start", "name").agg(F.max_by("n", "batch").alias("n"))
