"""From clip files to a catalog, features, a trained model and predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.config import BLACK_WORDS, CLASSES, DEFAULT, IGNORE_WORDS, REASONS, Settings
from sigspark.functions.scalars import finite, stem
from sigspark.operators import augment, catalog, clips, features, frames
from sigspark.operators.segments import join_small
from sigspark.session import stored
from sigspark.sources import library, registry, snapshots, wav

CATALOG = ["signal_id", "path", "file_stem", "label", "start_time", "end_time", "orig_duration", "new_duration"]


@dataclass(frozen=True)
class Words:
    classes: tuple[str, ...] = CLASSES
    black: tuple[str, ...] = BLACK_WORDS
    ignore: tuple[str, ...] = IGNORE_WORDS
    match: str = "path"
    compat: bool = False


def describe_files(
    files: DataFrame, settings: Settings = DEFAULT, words: Words = Words(), training: bool = True, mel: bool = True
) -> DataFrame:
    """One row per file with label, times, frame series, mel matrix and reject reason, stored once.

    The files are read once and every step up to the stored table is
    row-local: samples never pass a shuffle, and the bytes of a file that its
    header or path already rules out are not decoded. ``training=False`` skips
    label and length rules. Without a column ``content`` (``library.list_clips``) the path decides
    first, and only files that it leaves are opened.
    """
    s = settings
    label, rule = catalog.label_rules("path", words.classes, words.black, words.ignore, words.match, words.compat)
    none = F.lit(None).cast("string")
    by_path = rule if training else none
    late = "content" not in files.columns
    if late:
        files = library.with_content(files.withColumn("_open", by_path.isNull()), "_open")
    unreadable = F.when(~library.looks_readable(F.col("content")), "unreadable")
    early = F.coalesce(by_path, unreadable) if late else F.coalesce(unreadable, by_path)
    ruled = files.select(
        "signal_id",
        "path",
        F.lower(stem("path")).alias("file_stem"),
        (label if training else none).alias("label"),
        early.alias("reason"),
        F.when(early.isNull(), F.col("content")).alias("content"),
    )
    timed = clips.with_spans(library.decode(ruled, s), s)
    too_long = catalog.too_long(s.max_seconds) if training else F.lit(False)
    later = F.when(F.col("status") == "unreadable", "unreadable").when(too_long, "too_long")
    timed = timed.withColumn("reason", F.coalesce("reason", later)).drop("status")
    part = clips.slice_clip(F.col("x"), F.col("start_time"), F.col("new_duration"), s.sample_rate)
    series = clips.frame_series(timed.withColumn("x", F.when(F.col("reason").isNull(), part)), s, mel)
    loudest = F.array_max(F.transform(F.slice("frames", 1, s.max_frames), lambda f: f["rms"]))
    last = F.when(F.col("frames").isNull(), "unreadable_trim").when(loudest < s.min_rms, "too_quiet")
    return stored(series.withColumn("reason", F.coalesce("reason", last)), "clips")


def split_outcome(described: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog of accepted clips and the rejects with their reasons."""
    accepted = described.where(F.col("reason").isNull()).select(*CATALOG)
    rejects = described.where(F.col("reason").isNotNull()).select("signal_id", "path", "reason")
    return accepted, rejects


def build_catalog(
    spark: SparkSession, root: str, run_id: str, *paths: str, settings: Settings = DEFAULT, words: Words = Words(), open_late: bool = False
) -> DataFrame:
    """Describe a library, store catalog, rejects and report of the run as one change; returns the described table.

    ``open_late`` lists first and never opens a file that its path rules out, whether it could be read or not.
    """
    if open_late:
        listed = library.list_clips(spark, *paths)
        files = listed.repartition(max(1, -(-listed.count() // library.OPEN_FILES)), "path")
    else:
        files = library.scan_library(spark, *paths)
    described = describe_files(files, settings, words)
    accepted, rejects = split_outcome(described)
    with snapshots.Transaction(spark, root) as change:
        accepted, rejects = change.write("catalog", run_id, accepted), change.write("rejects", run_id, rejects)
        report = registry.run_report(accepted, rejects, ",".join(paths), words.classes, REASONS)
        change.report(run_id, registry.report_text(report))
    return described


def extract_features(described: DataFrame, settings: Settings = DEFAULT, mel: bool = True) -> DataFrame:
    """Feature rows (signal_id, label, 119 columns, mel) of the accepted clips.

    Only narrow frame series meet in the aggregations. The mel matrix is the
    one wide column; without it the last join is narrow too.
    """
    s = settings
    ok = described.where(F.col("reason").isNull())
    rows = ok.select("signal_id", "frame_length", F.explode("frames").alias("f")).select("signal_id", "frame_length", "f.*")
    hop_seconds = F.floor(F.col("frame_length") / s.hop_divisor) / s.sample_rate
    shape = features.envelope(rows, hop_seconds, s.loud_share)
    valid = frames.ranked(frames.valid_frames(rows, s.min_rms, s.max_frames), bounded=True)
    made = shape.join(features.summary_features(valid), "signal_id")
    names = features.feature_names()
    numbers = made.select("signal_id", *[finite(F.col(n).cast("double")).alias(n) for n in names])
    facts = ["signal_id", "label", *(["mel"] if mel else [])]
    return numbers.join(ok.select(*facts), "signal_id").select("signal_id", "label", *names, *facts[2:])


def augment_library(
    spark: SparkSession, accepted: DataFrame, out: str, *paths: str, settings: Settings = DEFAULT, root: str = "", audio: str | None = None
) -> DataFrame:
    """Derive clips until every class is large enough; stores (new_name, label, method, factor, x).

    Names are ``<factor>_<path>`` and never repeat. With ``audio`` the clips are also written as wav files into that
    folder, all of them or none.
    """
    plan = augment.augment_plan(accepted.select("signal_id", "label"), "signal_id", "label", settings=settings)
    factor = F.when(F.col("method") == "pitch", F.format_string("%d", F.col("factor").cast("int"))).otherwise(
        F.format_number("factor", 1)
    )
    named = plan.withColumn("name", augment.derived_name(factor, "signal_id", root))
    jobs = augment.free_names(named, "name", "job").select("signal_id", "label", "method", "factor", "new_name")
    # the jobs are few (classes x target), so they go to the files and not the files to them
    files = join_small(library.scan_library(spark, *paths).select("signal_id", "content"), jobs, ["signal_id"], "inner")
    decoded = library.decode(files, settings, onsets=False).where(F.col("status") == "ok").drop("status", "flux")
    clips.derive_clips(decoded, settings).write.mode("overwrite").parquet(out)
    made = spark.read.parquet(out)
    if audio:
        wav.write_wav(made.withColumnRenamed("new_name", "name"), audio, settings.sample_rate, mode="overwrite")
    return made


def store_features(spark: SparkSession, root: str, run_id: str, table: DataFrame) -> DataFrame:
    registry.write_dataset(table, root, "features", run_id)
    registry.update_report(spark, root, run_id, table.columns)
    return registry.read_dataset(spark, root, "features", run_id)
