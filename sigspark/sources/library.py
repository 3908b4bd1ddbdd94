"""Clip files: listing, keyed requests, decoding."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.config import DEFAULT, Settings
from sigspark.functions import dsp
from sigspark.sources import wav

#: Files of one Arrow batch, when their bytes are read.
OPEN_FILES = 64
DECODED = [
    T.StructField("status", T.StringType()),
    T.StructField("x", T.ArrayType(T.FloatType())),
    T.StructField("flux", T.ArrayType(T.DoubleType())),
]


def plain_path(path: Column) -> Column:
    """Local paths without the scheme Spark puts in front."""
    return F.regexp_replace(path, "^file:/+", "/")


def scan_library(spark: SparkSession, *paths: str) -> DataFrame:
    """All wav files below the folders (any depth) and the wav files named directly.

    Lazy: without the ``content`` column only the listing is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.wav")
        .load(list(paths))
    )
    return with_ids(files)


def with_ids(files: DataFrame) -> DataFrame:
    path = plain_path(F.col("path"))
    return files.withColumn("path", path).withColumn("signal_id", F.col("path"))


def scan_keyed(spark: SparkSession, requested: DataFrame, *paths: str) -> DataFrame:
    """Listing of the files asked for by (key, path); a request without a file has NULL length.

    Only the listing is joined: bytes never pass a shuffle.
    """
    wanted = requested.select("key", plain_path(F.col("path")).alias("path"))
    files = scan_library(spark, *paths).select("path", "length", "modificationTime")
    return wanted.join(files, "path", "left").withColumn("signal_id", F.col("path"))


def list_clips(spark: SparkSession, *paths: str) -> DataFrame:
    """Listing of the wav files below the paths (signal_id, path, length); no file is opened."""
    parts = [wav.read_wav(spark, path, ["path", "length"]) for path in paths]
    return reduce(DataFrame.unionByName, parts).withColumn("signal_id", F.col("path"))


def with_content(files: DataFrame, wanted: str) -> DataFrame:
    """Adds ``content``, the bytes of the files whose column ``wanted`` is true; other files are not opened.

    A file that has gone since the listing has empty content. Files are opened where their row is, so spread the listing first.
    """
    schema = T.StructType([f for f in files.schema.fields if f.name != wanted] + [T.StructField("content", T.BinaryType())])

    def content(path: str) -> bytes:
        fs, below = wav.open_path(path)
        try:
            with fs.open_input_file(below) as f:
                return f.read()
        except FileNotFoundError:
            return b""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), OPEN_FILES):
                part = pdf.iloc[at : at + OPEN_FILES]
                held = [content(p) if w else None for p, w in zip(part["path"], part[wanted])]
                yield part.drop(columns=wanted).assign(content=pd.Series(held, index=part.index, dtype=object))

    return files.mapInPandas(run, schema)


def looks_readable(content: Column) -> Column:
    """Cheap first test on the header bytes, before any Python."""
    text = F.decode(F.substring(content, 1, 12), "ISO-8859-1")
    return F.coalesce(text.startswith("RIFF") & text.endswith("WAVE") & (F.length(content) > 44), F.lit(False))


def decode(files: DataFrame, settings: Settings = DEFAULT, onsets: bool = True) -> DataFrame:
    """Samples of each file at the common rate, and the onset flux of the samples.

    One pass over the bytes; all columns but ``content`` go along. A file that
    cannot be read gives status ``unreadable``, never an error; NULL content
    gives NULL status.
    """
    s = settings
    silence = np.zeros(int(s.onset_silence * s.sample_rate), "float32")
    schema = T.StructType([f for f in files.schema.fields if f.name != "content"] + DECODED)

    def one(content: bytes | None):
        if content is None:
            return None, None, None
        try:
            rate, x = dsp.decode_wav(content)
            x = dsp.resample(x, rate, s.sample_rate)
            if not onsets:
                return "ok", x, None
            return "ok", x, dsp.onset_flux(np.concatenate([silence, x]), s.sample_rate, s.frame_length, s.onset_hop, s.n_mels)
        except Exception:  # any damage of the bytes is the same outcome
            return "unreadable", None, None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [one(c) for c in pdf["content"]]
            out = pdf.drop(columns="content")
            for i, f in enumerate(DECODED):
                out[f.name] = pd.Series([m[i] for m in made], index=out.index, dtype=object)
            yield out

    return files.mapInPandas(run, schema)
