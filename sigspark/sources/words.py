"""Word lists: text files with words separated by commas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_WORDS = 10_000


def split_words(lines: DataFrame, column: str = "value") -> DataFrame:
    """One row per word: cut at commas and line ends, blanks trimmed, empty words dropped."""
    words = lines.select(F.explode(F.split(column, "[,\n]")).alias("word"))
    return words.select(F.trim("word").alias("word")).where(F.col("word") != "")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    return split_words(spark.read.text(path))


def as_words(words: DataFrame, max_words: int = MAX_WORDS) -> tuple[str, ...]:
    """The list itself, to build rules from; refused when it is too long to be one."""
    rows = words.distinct().limit(max_words + 1).collect()
    if len(rows) > max_words:
        raise ValueError(f"more than {max_words} words: not a word list")
    return tuple(sorted(r["word"] for r in rows))
