"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again.

A stage takes (spark, docs, sf_dir), works on all that its predecessor kept and
returns the columns of documents; the last one returns the packed pieces.
SQL can't express the classifier's decisions, so ORACLE_SQL is None and
``tests/llm`` compares the stages with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sigspark.llm import exact_dedup, near_dedup, packing, quality, secrets
from sigspark.llm.common import table
from sigspark.llm.queries import BPE, tokenizer
from sigspark.session import stored


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below the threshold go."""
    return quality.accepted(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: one document of each group of equal texts stays."""
    return exact_dedup.without_exact_duplicates(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: one document of each component stays."""
    return near_dedup.without_near_duplicates(docs)


def masked_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span becomes a mask; all documents stay."""
    return secrets.masked(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: the place of every piece."""
    return packing.pack(docs, tokenizer(BPE))


STAGES = [
    ("quality classifier", good_documents),
    ("exact dedup", distinct_documents),
    ("minhash near-dedup", dissimilar_documents),
    ("secret scans", masked_documents),
    ("best-fit packing", packed_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
