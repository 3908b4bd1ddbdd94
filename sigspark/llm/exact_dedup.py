"""Exact duplicates by a stateful stream over fingerprints.

A row's fingerprint is the digest of its normalised text (every character of
``[\\x20\\x09-\\x0D]`` deleted). Fingerprints are written as a table, and a
Structured Streaming aggregation reads it: its keyed state lives on disk
(RocksDB, checkpointed in the shared folder), never expires, and keeps for a
digest the number of rows, the stable id of the row that stays and the locator
of its content (file and row number). Partial aggregation comes before
the shuffle, so a text that makes up a third of all rows is one row per task.

A digest seen more than once is a hit, and every hit is checked on the full
bytes: the least and the greatest normalised text of the digest must be equal.
Where they differ (a collision), rows are grouped by the full text instead.

Defined cases: null text counts as empty; empty texts are equal to one another;
of equal texts the row with the most code points, then the smallest doc_id
stays; a row without a doc_id never goes before one that has it; repeated rows
of one doc_id all count in group_size, and only one of them is kept; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.llm.common import maybe_in, text_of
from sigspark.session import scratch_path, stored

STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # many small stores: no log files of 64 MB laid out in advance for each
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
}
RESULT = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), r"[\x20\x09-\x0D]+", "")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def fingerprints(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """A narrow row per document: digest, doc_id, length, and where its content is."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.length(text_of()).alias("points"),
        normalised().alias("clean"),
        F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("row_no"),
    ).select("doc_id", "points", "file", "row_no", sha256(F.col("clean")).alias("sha"), digest(F.col("clean")).alias("digest"))


def best_row() -> Column:
    return F.max(F.struct("points", (-F.col("doc_id")).alias("neg_id"), (-F.col("row_no")).alias("neg_row"), "doc_id", "row_no", "file"))


def run_stream(spark: SparkSession, source: str, state: str, files_per_batch: int = 1000) -> None:
    """Take the fingerprints in ``source`` that the state in ``state`` hasn't seen into it."""
    session = spark.newSession()
    partitions = "spark.sql.shuffle.partitions"
    for key, value in (STATE | {partitions: spark.conf.get(partitions)}).items():
        session.conf.set(key, value)
    schema = spark.read.parquet(source).schema
    query = (
        session.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), best_row().alias("best"))
        .writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """The keyed state as a table: digest, n, best."""
    return spark.read.format("statestore").load(state).select("key.digest", F.col("value.count").alias("n"), F.col("value.max").alias("best"))


def collisions(docs: DataFrame, state: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Digests seen more than once whose full texts are not all the same bytes."""
    texts = docs.select(normalised().alias("clean")).withColumn("digest", digest(F.col("clean")))
    hits = state.filter("n > 1").select("digest")
    checked = maybe_in(texts, "digest", hits, "digest").groupBy("digest").agg(F.min("clean").alias("least"), F.max("clean").alias("greatest"))
    return checked.filter(F.col("least") != F.col("greatest")).select("digest")


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256, files_per_batch: int = 1000) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and the locator
    (file, row) of the row that stays."""
    spark = docs.sparkSession
    source, state_dir = scratch_path(spark, "fingerprints"), scratch_path(spark, "dedup-state")
    fingerprints(docs, digest).write.parquet(source)
    rows = spark.read.parquet(source)
    if rows.isEmpty():
        return result(rows.withColumns({"n": F.lit(0).cast("long"), "best": F.struct("points", "doc_id", "row_no", "file")}))
    run_stream(spark, source, state_dir, files_per_batch)
    state = read_state(spark, state_dir)
    bad = stored(collisions(docs, state, digest), "collisions")
    if bad.isEmpty():
        return result(rows.join(state, "digest"))
    # the digest is weaker than the text: the full text is the key
    # (the sha of a row joins it to its text; rows of one sha and different bytes are kept apart by the text)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("clean")).withColumn("digest", digest(F.col("clean")))
    texts = texts.join(bad, "digest", "left_semi").withColumn("sha", sha256(F.col("clean"))).distinct()
    mixed = rows.join(bad, "digest", "left_semi").join(texts.select("doc_id", "sha", "clean"), ["doc_id", "sha"])
    groups = mixed.groupBy("clean").agg(F.count(F.lit(1)).alias("n"), best_row().alias("best"))
    whole = rows.join(bad, "digest", "left_anti").join(state, "digest")
    return result(whole).unionByName(result(mixed.join(groups, "clean")))


def result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
        F.col("sha").alias("text_sha256"),
        F.col("best.file").alias("keep_file"),
        F.col("best.row_no").alias("keep_row"),
    )


def without_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns.

    They are joined back by doc_id. Only where ids are repeated or null, the
    text's digest joins too, and one row stays for each kept id and text.
    """
    rows = stored(exact_duplicates(docs).select("doc_id", "kept", "text_sha256"), "exact-rows")
    kept = rows.filter("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    unclear = rows.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL")
    if unclear.isEmpty():
        return docs.join(kept, F.col("doc_id").cast("long") == F.col("__id"), "left_semi")
    keyed = docs.withColumn("__own", sha256(normalised()))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__sha"))
    return keyed.join(kept.distinct(), same, "left_semi").dropDuplicates(["doc_id", "__own"]).select(*docs.columns)
