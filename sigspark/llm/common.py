"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigspark.session import stored

#: Bits of the set that ``maybe_in`` broadcasts: 8 MiB, whatever the input.
SET_BITS = 26
#: Rows of an Arrow batch that holds texts.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def maybe_in(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``column`` may be among ``keys[key]``; never loses one that is.

    The keys are hashed into a bit set of 2**SET_BITS bits, built by map-side
    combined aggregation and broadcast: at most 2**SET_BITS / 8 bytes at any
    input size. With more keys than bits it only filters less. An exact join
    follows; this keeps the long columns of other rows out of its shuffle.
    """
    mask = (1 << SET_BITS) - 1
    place = F.xxhash64(F.col(key)).bitwiseAND(F.lit(mask)) + 1
    bits = (
        keys.select(place.alias("__p"))
        .groupBy(F.bitmap_bucket_number("__p").alias("__bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__p")).alias("__bits"))
    )
    own = F.xxhash64(F.col(column)).bitwiseAND(F.lit(mask)) + 1
    at = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.pmod(F.floor(byte / F.pow(F.lit(2), at % 8)), F.lit(2)) == 1
    joined = rows.withColumn("__bucket", F.bitmap_bucket_number(own)).join(F.broadcast(bits), "__bucket")
    return joined.filter(hit).select(*[joined[c] for c in rows.columns])


def small_batches(rows: DataFrame) -> DataFrame:
    """``rows``, in a session whose Arrow batches hold at most ARROW_ROWS rows.

    The default of 10,000 rows is made for numbers: of long texts it is hundreds of
    megabytes, in the executor and again in its Python worker. The setting stays.
    """
    conf, key = rows.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= ARROW_ROWS:
        conf.set(key, str(ARROW_ROWS))
    return rows


def map_texts(rows: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` over every Arrow batch of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return small_batches(rows).mapInArrow(run, schema)


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered for up to ``limit`` words."""

    def __init__(self, limit: int = 100_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


def encoded(batch: pa.RecordBatch, column: str) -> Iterator[bytes]:
    """The texts of a batch as UTF-8 bytes, one at a time; null as empty."""
    for value in batch.column(column):
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


#: Rows of a range block, where the session's shuffle partitions would hold more.
BLOCK_ROWS = 1_000_000


def in_blocks(rows: DataFrame, order: list[str | Column], n_rows: int, name: str) -> DataFrame:
    """``rows`` as a stored table with ``__block``: blocks are ranges of ``order``, ascending.

    A rank or a neighbour in a global order is one within a block, plus a number or a row per block;
    there are as many blocks as shuffle partitions, or one for every BLOCK_ROWS rows. ``n_rows`` is about the number of rows.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // BLOCK_ROWS))
    return stored(rows.repartitionByRange(parts, *order).withColumn("__block", F.spark_partition_id()), name)
