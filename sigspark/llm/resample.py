"""Importance resampling towards a target distribution, on hashed word n-grams.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z: letters,
digits and whatever is not ASCII. Features are all runs of 1 and 2 consecutive
words, joined by one space, repeats counted; a feature's bucket is the CRC-32 of its UTF-8
bytes modulo ``buckets``. A bucket's gain is the log ratio of its share among the target's
features to that among the documents', both smoothed by one, in thousandths; a
document's weight is the floored mean of its features' gains. Documents are then drawn without replacement
by the largest weight plus Gumbel noise, which comes from a hash of ``seed`` and doc_id.

The CRC is linear but for a constant of the length: the CRC of a span is the exclusive or of what each byte
contributes at its distance from the span's end, and of a length constant. ``CONTRIBUTION``
holds the contributions for distances below DEPTH, so the hashes of all spans of a batch are one table look-up per byte and
one ``bitwise_xor.reduceat``. Longer spans are cut into blocks of DEPTH bytes from their end; neighbouring
blocks are folded in pairs, the earlier one advanced by the other's length, which takes log2 steps.
Words are one tiling of the text by spans; pairs starting at even and at odd words are two more.

The corpus is read twice: for the bucket counts, of which a task sends at most ``buckets`` rows, and for the
weights. The gains are ``buckets`` numbers whatever the input, and go to the tasks with
the function. Ranks come from range blocks, see ``common.in_blocks``; no task holds all documents.

Memory: a batch is worked off in pieces of about PIECE bytes, cut between words; a word longer than that is one piece.

Defined cases: null text counts as empty; a text without words has no features and weight 0; a
null doc_id is hashed as the empty string; ties go to the smaller doc_id, null first; repeated rows are returned each
and share the noise; an empty table gives an empty result, an empty target gain from smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import in_blocks, small_batches
from sigspark.session import stored

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Distances from a span's end that the table holds.
DEPTH = 64
#: Bytes that are hashed at a time.
PIECE = 1 << 21


def _advance(state: np.ndarray, step: np.ndarray) -> np.ndarray:
    """CRC states after the zero bytes that ``step`` (4 x 256) stands for."""
    return step[0][state & 255] ^ step[1][state >> 8 & 255] ^ step[2][state >> 16 & 255] ^ step[3][state >> 24]


def _one_zero() -> np.ndarray:
    """The step of one zero byte: byte k of the state, on its own, afterwards."""
    zero = zlib.crc32(b"\0")
    own = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(bytes([0])) for b in range(256)], np.uint32)
    assert own[0] == 0 and zero == zlib.crc32(bytes(1))
    state = np.arange(256, dtype=np.uint32)
    return np.stack([own, *(state << np.uint32(8 * k - 8) for k in (1, 2, 3))])


def _twice(step: np.ndarray) -> np.ndarray:
    return np.stack([_advance(part, step) for part in step])


def _contribution() -> np.ndarray:
    step = _one_zero()
    rows = [step[0]]
    for _ in range(DEPTH - 1):
        rows.append(_advance(rows[-1], step))
    return np.concatenate(rows)


#: Element 256 * d + b: what byte b contributes at d bytes from the end of its span.
CONTRIBUTION = _contribution()


def _steps() -> list[np.ndarray]:
    """Steps of DEPTH, 2 * DEPTH, 4 * DEPTH ... zero bytes, for spans of up to 2**36 bytes."""
    step = _one_zero()
    for _ in range(DEPTH.bit_length() - 1):
        step = _twice(step)
    out = [step]
    while len(out) < 30:
        out.append(_twice(out[-1]))
    return out


STEPS = _steps()


def length_constants(lengths: np.ndarray) -> np.ndarray:
    """The CRC of as many zero bytes: what a span's CRC holds besides its bytes."""
    some, at = np.unique(lengths, return_inverse=True)
    value, done, out = 0, 0, []
    for n in some.tolist():
        while done < n:
            step = min(n - done, 1 << 20)
            value, done = zlib.crc32(bytes(step), value), done + step
        out.append(value)
    return np.array(out, np.uint32)[at]


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of every span of ``data`` (bytes); spans are not empty, ascend and don't overlap."""
    if not len(starts):
        return np.empty(0, np.uint32)
    lengths = ends - starts
    blocks = -(-lengths // DEPTH)
    first = np.cumsum(blocks) - blocks
    behind = np.repeat(blocks, blocks) - 1 - (np.arange(int(blocks.sum())) - np.repeat(first, blocks))  # blocks after this one
    block_end = np.repeat(ends, blocks) - behind * DEPTH
    block_start = np.maximum(block_end - DEPTH, np.repeat(starts, blocks))
    # a byte up to the next block's start belongs to this block, or to the gap after it
    size = np.diff(np.append(block_start, ends[-1]))
    distance = np.repeat(block_end, size) - 1 - np.arange(block_start[0], ends[-1])
    inside = distance >= 0
    value = np.where(inside, CONTRIBUTION[np.where(inside, distance, 0) * 256 + data[block_start[0] : ends[-1]]], np.uint32(0))
    found = np.bitwise_xor.reduceat(value, block_start - block_start[0])
    span = np.repeat(np.arange(len(starts)), blocks)
    level = 0
    while len(found) > len(starts):
        found = np.where(behind & 1, _advance(found, STEPS[level]), found)
        behind >>= 1
        new = np.append(True, (span[1:] != span[:-1]) | (behind[1:] != behind[:-1]))
        found, span, behind, level = np.bitwise_xor.reduceat(found, np.flatnonzero(new)), span[new], behind[new], level + 1
    return found ^ length_constants(lengths)


# The bytes of words, after A-Z became a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def pieces(offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Consecutive parts of a batch: bytes, the first byte of every row within, and whether the first row goes on from the part before.

    A part ends between rows once it holds PIECE bytes, or in a longer row before a byte that is in no word.
    """
    row, at, inside = 0, int(offsets[0]), False
    while row < len(offsets) - 1:
        last = max(int(np.searchsorted(offsets, at + PIECE, "right")) - 1, row)
        if last > row:
            stop = int(offsets[last])
        else:
            stop, end = at + PIECE, int(offsets[row + 1])
            while stop < end and IN_WORD[data[stop]]:
                free = np.flatnonzero(~IN_WORD[data[stop : min(stop + PIECE, end)]])
                stop = stop + int(free[0]) if len(free) else min(stop + PIECE, end)
            last = row + (stop >= end)
        heads = offsets[row:last] if last > row else offsets[row : row + 1]
        yield data[at:stop], np.maximum(heads, at) - at, inside
        inside, row, at = last == row, last, stop


def features(offsets: np.ndarray, data: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For every part of a batch: its first row, the bucket and the row of each feature, and its words per row.

    Rows count from the part's first one. The last word of a row that goes on in the next part is kept, for the pair it forms there.
    """
    first, before = 0, b""
    for part, heads, inside in pieces(offsets, data):
        first -= inside
        kept = before if inside else b""
        part = np.concatenate([np.frombuffer(kept + b" " if kept else b"", np.uint8), part])
        heads = np.where(np.arange(len(heads)) > 0, heads + len(kept) + (len(kept) > 0), heads) if kept else heads
        word = IN_WORD[part]
        edge = np.zeros(len(part) + 1, bool)
        edge[heads] = True
        prior = np.append(False, word[:-1])
        begin = np.flatnonzero(word & (~prior | edge[:-1]))
        ends = np.flatnonzero(word & np.append(~word[1:], True) | word & edge[1:]) + 1
        row = np.searchsorted(heads, begin, "right") - 1
        # the words, one space after each
        length = ends - begin
        stop = np.cumsum(length + 1)
        start = stop - length - 1
        stream = np.full(int(stop[-1]) if len(stop) else 0, 32, np.uint8)
        stream[np.repeat(start - begin, length) + np.flatnonzero(word)] = part[word]
        single = span_crcs(stream, start, stop - 1)
        paired = np.zeros(max(len(start) - 1, 0), np.uint32)
        for k in (0, 1):
            paired[k::2] = span_crcs(stream, start[k:-1:2], stop[k + 1 :: 2] - 1)
        new = slice(1 if kept else 0, None)
        same = row[1:] == row[:-1]
        found = np.concatenate([single[new], paired[same]]) % np.uint32(buckets)
        rows = np.concatenate([row[new], row[:-1][same]])
        yield first, found.astype(np.int64), rows, np.bincount(row[new], minlength=len(heads))
        tail = row == len(heads) - 1
        before = stream[start[-1] : stop[-1] - 1].tobytes() if tail.any() else kept if inside and len(heads) == 1 else b""
        first += len(heads)


def _bytes(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and lower-cased bytes of a text column; null as empty."""
    texts = batch.column(column).fill_null("").cast(pa.large_binary())
    _, where, values = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], LOWER[data[offsets[0] : offsets[-1]]]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; a task sends a row per bucket that it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found, _, _ in features(*_bytes(batch, "text"), buckets):
                total += np.bincount(found, minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    counted = small_batches(texts.select("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():  # at most one row per bucket
        out[r.bucket] = r.n
    return out


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """Log ratio of every bucket's smoothed shares, in thousandths, floored."""
    t, s, n = target.tolist(), corpus.tolist(), len(corpus)
    all_t, all_s = sum(t), sum(s)
    return np.array([math.floor(1000 * math.log((t[k] + 1) * (all_s + n) / ((s[k] + 1) * (all_t + n)))) for k in range(n)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, sums = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for first, found, row, count in features(*_bytes(batch, "text"), len(gain)):
                words[first : first + len(count)] += count
                np.add.at(sums, first + row, gain[found])
            size = words + np.maximum(words - 1, 0)
            weight = np.where(size > 0, sums // np.maximum(size, 1), 0)
            columns = [batch.column("doc_id"), pa.array(words), pa.array(size), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return small_batches(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document; documents that are not drawn have no rank.

    Of the documents with ``min_words`` words or more, ``percent`` percent are drawn, rounded down.
    """
    gain = gains(bucket_counts(target, buckets), bucket_counts(docs, buckets))
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), text_id), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0)))
    # written: the ranges are sampled from it, and the texts are not read again
    scored = stored(weights(docs, gain).withColumn("score", F.col("weight") + noise), "resample-scores")
    able = scored.filter(F.col("n_words") >= min_words)
    n_able = able.count()
    order = [F.col("score").desc(), F.col("doc_id").asc()]
    placed = in_blocks(able, order, n_able, "resample-order")
    sizes = placed.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # one row per block
    sizes = sizes.select("__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__block").orderBy(*order)) + F.col("__before")
    ranked = placed.join(sizes, "__block").withColumn("rank", place)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= percent * n_able // 100, F.col("rank")).cast("long"))
    rest = scored.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionByName(rest)
