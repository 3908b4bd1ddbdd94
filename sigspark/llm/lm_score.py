"""Cross-entropy difference of documents under two matched n-gram models.

The target model is counted on the target documents and the background model
on all documents. Both are interpolated bigram models over one vocabulary: words
(``[^\\x20\\x09-\\x0D]+`` with A-Z lowered) and pairs of neighbouring words, each
known by 64 bits of a hash. They have the same order, words and
smoothing, and the background counts are scaled to the size of the target, so a
difference in loss is one of content.

    P(w) = (c(w) + 1) / (N + WORD_SLOTS),    P(w | v) = (c(v, w) + PRIOR * P(w)) / (c(v) + PRIOR)

WORD_SLOTS only smooths: it is no limit to the words that are counted, and as both
models have the same N it shifts both alike.

Every word and pair that occurs is counted, so the counts grow with the corpus and
stay distributed; neither the driver nor a broadcast holds them.

1. ``blocks`` reads every whole text once. A row is a block of documents of about
   BLOCK tokens: its distinct words, and its tokens as places among them.
2. ``asked`` adds up the words and pairs of a block and cuts the sorted keys
   into ranges of the key space, whose number grows with the corpus.
3. ``answered`` adds up a range over all blocks and gives every block the sums of
   its own keys, in their order. The commonest pair is one entry of a block, so
   no key is heavier than the number of blocks.
4. ``scores`` brings a block and its sums together and scores its documents.

score = mean over a document's tokens of loss under target minus loss under
background; a lower score is closer to the target.

Defined cases: null and empty texts have no tokens and null losses; rows of the
target without a doc_id or without a document don't count; repeated rows
count and score each; without target documents the target model is uniform
over the vocabulary; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import WordHashes, encoded, small_batches
from sigspark.session import stored

#: Words that the smoothing of P(w) stands for.
WORD_SLOTS = 1 << 18
PRIOR = 4.0
#: Tokens of a block (a longer document is a block alone), and bytes of text for each range of keys.
BLOCK, RANGE_BYTES = 1_000_000, 16_000_000
_WORDS = WordHashes()


def words_of(text: bytes) -> np.ndarray:
    found = text.lower().split()
    return np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))


def pairs_of(words: np.ndarray) -> np.ndarray:
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]
    return (pairs ^ (pairs >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def tokens(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of a text's words, and of pairs of neighbouring words (one fewer)."""
    words = words_of(text)
    return words, pairs_of(words)


def squeezed(values: np.ndarray) -> bytes:
    """64-bit numbers by planes of bytes, compressed."""
    return pa.compress(np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T), codec="zstd", asbytes=True)


def unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, 8 * n, codec="zstd"), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def steps(keys: np.ndarray) -> bytes:
    """Sorted keys, as differences."""
    return squeezed(np.diff(keys, prepend=np.uint64(0)))


def keys_of(data: bytes, n: int) -> np.ndarray:
    return np.cumsum(unsqueezed(data, n), dtype=np.uint64)


def blocks(docs: DataFrame, most: int = BLOCK) -> DataFrame:
    """block, ids (doc_id) and sizes of its documents, n and words (sorted keys), tokens (places among them)."""

    def row(block: int, ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
        words, places = np.unique(np.concatenate(texts), return_inverse=True)
        columns = [[block], [ids], [[len(t) for t in texts]], [len(words)], [steps(words)], [squeezed(places)]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["block", "ids", "sizes", "n", "words", "tokens"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), encoded(batch, "text"), strict=True):
                words = words_of(text)
                if ids and size + len(words) > most:
                    yield row(block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
                ids.append(i)
                texts.append(words)
                size += len(words)
        if ids:
            yield row(block, ids, texts)

    rows = small_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    return rows.mapInArrow(run, "block long, ids array<long>, sizes array<long>, n long, words binary, tokens binary")


def opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word keys, tokens (places among them), the document of each, places of tokens after another one of their document, and the pairs there."""
    sizes = np.array(row["sizes"], np.int64)
    words = keys_of(row["words"], row["n"])
    places = unsqueezed(row["tokens"], int(sizes.sum())).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    second = np.nonzero(owner[1:] == owner[:-1])[0] + 1
    pairs = pairs_of(words[places])[second - 1] if len(second) else np.zeros(0, np.uint64)
    return words, places, owner, second, pairs


def asked(rows: DataFrame, ranges: int) -> DataFrame:
    """range, block, n, keys, background, target: the counts of every block, from ``blocks`` and ``good``
    (places of its target documents). Ranges of words have odd numbers, those of pairs even ones."""
    edges = np.array([(r << 64) // ranges for r in range(1, ranges)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                words, places, owner, second, pairs = opened(row)
                good = np.zeros(len(row["sizes"]), bool)
                good[row["good"] or []] = True
                found, at = np.unique(pairs, return_inverse=True)
                for kind, keys, spots, wanted in ((0, found, at, good[owner[second]]), (1, words, places, good[owner])):
                    background, target = np.bincount(spots, minlength=len(keys)), np.bincount(spots[wanted], minlength=len(keys))
                    cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
                    out = [
                        (2 * r + kind, row["block"], e - b, steps(keys[b:e]), squeezed(background[b:e]), squeezed(target[b:e]))
                        for r, (b, e) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                        if e > b
                    ]
                    columns = zip(*out, strict=True) if out else [[]] * 6
                    types = [pa.int64()] * 3 + [pa.binary()] * 3
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["range", "block", "n", "keys", "background", "target"])

    return rows.mapInArrow(run, "range long, block long, n long, keys binary, background binary, target binary")


def answered(counts: DataFrame) -> DataFrame:
    """range, block, n, background, target: sums over all blocks for the keys of each block, in their order."""

    def run(group: pa.Table) -> pa.Table:
        sizes = group.column("n").to_pylist()
        keys = np.concatenate([keys_of(d, n) for d, n in zip(group.column("keys").to_pylist(), sizes, strict=True)])
        _, at = np.unique(keys, return_inverse=True)
        del keys
        ends, out = np.cumsum(sizes)[:-1], []
        for name in ("background", "target"):
            own = np.concatenate([unsqueezed(d, n) for d, n in zip(group.column(name).to_pylist(), sizes, strict=True)])
            # sums of doubles are exact below 2**53
            total = np.bincount(at, weights=own).astype(np.uint64)[at]
            out.append(pa.array([squeezed(x) for x in np.split(total, ends)], pa.binary()))
        return pa.table([*(group.column(c) for c in ("range", "block", "n")), *out], names=["range", "block", "n", "background", "target"])

    return counts.groupBy("range").applyInArrow(run, "range long, block long, n long, background binary, target binary")


def losses(pair_counts: np.ndarray, context: np.ndarray, p: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Negative log-likelihood of each token, from P(w) of each and the counts of those after another."""
    p = p.copy()
    p[second] = (np.minimum(pair_counts, context) + PRIOR * p[second]) / (context + PRIOR)
    return -np.log(p)


def scores(rows: DataFrame, sums: DataFrame, size: dict[str, int]) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score; a row per document. ``size``: tokens of either model."""
    scale = {"target": 1.0, "background": size["target"] / size["background"] if size["target"] and size["background"] else 1.0}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        _, places, owner, second, pairs = opened(row)
        _, at = np.unique(pairs, return_inverse=True)
        parts = sorted(right.to_pylist(), key=lambda r: r["range"])
        n = np.array(row["sizes"], np.int64)
        mean = {}
        for name, factor in scale.items():
            pair_counts, word_counts = (
                np.concatenate([np.zeros(0), *(unsqueezed(r[name], r["n"]) * factor for r in parts if r["range"] % 2 == kind)]) for kind in (0, 1)
            )
            p = (word_counts + 1) / (size[name] * factor + WORD_SLOTS)
            each = losses(pair_counts[at], word_counts[places[second - 1]], p[places], second)
            with np.errstate(invalid="ignore"):
                mean[name] = np.bincount(owner, weights=each, minlength=len(n)) / n
        none = n == 0
        columns = [pa.array(row["ids"], pa.int64()), pa.array(n)]
        columns += [pa.array(x, pa.float64(), mask=none) for x in (mean["target"], mean["background"], mean["target"] - mean["background"])]
        return pa.table(columns, names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])

    return rows.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(run, "doc_id long, n_tokens long, target_loss double, background_loss double, score double")


def cross_entropy_difference(docs: DataFrame, targets: DataFrame, block: int = BLOCK, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every document scored for its closeness to the target documents; ``targets`` has their doc_id."""
    ids = targets.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("__id")).distinct()
    rows = stored(blocks(docs, block), "blocks")
    each = rows.select("block", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "doc"))
    # the targets grow with the documents: joined by merging at any size, never broadcast
    good = each.join(ids.hint("merge"), F.col("doc.ids") == F.col("__id"), "left_semi")
    good = stored(good.groupBy("block").agg(F.collect_list("place").alias("good"), F.sum("doc.sizes").alias("size")), "targets")
    size = {"background": each.agg(F.sum("doc.sizes")).head()[0] or 0, "target": good.agg(F.sum("size")).head()[0] or 0}
    volume = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    # the same rows for counting and scoring, so that one exchange by block serves both
    rows = rows.join(good.select("block", "good").hint("merge"), "block", "left")
    return scores(rows, answered(asked(rows, max(1, -(-volume // range_bytes)))), size)
