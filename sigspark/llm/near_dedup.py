"""Near duplicates: MinHash, banding, signature verification, exact check, components.

Words are ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered; a document's set
holds its distinct shingles of ``words`` words (with fewer words the whole
sequence is the one shingle). Documents are linked when
100 * intersection >= threshold * union, counted on the full sets.

1. ``sketches``: set size, a 128-bit digest of the set, and HASHES minima of
   strongly universal hashes (a * x + b) >> 32.
2. Documents with equal sets are one class, represented by its least doc_id
   (combined before the shuffle).
3. BANDS bands of ROWS minima. In a bucket, every member is compared with the
   bucket's least member only: first by the signatures, then on the full
   sets. Components of these links come from large-star and small-star.
4. Buckets of one least member are taken together; where they still span several
   components, they are finished exactly. Their members' full sets are dealt in
   blocks of about BLOCK shingles; inside a task, members outside the largest
   component are compared with all others by an inverted index, and only links
   that join components not joined yet are returned. So no link between
   different texts that matters is lost, and no group emits its pairs.
   Components are then computed again.

With 40 bands of 5 rows a pair at similarity 0.8 shares no band with
probability (1 - 0.8**5)**40 = 1.3e-7; a signature estimate falls MARGIN (0.15,
more than five standard deviations) below the true similarity about as rarely.

Defined cases: null and empty texts have an empty set and are linked with
nothing; a row without doc_id is linked with nothing and kept, its component is
null; repeated rows of one doc_id share a component; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.llm.common import WordHashes, encoded, map_texts, maybe_in
from sigspark.llm.components import components
from sigspark.session import stored

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
MARGIN = 0.15
#: Shingles that one block of the finishing pass holds.
BLOCK = 400_000
_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**63, HASHES, dtype=np.uint64)
_WORDS = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the shingles of a text."""
    found = text.lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    n = min(words, len(codes))
    total = np.full(len(codes) - n + 1, n, np.uint64)
    for i in range(n):
        total = mixed(total + codes[i : len(codes) - n + 1 + i])
    return np.unique(total)


def signature(found: np.ndarray) -> np.ndarray:
    """HASHES minima as 32-bit values; 4096 shingles at a time."""
    low = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    x = found >> np.uint64(32)
    for i in range(0, len(x), 4096):
        part = x[i : i + 4096]
        for j in range(0, HASHES, 25):
            low[j : j + 25] = np.minimum(low[j : j + 25], (_A[j : j + 25, None] * part + _B[j : j + 25, None]).min(axis=1))
    return (low >> np.uint64(32)).astype("<u4")


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest (16 bytes), signature (4 * HASHES bytes)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, signatures = [], [], []
        for text in encoded(batch, "text"):
            found = shingles(text, words)
            sizes.append(len(found))
            digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
            signatures.append(signature(found).tobytes() if len(found) else b"")
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
            ["doc_id", "n_shingles", "digest", "signature"],
        )

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, n_shingles long, digest binary, signature binary")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id and its shingle hashes as an array."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = [shingles(text, words).view(np.int64) for text in encoded(batch, "text")]
        ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
        arrays = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts), pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), arrays], ["doc_id", "shingles"])

    return map_texts(docs.select("doc_id", "text"), run, "doc_id long, shingles array<long>")


@F.pandas_udf(T.DoubleType())
def estimate(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal minima of two signatures."""
    if not len(a):
        return pd.Series([], dtype="float64")
    left = np.frombuffer(b"".join(a), "<u4").reshape(len(a), -1)
    right = np.frombuffer(b"".join(b), "<u4").reshape(len(b), -1)
    return pd.Series((left == right).mean(axis=1))


def sizes_fit(a: Column, b: Column, threshold: int) -> Column:
    """Whether two set sizes allow the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def likely(pairs: DataFrame, nodes: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) whose signatures don't rule the similarity out."""
    wanted = nodes_in(pairs)
    nodes = stored(maybe_in(nodes.select("node", "n_shingles", "signature"), "node", wanted, "node"), "signatures")
    one = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("signature").alias("sa"))
    two = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("signature").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").filter(sizes_fit(F.col("na"), F.col("nb"), threshold))
    return both.filter(estimate("sa", "sb") >= threshold / 100 - MARGIN).select("a", "b")


def sets_of(wanted: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """doc_id and shingles of the documents in ``wanted`` (distinct node)."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # an inner join: a semi-join would be moved below the filter
    texts = maybe_in(source, "doc_id", wanted, "node").join(wanted, F.col("doc_id") == F.col("node"))
    return stored(full_sets(texts, words), "shingle-sets")


def nodes_in(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that reach the similarity on their full sets."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").withColumn("both", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("both") * 100 >= (F.size("sa") + F.size("sb") - F.col("both")) * threshold).select("a", "b")


def band_rows(nodes: DataFrame) -> DataFrame:
    """(key, node): one row per band of a node."""
    width = 4 * ROWS
    keys = [F.xxhash64(F.lit(i), F.substring("signature", i * width + 1, width)) for i in range(BANDS)]
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "node")


def spread_members(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(first, node, component, main) of the groups of ``members`` (first, node) in several components.

    ``labels`` has the component of linked nodes; main is the largest one of a group.
    """
    placed = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = stored(placed.select("first", "node", "component"), "members")
    per = placed.groupBy("first", "component").agg(F.count(F.lit(1)).alias("n"))
    spread = per.groupBy("first").agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("members"), F.max(F.struct("n", "component")).alias("most"))
    # of two members the star has compared the only pair
    return placed.join(spread.filter("parts > 1 AND members > 2").select("first", F.col("most.component").alias("main")), "first")


def joining_links(members: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Links (a, b) that join components inside the groups of ``members``.

    A group's members are dealt to blocks, and every pair of blocks is one cell.
    """
    sized = members.join(sets.select(F.col("doc_id").alias("node"), "shingles"), "node")
    blocks = sized.groupBy("first").agg(F.ceil(F.sum(F.size("shingles").cast("long")) / BLOCK).cast("int").alias("blocks"))
    dealt = sized.join(blocks, "first").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = cells.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))

    def compare(cell: pa.Table) -> pa.Table:
        return pa.table(dict(zip("ab", joins(cell, threshold), strict=True)))

    narrow = cells.select("first", "p", "q", "block", "node", "component", (F.col("component") == F.col("main")).alias("in_main"), "shingles")
    return narrow.groupBy("first", "p", "q").applyInArrow(compare, "a long, b long")


def joins(cell: pa.Table, threshold: int) -> tuple[pa.Array, pa.Array]:
    """Links of a cell that join components, by an inverted index over its sets."""
    cell = cell.combine_chunks().sort_by("node")
    node, component, block = (cell.column(c).to_numpy() for c in ("node", "component", "block"))
    in_main = cell.column("in_main").to_numpy(zero_copy_only=False)
    lists = cell.column("shingles").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
    shingle = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(node)), sizes)
    order = np.argsort(shingle, kind="stable")
    holders, held = owner[order], np.bincount(shingle)
    begins, starts = np.cumsum(held) - held, np.cumsum(sizes) - sizes
    two_blocks = block.min() != block.max()
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while root.setdefault(c, c) != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    links: list[tuple[int, int]] = []
    for x in np.nonzero(~in_main)[0]:
        own = shingle[starts[x] : starts[x] + sizes[x]]
        own = own[held[own] > 1]
        if len(own) * 100 < sizes[x] * threshold:
            continue  # too few of its shingles occur elsewhere
        met = np.concatenate([holders[b : b + n] for b, n in zip(begins[own], held[own], strict=True)])
        both = np.bincount(met, minlength=len(node))
        near = (both * 100 >= (sizes + sizes[x] - both) * threshold) & (component != component[x])
        if two_blocks:
            near &= block != block[x]
        where = np.nonzero(near)[0]
        for y in where[np.unique(component[where], return_index=True)[1]]:  # one member of each component
            one, two = find(int(component[x])), find(int(component[y]))
            if one != two:
                root[one] = two
                links.append((int(node[x]), int(node[y])))
    return pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components once more, from the stars found so far and further links (a, b)."""
    stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return stored(components(stars.union(links), "a", "b"), "components")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable), kept; a row per row of ``docs``."""
    rows = stored(sketches(docs, words), "sketches")
    nodes = stored(
        rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")),
        "classes",
    )
    bands = band_rows(nodes)
    buckets = stored(bands.groupBy("key").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("members")).filter("members > 1"), "buckets")
    shared = maybe_in(bands, "key", buckets, "key").join(buckets, "key")
    members = stored(shared.select("first", "node").distinct(), "bucket-members")
    stars = members.filter(F.col("node") != F.col("first")).select(F.col("first").alias("a"), F.col("node").alias("b"))
    pairs = stored(likely(stars, nodes, threshold), "likely-pairs")
    links = stored(confirmed(pairs, sets_of(nodes_in(pairs), docs, words), threshold), "links")
    labels = stored(components(links, "a", "b"), "components")
    apart = stored(spread_members(members, labels), "spread")
    if not apart.isEmpty():
        sets = sets_of(apart.select("node").distinct(), docs, words)
        more = stored(joining_links(apart, sets, threshold), "more-links")
        if not more.isEmpty():
            labels = joined_components(labels, more)
    classes = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component_id"))
    found = rows.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    own = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"), F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"))


def without_near_duplicates(docs: DataFrame, words: int = 5, threshold: int = 80) -> DataFrame:
    """One document of each group, the one with the least doc_id; all columns.

    Rows without a doc_id stay.
    """
    gone = stored(near_duplicates(docs, words, threshold).filter(~F.col("kept")).select(F.col("doc_id").alias("__id")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left_anti")
