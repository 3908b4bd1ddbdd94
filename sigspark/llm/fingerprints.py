"""Document fingerprints: threshold-scaled sketches, which estimate containment.

A text's words are runs of ``[^\\x20\\x09-\\x0D]``; its shingles are the runs of
``words`` consecutive words, or all its words where there are fewer. A shingle's
hash is the first DIGITS hexadecimal digits of its MD5. The sketch keeps every
hash below a fixed ``fraction`` of all values, so it grows with the text:

* the sketch of several texts together is the union of theirs (``union_of``,
  ``merged``), whatever their sizes;
* of two sketches, the share of the smaller one's hashes that the other one holds
  estimates how much of the smaller text the larger one contains, and a short text
  in a very long one is found as well as one in a text of its own length.

A text with shingles but no hash below the threshold keeps its smallest hash, so
that equal short texts still have equal, non-empty sketches. In a union such a
hash goes as soon as another is below the threshold.

``with_next`` gives every document the start of the one after it, without a
global sort of texts: ids and digests are sorted in ranges, and each
document sends what its predecessor needs.

All of it is DataFrame functions.

Defined cases: null text counts as empty; a text without words has an empty
sketch, and two empty sketches are alike (1.0), an empty and another one not (0.0);
documents of one doc_id follow each other by the SHA-256 of their texts; equal
rows each give a row and follow each other; documents without a doc_id come first; the
document after the last is the first, so a single one is followed by itself; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import in_blocks, text_of

WORD = r"[^\x20\x09-\x0D]+"
WORDS = 5
FRACTION = 0.25
#: Hexadecimal digits of a hash: 48 bits.
DIGITS = 12


def limit_of(fraction: float) -> str:
    """The first hash that is not kept; hashes compare as text, as all have DIGITS digits."""
    if not 0 < fraction <= 1:
        raise ValueError("the fraction must be above 0 and at most 1")
    return "g" if fraction == 1 else f"{int(fraction * 16**DIGITS):0{DIGITS}x}"


def kept(hashes: Column, limit: str) -> Column:
    """What a sketch keeps of an array of hashes: sorted, distinct, below the limit, else the smallest."""
    low = F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < limit)))
    return F.when((F.size(low) > 0) | (F.size(hashes) == 0), low).otherwise(F.array(F.array_min(hashes)))


def with_sketch(rows: DataFrame, text: str, name: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Adds the sketch of a text column as array<string>.

    Words and hashes are columns of their own, as both are used more than once. A filter on the sketch may still put their
    expressions in its place, so no lambda refers to them: shingles are made of shifted copies of the words, element by element.
    """
    rows = rows.withColumn("__words", F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD), F.lit(0)))
    count = F.greatest(F.size("__words") - (words - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice("__words", F.lit(k + 1), count).alias(f"w{k}") for k in range(words)])
    digits = lambda shingle: F.substring(F.md5(shingle), 1, DIGITS)
    hashes = F.transform(shifted, lambda w: digits(F.concat_ws(" ", *[w[f"w{k}"] for k in range(words)])))
    whole = F.array(digits(F.array_join("__words", " ")))
    none = F.array().cast("array<string>")
    rows = rows.withColumn("__hashes", F.when(count > 0, hashes).when(F.size("__words") > 0, whole).otherwise(none))
    return rows.withColumn(name, kept(F.col("__hashes"), limit_of(fraction))).drop("__words", "__hashes")


def union_of(a: str | Column, b: str | Column, fraction: float = FRACTION) -> Column:
    """The sketch of two texts together, from theirs."""
    return kept(F.array_union(a, b), limit_of(fraction))


def merged(rows: DataFrame, by: list[str], sketch: str, fraction: float = FRACTION) -> DataFrame:
    """One row per group and hash of the group's sketch: columns ``by`` and ``hash``.

    A group's sketch grows with its texts, so it stays rows. Hashes are combined before the shuffle, and
    a group is spread over tasks by hash; the smallest ones are found by map-side combined aggregation.
    """
    limit = limit_of(fraction)
    hashes = rows.select(*by, F.explode(sketch).alias("hash")).distinct()
    low = hashes.filter(F.col("hash") < limit)
    least = hashes.groupBy(*by).agg(F.min("hash").alias("hash")).filter(F.col("hash") >= limit)
    return low.unionByName(least)


def containment(a: str | Column, b: str | Column) -> Column:
    """Estimated share of the smaller text's shingles that the larger text holds, 0 to 1."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise((F.size(a) == F.size(b)).cast("double"))


def as_text(sketch: str | Column) -> Column:
    """The hashes one after the other, ascending."""
    return F.array_join(sketch, "")


def packed(sketch: str | Column) -> Column:
    """A sketch as bytes, for shuffles: a quarter of the array of texts."""
    return F.unhex(as_text(sketch))


def unpacked(data: str | Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(data)), F.lit("." * DIGITS), F.lit(0))


def followed_by(docs: DataFrame, n_rows: int) -> DataFrame:
    """key, next_key, n_chars, copies of every distinct document (doc_id, text) in ascending order.

    ``docs`` has doc_id, digest, key and n_chars, no texts. Blocks of a stored table hold ranges of the order; the last row
    of a block is followed by the first one of the next block, which a window over one row per block finds.
    """
    ids = docs.groupBy("doc_id", "digest", "key").agg(F.first("n_chars").alias("n_chars"), F.count(F.lit(1)).alias("copies"))
    placed = in_blocks(ids, ["doc_id", "digest"], n_rows, "document-order")
    order = Window.partitionBy("__block").orderBy("doc_id", "digest")
    firsts = placed.groupBy("__block").agg(F.min_by("key", F.struct("doc_id", "digest")).alias("first"))
    blocks = Window.orderBy("__block")
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = firsts.select("__block", F.coalesce(F.lead("first").over(blocks), F.first("first").over(whole)).alias("after"))
    inside = placed.withColumn("inside", F.lead("key").over(order))
    return inside.join(firsts, "__block").select("key", F.coalesce("inside", "after").alias("next_key"), "n_chars", "copies")


def with_next(docs: DataFrame, share: int = 4, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """doc_id, text, n_chars, sketch, head and next_sketch: the first floor(n_chars / share) code points of the next document, and its sketch.

    Texts are shuffled once, by document; from there heads and sketches go to the predecessors. Equal rows are combined
    before the shuffle and counted.
    """
    id_text = F.when(F.col("doc_id").isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col("doc_id").cast("string")))
    rows = docs.select("doc_id", text_of().alias("text"))
    digest = F.sha2(F.col("text"), 256)
    order = followed_by(
        rows.select("doc_id", digest.alias("digest"), F.concat(digest, id_text).alias("key"), F.length("text").cast("long").alias("n_chars")), docs.count()
    )
    # one struct, so that both uses below read the same columns and share one shuffle
    texts = rows.groupBy(F.concat(digest, id_text).alias("key")).agg(F.first(F.struct("doc_id", "text")).alias("doc"))
    asked = order.select(F.col("next_key").alias("key"), F.col("key").alias("to"), F.floor(F.col("n_chars") / share).cast("int").alias("take"))
    sent = with_sketch(texts.join(asked, "key").withColumn("text", F.col("doc.text")), "text", "next_sketch", words, fraction)
    sent = sent.select(F.col("to").alias("key"), F.substring(F.col("text"), F.lit(1), F.col("take")).alias("head"), packed("next_sketch").alias("packed"))
    found = texts.join(order.select("key", "n_chars", "copies"), "key").join(sent, "key").select("*", "doc.*")
    found = with_sketch(found, "text", "sketch", words, fraction).withColumn("next_sketch", unpacked("packed"))
    # of equal rows, each but the last is followed by the next of them
    own = F.struct(
        F.substring(F.col("text"), F.lit(1), F.floor(F.col("n_chars") / share).cast("int")).alias("head"), F.col("sketch").alias("next_sketch"), (F.col("copies") - 1).alias("times")
    )
    other = F.struct("head", "next_sketch", F.lit(1).cast("long").alias("times"))
    kinds = F.when(F.col("copies") > 1, F.array(other, own)).otherwise(F.array(other))
    return found.select("doc_id", "text", "n_chars", "sketch", F.inline(kinds))


def edited_fingerprints(docs: DataFrame, share: int = 4, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Fingerprints of every document and of its text with the last ``1 / share`` replaced by the start of the next document's.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next; a row per document.
    """
    rows = with_next(docs, share, words, fraction)
    left = (F.col("n_chars") - F.floor(F.col("n_chars") / share)).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), left), "head"))
    rows = with_sketch(rows, "edited", "edited_sketch", words, fraction)
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        containment("sketch", "edited_sketch").alias("near_edited"),
        containment("sketch", "next_sketch").alias("near_next"),
        "times",
    )
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).drop("__copy", "times")
