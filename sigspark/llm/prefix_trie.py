"""Prefix trie of conversations that are rebuilt from a borrowed head and their own rest.

A conversation's turns are ordered by turn, null first, then the SHA-256 of role and text. A rebuilt
conversation is the first ``head`` turns of its ``base`` conversation (all, if fewer;
none, if there is none) and then its own turns after its first ``head``. A node of the trie is a
distinct sequence of rebuilt turns (role, text); its members are the rebuilt conversations that start with it.

Fingerprints. A turn has a value modulo each of several primes, from the SHA-256 of role and text; the
fingerprint of a sequence is the sum of value * base**position. Sequences then form a monoid: the product of x and y is x + base**len(x) * y.
Every stored conversation gets the running products of its own turns once. The prefix of a rebuilt
conversation is composed from three of those numbers, that of the head, and its own at two places,

    head[k] + (own[h + m] - own[h]) * base**(k - h)

and nothing is rebuilt: per prefix there is a narrow row with the fingerprint, that of the prefix before it, and a reference
(conversation and position) to the stored turn it ends with.

Verification. Equal sequences have equal fingerprints. To see that equal fingerprints mean equal sequences, every group of prefixes is checked:
all its members must end with the same turn, by the digest of the turn they refer to, and go on from the same group, so by induction over the depth the sequences
are the same. That equal digests mean equal turns is checked on the stored turns themselves, byte by byte. If a group fails,
all is done again with other bases and one more prime.

Sums over subtrees need no walk. A node's owner is its smallest member; what a conversation owns are its
prefixes from some depth on. A node's subtree holds, for every member, what that member owns from the node on, so
one running sum over each conversation and one aggregation over the prefixes give all subtree sums.

Scale. Rows are prefixes, about as many as turns, and narrow; the texts are shuffled once, for the check
of the digests, combined on the map side. Groups (a first turn that a third of all conversations share, the root) are combined on the map side, long conversations
are worked off in chunks by (conversation, chunk), see ``operators.segments``. The ids that end at a node are written down in blocks of
ID_BLOCK and digested as a sorted stream: SHA-256 is sequential, yet a task holds one block at a time.

Defined cases: null role or text counts as empty; rows without a conv_id belong to no conversation and are left out; repeated rows are turns
each; a rebuilt conversation may be empty and is then a member of the root only; an empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import small_batches
from sigspark.operators.segments import attach, chunked, with_positions
from sigspark.session import stored

# Primes below 2**31, so that products of two residues fit a long, and numbers to make bases from.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579, 2147483563, 2147483549)
BASES = (1103515245, 1664525, 22695477, 134775813, 214013, 69069)
#: Primes to begin with: 93 bits.
RESIDUES = 3
ID_BLOCK = 4096
#: Digits of the power tables: 4 digits of base 256.
DIGIT, DIGITS = 256, 4


def power(base: int, exponent: Column, prime: int) -> Column:
    """base**exponent modulo a prime, exponents from 0 to 2**32 - 1: a table look-up per digit."""
    out = None
    for place in range(DIGITS):
        table = ",".join(str(pow(base, digit * DIGIT**place, prime)) + "L" for digit in range(DIGIT))
        digit = F.floor(exponent / DIGIT**place) % DIGIT
        factor = F.element_at(F.expr(f"array({table})"), (digit + 1).cast("int"))
        out = factor if out is None else out * factor % prime
    return out


def totals_before(rows: DataFrame, keys: list[str], idx: str, values: dict[str, Column], size: int | None = None) -> DataFrame:
    """Running sums of longs up to and with each row, in chunks of a key plus the totals of earlier chunks."""
    w = Window.partitionBy(*keys, "_chunk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked(rows, idx, size).withColumns({name: F.sum(value).over(w) for name, value in values.items()})
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = local.groupBy(*keys, "_chunk").agg(*[F.max_by(name, idx).alias(f"__t_{name}") for name in values])
    sums = sums.select(*keys, "_chunk", *[F.coalesce(F.sum(f"__t_{name}").over(before), F.lit(0)).alias(f"__b_{name}") for name in values])
    joined = local.join(sums, [*keys, "_chunk"])
    return joined.withColumns({name: F.col(name) + F.col(f"__b_{name}") for name in values}).drop("_chunk", *[f"__b_{name}" for name in values])


def stored_turns(conversations: DataFrame, heavy_rows: int | None = None) -> DataFrame:
    """conv_id, pos (from 0), digest and n_bytes of every turn, as a stored table; checks that equal digests mean equal turns."""
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    named = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")
    rows = rows.select("conv_id", "turn", F.sha2(named, 256).alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"), "role", "text")
    ends = F.struct("role", "text")
    unlike = rows.groupBy("digest").agg(F.min(ends).alias("a"), F.max(ends).alias("b")).filter("a != b")
    if not unlike.isEmpty():
        raise ValueError("two different turns have the same SHA-256")
    placed = with_positions(rows.drop("role", "text"), ["conv_id"], "turn", ("digest",), heavy_rows=heavy_rows)
    return stored(placed.select("conv_id", "pos", "digest", "n_bytes"), "turns")


def running_products(turns: DataFrame, primes: tuple[int, ...], bases: list[int], size: int | None = None) -> DataFrame:
    """Adds, for each prime, t<i>: the turn's term, and s<i>: the product of the conversation's turns up to and with it."""
    terms = {}
    for i, (prime, base) in enumerate(zip(primes, bases)):
        value = F.conv(F.substring("digest", 1 + 15 * (i % 4), 15), 16, 10).cast("long")
        terms[f"t{i}"] = (value % (prime - 1) + 1) * power(base, F.col("pos"), prime) % prime
    rows = turns.withColumns(terms)
    return totals_before(rows, ["conv_id"], "pos", {f"s{i}": F.col(f"t{i}") for i in range(len(primes))}, size)


def prefixes(products: DataFrame, plan: DataFrame, primes: tuple[int, ...], bases: list[int], size: int | None = None) -> DataFrame:
    """Every prefix of every rebuilt conversation, as fingerprints.

    conv_id, depth, f (array of residues), p (those of the prefix before), ref (stored turn it ends with), digest, n_bytes, last. ``plan``
    has conv_id, n (its turns), base and head. Depth 0 is included.
    """
    every = range(len(primes))
    sums = F.array(*[F.col(f"s{i}") % primes[i] for i in every])
    terms = F.array(*[F.col(f"t{i}") for i in every])
    rows = products.select("conv_id", "pos", "digest", "n_bytes", sums.alias("s"), terms.alias("t"))
    zero = F.array(*[F.lit(0).cast("long") for _ in every])
    sizes = plan.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = plan.join(sizes, "base", "left").withColumn("k", F.least("head", F.coalesce("n_base", F.lit(0))))
    plan = plan.withColumn("length", F.col("k") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    at = rows.select(F.col("conv_id").alias("c"), F.col("pos").alias("at"), F.col("s"))
    # the head's product, and the own one that is left out
    plan = plan.join(at.select(F.col("c").alias("base"), (F.col("at") + 1).alias("k"), F.col("s").alias("a")), ["base", "k"], "left")
    plan = plan.join(at.select(F.col("c").alias("conv_id"), (F.col("at") + 1).alias("head"), F.col("s").alias("b")), ["conv_id", "head"], "left")
    plan = plan.withColumns({"a": F.coalesce("a", zero), "b": F.coalesce("b", zero)}).select("conv_id", "base", "n", "head", "k", "length", "a", "b")

    def composed(own: Column) -> Column:
        out = []
        for i, (prime, base) in enumerate(zip(primes, bases)):
            move = power(pow(base, -1, prime), F.col("head") - F.col("k"), prime)
            out.append((F.col("a")[i] + F.pmod(own[i] - F.col("b")[i], F.lit(prime)) * move) % prime)
        return F.array(*out)

    minus = F.array(*[F.pmod(F.col("s")[i] - F.col("t")[i], F.lit(primes[i])) for i in every])
    tail = attach(rows, plan.filter("n > head"), ["conv_id"], "pos", "n", size).filter("pos >= head")
    tail = tail.withColumn("depth", F.col("k") + F.col("pos") - F.col("head") + 1)
    ref = lambda owner: F.struct(F.col(owner).alias("conv_id"), F.col("pos").alias("pos")).alias("ref")
    tail = tail.select("conv_id", "depth", composed(F.col("s")).alias("f"), composed(minus).alias("p"), ref("conv_id"), "digest", "n_bytes", "length")
    # a base's first turns meet the conversations that borrow them
    borrowed = plan.filter("k > 0").select("conv_id", "base", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("pos"))
    heads = borrowed.join(rows.withColumnRenamed("conv_id", "base"), ["base", "pos"])
    heads = heads.select("conv_id", (F.col("pos") + 1).alias("depth"), F.col("s").alias("f"), minus.alias("p"), ref("base"), "digest", "n_bytes", "length")
    none = F.lit(None)
    tops = plan.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), zero.alias("f"), zero.alias("p"),
        none.cast("struct<conv_id:bigint,pos:bigint>").alias("ref"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("n_bytes"), "length",
    )
    found = tail.unionByName(heads).unionByName(tops)
    return found.withColumn("last", F.col("depth") == F.col("length")).withColumn("rest", F.col("length") - F.col("depth")).drop("length")


def digests_of_ids(ends: DataFrame, keys: list[str]) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of every key."""
    blocks = ends.groupBy(*keys, F.floor(F.col("conv_id") / ID_BLOCK).alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select(F.concat_ws("/", *[F.col(k).cast("string") for k in keys]).alias("node"), "block", F.array_join("ids", ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            names, values = [], []
            for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
                if name != node:
                    if node is not None:
                        names.append(node)
                        values.append(state.hexdigest())
                    node, state = name, hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.string())], ["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    return small_batches(blocks.repartition("node").sortWithinPartitions("node", "block")).mapInArrow(run, "node string, ends_sha256 string")


def verified(found: DataFrame) -> DataFrame | None:
    """The nodes of stored prefixes, or None if a fingerprint stands for two sequences.

    f, depth, conv_id (smallest member), p, ref, n_bytes, n_convs.
    """
    least = lambda c: F.min(c).alias(c)
    nodes = found.groupBy("depth", "f").agg(
        least("conv_id"), F.count(F.lit(1)).alias("n_convs"), least("p"), F.max("p").alias("p_max"), least("digest"), F.max("digest").alias("digest_max"),
        F.min_by("ref", "conv_id").alias("ref"), F.min("n_bytes").alias("n_bytes"),
    )
    nodes = stored(nodes, "nodes")
    if not nodes.filter("p != p_max OR digest != digest_max").isEmpty():
        return None
    return nodes.drop("p_max", "digest_max", "digest")


def prefix_trie(
    conversations: DataFrame, base: Column, head: Column, residues: int = RESIDUES, primes: tuple[int, ...] = PRIMES, size: int | None = None, heavy_rows: int | None = None
) -> DataFrame:
    """The trie's nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, ref.

    ``base`` and ``head`` are expressions of conv_id: whose first turns a conversation borrows, and how many. ``ref`` (conversation
    and position) names a stored turn that holds the node's last role and text.
    """
    turns = stored_turns(conversations, heavy_rows)
    plan = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    plan = stored(plan.select("conv_id", "n", base.cast("long").alias("base"), head.cast("long").alias("head")), "plan")
    nodes = None
    for attempt in range(len(BASES)):
        some = primes[: min(residues + attempt, len(primes))]
        bases = [pow(BASES[(i + attempt) % len(BASES)], attempt + 1, prime) for i, prime in enumerate(some)]
        if any(b == 0 for b in bases):
            continue
        # written: prefixes are composed from four readings of the products
        products = stored(running_products(turns, some, bases, size), "products")
        found = stored(prefixes(products, plan, some, bases, size), "prefixes")
        nodes = verified(found)
        if nodes is not None:
            break
    if nodes is None:
        raise ValueError("fingerprints collide with every set of primes")

    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p").alias("f")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["depth", "f"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = stored(nodes, "nodes-children")
    # what every conversation owns, summed from each depth to its end
    leaf = (F.col("n_children") == 0).cast("long")
    owned = nodes.select("conv_id", "depth", leaf.alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"))
    value = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    marked = found.select("conv_id", "depth", "f", "rest").join(owned, ["conv_id", "depth"], "left")
    sums = totals_before(marked, ["conv_id"], "rest", {"leaves": value("leaf"), "tokens": value("saved")}, size)
    below = sums.groupBy("depth", "f").agg(F.sum("leaves").alias("n_leaves"), F.sum("tokens").alias("saved_tokens"))
    ends = digests_of_ids(found.filter("last"), ["depth", "f"])
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f").alias("p"), F.col("conv_id").alias("parent_conv_id"))
    name = F.concat_ws("/", F.col("depth").cast("string"), F.col("f").cast("string"))
    out = nodes.join(below, ["depth", "f"]).withColumn("node", name).join(ends, "node", "left")
    out = out.join(parents, ["depth", "p"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "ref",
    )
