"""The prefix trie against a plain one, with long conversations, collisions and chunks of a few turns."""
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from sigspark.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, f string, _chunk int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def trie(df, **kw):
    conv = F.col("conv_id")
    return pt.prefix_trie(df, conv - conv % 5, F.crc32(conv.cast("string")) % 9, **kw)


def by_hand(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            tie = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()
            convs.setdefault(c, []).append((t is not None, t or 0, tie, r, x))
    convs = {c: [x[3:] for x in sorted(turns)] for c, turns in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = tuple(convs.get(base, [])[:h] + own[h:])
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    kids, sums = {}, {}
    for node in members:
        if node:
            kids[node[:-1]] = kids.get(node[:-1], 0) + 1
    for node in members:
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        for d in range(len(node) + 1):
            leaves, tokens = sums.get(node[:d], (0, 0))
            sums[node[:d]] = leaves + (node not in kids), tokens + saved
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), kids.get(node, 0), *sums[node], sha(ends.get(node, [])))
        for node, m in members.items()
    )


def collected(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(*names).collect())


def made(seed, convs, turns, words):
    """Many equal turns, so that prefixes are shared by chance."""
    r = random.Random(seed)
    return [(c, t, r.choice(["user", "assistant"]), "é" * r.randrange(words)) for c in range(convs) for t in range(r.randrange(1, turns))]


ROWS = [
    *made(1, 160, 13, 2), *((200, t, "user", f"turn {t % 3}") for t in range(300)), *((201, t, "user", f"turn {t % 3}") for t in range(290)),
    (-1, 0, "user", "negative"), (-7, 0, None, None), (-7, 1, "", ""), (-5, 0, "user", "base"), (None, 0, "user", "no id"), (None, 0, "user", "no id"),
    (300, None, "a", "null turn"), (300, 0, "a", "tie"), (300, 0, "b", "tie"), (300, 0, "b", "tie"), (301, 5, "ab", "c"), (302, 5, "a", "bc"), (10**15, 0, "user", "far"),
    (401, 0, "x" * 50, "long \U0001d518" * 50_000),
]


def test_against_plain_version(spark):
    assert collected(trie(frame(spark, ROWS))) == by_hand(ROWS)


def test_tiny_chunks_and_heavy_conversations(spark):
    assert collected(trie(frame(spark, ROWS), size=3, heavy_rows=100)) == by_hand(ROWS)


def test_colliding_fingerprints_are_found_and_made_anew(spark):
    tried = []
    verified = pt.verified

    def counted(found):
        tried.append(len(found.head().f))
        return verified(found)

    pt.verified = counted
    try:
        got = collected(trie(frame(spark, ROWS), residues=1, primes=(101, 103, *pt.PRIMES)))
    finally:
        pt.verified = verified
    assert got == by_hand(ROWS) and len(tried) > 1
    with pytest.raises(ValueError, match="collide"):
        trie(frame(spark, ROWS), residues=1, primes=(101,))


def test_ids_of_a_node_in_several_blocks(spark):
    rows = [(5 * c, 0, "user", "same") for c in range(9000)]
    assert collected(trie(frame(spark, rows))) == by_hand(rows)


def test_reference_names_a_turn_with_the_last_text(spark):
    rows = made(2, 60, 6, 3)
    df = frame(spark, rows)
    texts = {(c, t): (r, x) for c, t, r, x in rows}
    for r in trie(df).filter("depth > 0").collect():
        own = texts[(r.ref.conv_id, r.ref.pos)]
        h = zlib.crc32(str(r.conv_id).encode()) % 9
        base = [x for x in rows if x[0] == r.conv_id - r.conv_id % 5][:h]
        rebuilt = base + [x for x in rows if x[0] == r.conv_id][h:]
        assert rebuilt[r.depth - 1][2:] == own


def test_power(spark):
    out = spark.createDataFrame([(n,) for n in (0, 1, 255, 256, 65_537, 2**31 + 12345)], "n long").select("n", pt.power(69069, F.col("n"), pt.PRIMES[0]).alias("p"))
    assert all(r.p == pow(69069, r.n, pt.PRIMES[0]) for r in out.collect())


def test_few_rows(spark):
    assert collected(trie(frame(spark, []))) == []
    assert collected(trie(frame(spark, [(None, 0, "user", "x")]))) == []
    assert collected(trie(frame(spark, [(3, 0, "user", "x")]))) == by_hand([(3, 0, "user", "x")])
