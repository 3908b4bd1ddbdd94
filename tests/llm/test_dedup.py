"""Exact and near duplicates against plain versions."""
import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from sigspark.llm import exact_dedup, near_dedup
from sigspark.llm.components import components

SCHEMA = "doc_id long, text string, digest string, n int, `count` int, first string"


def frame(spark, rows):
    """Documents with further columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, "x", 1, 2, "y") for i, t in rows], SCHEMA)


def rng_words(rng, n):
    return ["w%d" % k for k in rng.integers(0, 4000, n)]


def exact_by_hand(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for clean, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))[0]
        sha = hashlib.sha256(clean.encode()).hexdigest()
        out += [(i, keep, len(members), sha) for i, _ in members]
    return sorted(out, key=str)


EXACT = [
    (5, "a b c"), (1, "abc"), (2, " a b\tc\n"), (9, None), (3, ""), (4, " \x0b\x0c\r"), (6, "a b"), (7, "a b"), (8, "ABC"),
    (10, "\U0001d518 x"), (11, "\U0001d518x"), (12, "long " * 50_000), (13, "long" * 50_000),
]


def test_exact_groups(spark):
    got = exact_dedup.exact_duplicates(frame(spark, EXACT)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == exact_by_hand(EXACT)
    assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def test_exact_checks_bytes_where_the_digest_is_weak(spark):
    weak = lambda c: F.substring(F.sha2(c, 256), 1, 1)
    rows = EXACT + [(100 + i, f"text {i % 40}") for i in range(120)]
    got = exact_dedup.exact_duplicates(frame(spark, rows), digest=weak).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == exact_by_hand(rows)


def test_exact_state_lasts_over_batches(spark):
    rows = [(i, f"text {i % 7}") for i in range(70)]
    got = exact_dedup.exact_duplicates(frame(spark, rows).repartition(6), files_per_batch=1).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == exact_by_hand(rows)


def test_exact_repeated_rows_and_null_ids(spark):
    rows = [(1, "x"), (1, "x"), (2, "x"), (None, "x"), (None, "y"), (3, "z"), (3, "z z")]
    got = exact_dedup.exact_duplicates(frame(spark, rows))
    assert sorted([(r.doc_id, r.keep_id, r.group_size) for r in got.collect()], key=str) == sorted(
        [(1, 1, 4), (1, 1, 4), (2, 1, 4), (None, 1, 4), (None, None, 1), (3, 3, 1), (3, 3, 1)], key=str
    )
    kept = exact_dedup.without_exact_duplicates(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted([(1, "x"), (None, "y"), (3, "z"), (3, "z z")], key=str)


def test_empty_tables(spark):
    assert exact_dedup.exact_duplicates(frame(spark, [])).count() == 0
    assert exact_dedup.without_exact_duplicates(frame(spark, [])).count() == 0
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0
    assert near_dedup.without_near_duplicates(frame(spark, [])).count() == 0


def sets_of(rows, words):
    out = {}
    for i, t in rows:
        found = [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        n = min(words, len(found))
        out[i] = {tuple(found[k : k + n]) for k in range(len(found) - n + 1)} if found else set()
    return out


def near_by_hand(rows, words, threshold=80):
    sets = sets_of(rows, words)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                one, two = sorted((find(a), find(b)))
                root[two] = one
    return sorted((i, len(sets[i]), find(i), find(i) == i) for i in ids)


def near_rows():
    """Chains of near copies, exact copies, a shared passage, short texts and odd ones."""
    rng = np.random.default_rng(3)
    rows, passage = [], rng_words(rng, 40)
    for chain in range(12):
        words = rng_words(rng, 90)
        for step in range(9):
            rows.append((len(rows) * 7 % 1009, " ".join(words)))
            for _ in range(2):
                words[rng.integers(0, len(words))] = "edit%d.%d" % (chain, step)
    for _ in range(60):
        rows.append((2000 + len(rows), " ".join([*rng_words(rng, 25), *passage, *rng_words(rng, 15)])))
    rows += [(3000 + i, rows[3][1].upper() if i % 2 else rows[3][1]) for i in range(20)]
    rows += [(4000, None), (4001, ""), (4002, " \n"), (4003, "one two"), (4004, "One\tTWO"), (4005, "one"), (4006, "a b c d"), (4007, "a b c d e")]
    rows += [(4008, "x" * 300_000), (4009, "x" * 300_000 + " y"), (4010, "É a b c d e f g h"), (4011, "é a b c d e f g h")]
    return rows


def test_near_groups(spark):
    rows = near_rows()
    for words in (4, 5):
        got = near_dedup.near_duplicates(frame(spark, rows), words=words)
        assert sorted(tuple(r) for r in got.collect()) == near_by_hand(rows, words)


def test_near_finishes_buckets_of_several_components(spark, monkeypatch):
    """With one row a band and small blocks, buckets hold many unlike documents and have many cells."""
    monkeypatch.setattr(near_dedup, "BLOCK", 1000)
    monkeypatch.setattr(near_dedup, "BANDS", 40)
    monkeypatch.setattr(near_dedup, "ROWS", 1)
    rows = near_rows()
    got = near_dedup.near_duplicates(frame(spark, rows), words=4)
    assert sorted(tuple(r) for r in got.collect()) == near_by_hand(rows, 4)


def test_near_repeated_rows_and_null_ids(spark):
    text = " ".join("w%d" % i for i in range(30))
    rows = [(2, text), (2, text), (7, text + " more"), (None, text), (None, None), (9, "other words here now")]
    got = sorted([tuple(r) for r in near_dedup.near_duplicates(frame(spark, rows)).collect()], key=str)
    assert got == sorted([(2, 26, 2, True), (2, 26, 2, True), (7, 27, 2, False), (None, 26, None, True), (None, 0, None, True), (9, 1, 9, True)], key=str)
    kept = near_dedup.without_near_duplicates(frame(spark, rows))
    assert sorted([r.doc_id for r in kept.collect()], key=str) == sorted([2, 2, None, None, 9], key=str)


def test_components_of_paths_stars_and_cycles(spark):
    rng = np.random.default_rng(5)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(3000 + i, 3000 + (i + 1) % 50) for i in range(50)]
    edges += [(int(a), int(b)) for a, b in 5000 + rng.integers(0, 400, (350, 2))]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        one, two = sorted((find(a), find(b)))
        root[two] = one
    want = {i: find(i) for e in edges if e[0] != e[1] for i in e}
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
