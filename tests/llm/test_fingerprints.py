"""Threshold-scaled sketches against a plain version, and their algebra."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sigspark.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, sketch int, head string, __words string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


def sketch(text, words=5, limit="4" + "0" * 11):
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    hs = {hashlib.md5(" ".join(ws[i : i + words]).encode()).hexdigest()[:12] for i in range(max(len(ws) - words + 1, 1))} if ws else set()
    return sorted(h for h in hs if h < limit) or sorted(hs)[:1]


def near(a, b):
    least = min(len(a), len(b))
    return len({*a} & {*b}) / least if least else float(len(a) == len(b))


def by_hand(rows):
    docs = sorted(((i is not None, i or 0), hashlib.sha256((t or "").encode()).hexdigest(), i, t or "") for i, t in rows)
    out = []
    for at, (_, _, i, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][3]
        n = len(text)
        edited = text[: n - n // 4] + after[: n // 4]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        out.append((i, n, hashlib.sha256(edited.encode()).hexdigest(), "".join(a), "".join(b), near(a, b), near(a, c)))
    return sorted(out, key=repr)


def prose(seed, words):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeé𝔘") for _ in range(r.randint(1, 7))) for _ in range(words))


ROWS = [
    (1, prose(1, 200)), (2, prose(1, 200)), (3, None), (4, ""), (5, "one"), (6, "a b c d"), (7, " \t\n "), (9, prose(2, 40)), (9, prose(3, 40)), (9, prose(3, 40)),
    (9, prose(3, 40)), (None, "no id here but some words"), (None, None), (None, None), (-4, prose(4, 9)), (10**12, "same same same same same same same"), (12, prose(5, 60_000)),
    *((100 + k, prose(50 + k, 5 + k)) for k in range(120)),
]


def collected(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def test_against_plain_version(spark):
    assert collected(fp.edited_fingerprints(frame(spark, ROWS))) == by_hand(ROWS)


@pytest.mark.parametrize("rows", [[(1, "only one document of these many words")], [(1, None)], [(3, "a b"), (3, "a b")], []])
def test_few_documents(spark, rows):
    assert collected(fp.edited_fingerprints(frame(spark, rows))) == by_hand(rows)


def test_merged_sketch_is_that_of_all_shingles(spark):
    rows = frame(spark, ROWS).withColumn("g", F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)))
    got = {}
    for r in fp.merged(fp.with_sketch(rows, "text", "s"), ["g"], "s").collect():
        got.setdefault(r.g, []).append(r.hash)
    for g in range(3):
        own = [sketch(t or "") for i, t in ROWS if (i or 0) % 3 == g]
        low = sorted({h for s in own for h in s if h < "4" + "0" * 11})
        assert sorted(got[g]) == (low or [min(h for s in own for h in s)])


def test_union_drops_a_stand_in_once_a_hash_is_low(spark):
    out = spark.sql("select array('f00000000000') a, array('100000000000') b, array('e00000000000') c, array() d")
    r = out.select(fp.union_of("a", "b").alias("ab"), fp.union_of("a", "c").alias("ac"), fp.union_of(F.col("d").cast("array<string>"), F.col("a")).alias("da")).head()
    assert (r.ab, r.ac, r.da) == (["100000000000"], ["e00000000000"], ["f00000000000"])


def test_containment_of_a_short_text_in_a_long_one(spark):
    long = prose(9, 20_000)
    part = " ".join(long.split(" ")[7000:9000])
    rows = fp.with_sketch(spark.createDataFrame([(long, part + " " + prose(10, 2000))], "long string, short string"), "long", "a")
    rows = fp.with_sketch(rows, "short", "b")
    assert abs(rows.select(fp.containment("a", "b").alias("c")).head().c - 0.5) < 0.05


def test_fraction_one_keeps_every_shingle(spark):
    text = prose(11, 300)
    got = fp.with_sketch(spark.createDataFrame([(text,)], "t string"), "t", "s", words=3, fraction=1).head().s
    assert got == sketch(text, 3, "g") and len(got) > 250
    with pytest.raises(ValueError):
        fp.limit_of(0)


def test_no_python_in_the_plan(spark):
    plan = fp.edited_fingerprints(frame(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
