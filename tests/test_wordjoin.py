"""Substring joins against plain tests, and label rules with lists as tables."""

import random

import pytest
from pyspark.sql import functions as F

from sigspark.operators import catalog, wordjoin


def texts_of(spark, texts):
    return spark.createDataFrame([(f"t{i}", t) for i, t in enumerate(texts)], "id string, text string")


def words_of(spark, words):
    return spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, place long")


def brute(texts, words):
    found, known = set(), {w for w in words if w}
    longest = max(map(len, known), default=0)
    for i, t in enumerate(texts):
        for a in range(len(t or "")):
            for b in range(a + 1, min(len(t), a + longest) + 1):
                if t[a:b] in known:
                    found.add((f"t{i}", t[a:b]))
    return found


def matches(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_hundred_thousand_words(spark):
    r = random.Random(1)
    make = lambda n: "".join(r.choice("abcdeé/𝔘 ") for _ in range(n))
    words = set()
    while len(words) < 100_000:
        words.add(make(r.randint(1, 9)))
    words = sorted(words)
    texts = [make(r.randint(0, 60)) for _ in range(300)]
    assert matches(wordjoin.substring_matches(texts_of(spark, texts), words_of(spark, words), "id")) == brute(texts, words)


@pytest.mark.parametrize(
    "texts,words",
    [
        ([None, "", "a", "abab", "a.b", "a|b\nc(d"], ["a", "ab", "bab", "abab", "ababa", ".", "|", "b\nc(", "", None, "a", "a"]),
        (["x" * 5000, "xxxx" + "y" * 10], ["x" * 4, "x" * 4999, "xy", "yx"]),
        (["abc"], []), ([], ["abc"]), (["abc"], [None, ""]),
    ],
)
def test_odd_texts_and_words(spark, texts, words):
    assert matches(wordjoin.substring_matches(texts_of(spark, texts), words_of(spark, words), "id")) == brute(texts, [w for w in words if w])


def test_words_are_cut_out_in_list_order(spark):
    lists = ["ab", "cd", "xyz", "b"]
    texts = ["acdb", "cabd", "cacdbd", "xyxyzz", "abcdxyzb", "none", "aabb"]
    got = {r.id: (r.text, r.cut > 0) for r in wordjoin.without_words(texts_of(spark, texts), words_of(spark, lists), "id").collect()}
    for i, text in enumerate(texts):
        want = text
        for w in lists:
            want = want.replace(w, "")
        assert got[f"t{i}"] == (want, want != text)


def test_label_rules_with_tables(spark):
    r = random.Random(2)
    classes, black, ignore = ["kick", "snare", "hat", "tom", "at"], ["roll", "stomp"], ["that", "h", "hha", "tomato"]
    pieces = [*classes, *black, *ignore, "t", "s/", "Kick", "ato", "_"]
    paths = [("p%d" % i, "".join(r.choice(pieces) for _ in range(r.randint(1, 5)))) for i in range(400)] + [("none", None)]
    df = spark.createDataFrame(paths, "id string, path string")
    label, reason = catalog.label_rules("path", tuple(classes), tuple(black), tuple(ignore))
    want = matches(df.select("id", "path", label.alias("label"), reason.alias("reason")))
    tables = [words_of(spark, words) for words in (classes, black, ignore)]
    got = wordjoin.long_label_rules(df, "id", *tables)
    assert got.columns == ["id", "path", "label", "reason"] and matches(got) == want
    assert {r for *_, r in want} == {None, "unlabelled", "blacklisted", "ignored"}


def test_no_list_on_the_driver(spark):
    """Words stay rows: the plan has joins on parts and no literal of the list."""
    words = spark.range(50_000).select(F.concat(F.lit("word"), F.col("id").cast("string")).alias("word"))
    plan = wordjoin.substring_matches(texts_of(spark, ["a word123 b"]), words, "id")._jdf.queryExecution().toString()
    assert "word4999" not in plan and "Join" in plan


def test_texts_are_not_broadcast(spark):
    """A table with a row per text looks small to the optimiser, but the driver must not hold it."""
    paths = spark.range(200).select("id", F.concat(F.lit("large ring"), F.col("id").cast("string")).alias("path"))
    lists = [words_of(spark, words) for words in (["ring", "bolt"], ["g1"], ["large"])]
    for df in (wordjoin.substring_matches(paths, lists[0], "id", "path"), wordjoin.long_label_rules(paths, "id", *lists)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [id" in plan and "BroadcastHashJoin [id" not in plan
