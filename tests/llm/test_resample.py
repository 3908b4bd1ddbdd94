"""Importance resampling: the CRC against zlib's, and the whole against a plain version."""
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from sigspark.llm import resample

SCHEMA = "doc_id long, text string, score int, rank string, __block int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def features_of(text):
    ws = words_of(text)
    return [zlib.crc32(f.encode()) % 10000 for f in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]


def by_hand(docs, target):
    s, t = [0] * 10000, [0] * 10000
    for counts, rows in ((s, docs), (t, target)):
        for _, text in rows:
            for b in features_of(text):
                counts[b] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)]
    rows = []
    for i, text in docs:
        found = features_of(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(words_of(text)), len(found), weight, score))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = [(*r, k + 1) for k, r in enumerate(able[: 25 * len(able) // 100])]
    rest = [(*r, None) for r in able[len(drawn) :]] + [(*r, None) for r in rows if r[1] < 20]
    return sorted(drawn + rest, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=repr)


def made(seed, n, letters="abAZ9é𝔘 ,.\n-"):
    r = random.Random(seed)
    return [(k, "".join(r.choice(letters) for _ in range(r.choice([0, 3, 60, 200])))) for k in range(n)]


DOCS = [
    *made(1, 300), (None, None), (None, "null id " * 30), (1000, ""), (1001, "x" * 5000), (1002, "word " * 40), (1002, "word " * 40), (1003, "A\x00B a`b {c}"),
    (-9, "Negative id " * 20), (1004, ("long " + "y" * 130 + " ") * 20_000), (1005, "É" * 300 + " é" * 30),
]
TARGET = [*made(2, 40), (7, None), (8, "word word y")]


def test_against_plain_version(spark):
    assert collected(resample.resampled(frame(spark, DOCS), frame(spark, TARGET))) == by_hand(DOCS, TARGET)


@pytest.mark.parametrize("docs,target", [([], TARGET), (DOCS[:60], []), ([(1, "one two")], []), ([], [])])
def test_few_rows(spark, docs, target):
    assert collected(resample.resampled(frame(spark, docs), frame(spark, target))) == by_hand(docs, target)


def test_span_crcs():
    r = random.Random(3)
    data = np.frombuffer(r.randbytes(300_000), np.uint8)
    starts, ends, at = [], [], 3
    while at < 190_000:
        size = r.choice([1, 2, 5, 63, 64, 65, 127, 128, 129, 500, 5000])
        starts.append(at)
        ends.append(at + size)
        at += size + r.choice([0, 0, 1, 3])
    got = resample.span_crcs(data, np.array(starts), np.array(ends))
    assert got.tolist() == [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends)]


@pytest.mark.parametrize("piece", [1, 7, 50])
def test_parts_do_not_change_features(piece, monkeypatch):
    monkeypatch.setattr(resample, "PIECE", piece)
    r = random.Random(piece)
    for _ in range(40):
        texts = ["".join(r.choice("abZ9é𝔘 ,.\n\0") for _ in range(r.choice([0, 1, 2, 5, 40, 300]))) for _ in range(r.randint(0, 9))]
        raw = [t.encode() for t in texts]
        offsets = np.cumsum([0] + [len(x) for x in raw])
        words, found = [0] * len(texts), [[] for _ in texts]
        for first, buckets, rows, count in resample.features(offsets, resample.LOWER[np.frombuffer(b"".join(raw), np.uint8)], 10000):
            for k, c in enumerate(count.tolist()):
                words[first + k] += c
            for b, k in zip(buckets.tolist(), rows.tolist()):
                found[first + k].append(b)
        assert words == [len(words_of(t)) for t in texts]
        assert [sorted(f) for f in found] == [sorted(features_of(t)) for t in texts]


def test_documents_like_the_target_are_drawn(spark):
    r = random.Random(5)
    say = lambda names: " ".join(r.choice(names) for _ in range(80))
    near, far = ["tensor", "gradient", "loss", "layer"], ["garden", "flower", "seed", "soil"]
    docs = [(k, say(near if k % 4 == 0 else far)) for k in range(400)]
    drawn = resample.resampled(frame(spark, docs), frame(spark, [(k, say(near)) for k in range(50)])).filter("rank IS NOT NULL").collect()
    assert len(drawn) == 100 and sum(r.doc_id % 4 == 0 for r in drawn) >= 95
