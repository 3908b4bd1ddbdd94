"""Pieces against the tokenizer library, packing against its rules."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sigspark.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, length string, piece string, `offset` int"


@pytest.fixture(scope="module")
def own():
    return Tokenizer.from_file(PATH)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], SCHEMA)


ODD = [
    None, "", " ", "  a", " a b", "a  b", "a \n b", "a\tb c", "a b  c d", "x  y z\n", "'s it's don't  we'll", "<|endoftext|> a <|endoftext|>", "é ñ 日本 \U0001d518 x",
    "a b ", "a\r\n b c", "a b c  d", "one two three", "word " * 5000, "a<|endoftext|>b", "x <|endoftext|>\n<|endoftext|> y z " * 500, "<|endoftext|", "<|endoftext|>", "w" * 20_000, " \x1c x", "a\x0bb c", "1 22 333,4 5.5",
]


def pieces_by_hand(rows, own):
    out = []
    for i, t in rows:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        head = len(ids) % 2048 or 2048
        starts = [0] if len(ids) <= 2048 else [0, *range(head, len(ids), 2048)]
        ends = [*starts[1:], len(ids)]
        out += [(i, k, s, e - s, zlib.crc32(np.array(ids[s:e], "<u4").tobytes())) for k, (s, e) in enumerate(zip(starts, ends))]
    return sorted(out)


def check_places(rows):
    """Gapless from 0 and within capacity; returns the number of sequences."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by)


def test_pieces_and_places(spark, own):
    rows = list(enumerate(ODD)) + [(900, "same"), (900, "same")]
    got = packing.pack(frame(spark, rows), PATH).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_by_hand(rows, own)
    check_places(got)
    assert packing.pack(frame(spark, []), PATH).count() == 0


def test_whole_table_packs_tightly(spark, own):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, PATH).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == pieces_by_hand([(d.doc_id, d.text) for d in docs.collect()], own)
    assert check_places(got) <= 1.02 * -(-sum(r.length for r in got) // 2048)


def test_parts_pack_alone_and_alike(spark):
    rnd = random.Random(2)
    rows = spark.createDataFrame([(i, 0, rnd.randint(1, 2048), 7) for i in range(4000)], "doc_id long, piece int, length long, ids_crc32 long")
    one = packing.packed(rows, part=1000).collect()
    two = packing.packed(rows.repartition(5), part=1000).collect()
    check_places(one)
    assert sorted(one) == sorted(two)


def test_special_strings_after_the_first_chunks(own):
    """Once the library's memory is given back, a special string brings it back."""
    encode = packing.Encoder(open(PATH, "rb").read())
    for k in range(1100):
        encode.encode(f"word{k}")
    assert encode.own is None and encode.agree
    text = "a<|endoftext|>b word7"
    assert encode.encode(text) == packing.packed_ids(own.encode(text, add_special_tokens=False).ids)
    assert packing.packed_ids([64, 50256, 65]) == encode.encode("a<|endoftext|>b")


def test_bins_follow_best_fit(spark):
    """Every placement is the fullest bin that fits; the fullest closes when a new one needs room."""
    rnd = random.Random(1)
    bins, free, most = packing.Bins(100, 5), {}, 5
    for _ in range(3000):
        n = rnd.randint(1, 100)
        fits = [f for f in free.values() if f >= n]
        number, offset = bins.place(n)
        if fits:
            assert free[number] == min(fits) and offset == 100 - min(fits)
        else:
            assert number not in free and offset == 0
            if len(free) >= most:
                fullest = min(free.values())
                gone = [b for b in free if free[b] == fullest and b not in [x for v in bins.by_free.values() for x in v]]
                assert len(gone) == 1
                del free[gone[0]]
            free[number] = 100
        free[number] -= n
        if not free[number]:
            del free[number]
        assert sorted(x for v in bins.by_free.values() for x in v) == sorted(free) and bins.open == len(free) <= most
        assert bins.free == sum(1 << f for f in set(free.values()))
