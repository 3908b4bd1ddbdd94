"""SentencePiece, language-model scores and nearest neighbours against plain versions."""
import math
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from sigspark.llm import lm_score, neighbours
from sigspark.llm import sentencepiece_codec as codec

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "   a  b", "Hello world", "naïve café", "日本 \U0001d518", "\t x\n\ny ", "x" * 3000, "a" * 17, "ab" * 40, "€ 12,345.67", "two words", "end ",
]


@pytest.fixture(scope="module")
def model():
    with open(PIECES, "rb") as f:
        return codec.Model(f.read())


def plain_viterbi(model, text):
    """One character after the other over the whole text, with Python objects only."""
    pieces = {}
    for keys, codes, ids, scores in model.tables.values():
        pieces.update({"".join(map(chr, c)): (int(i), float(s)) for c, i, s in zip(codes.tolist(), ids, scores)})
    shown = codec.SPACE + text.replace(" ", codec.SPACE)
    best = [(0.0, 0, -1)] + [None] * len(shown)
    for j in range(1, len(shown) + 1):
        for k in range(min(j, model.longest), 0, -1):
            i, s = pieces.get(shown[j - k : j], (-1, model.unknown_score if k == 1 else None))
            if s is not None and (best[j] is None or best[j - k][0] + s > best[j][0]):
                best[j] = (best[j - k][0] + s, k, i)
    out, j = [], len(shown)
    while j:
        _, k, i = best[j]
        out += [i] if i >= 0 else [model.byte_ids[b] for b in reversed(shown[j - 1].encode())]
        j -= k
    return out[::-1]


def ids_of(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


def test_encoding_is_the_best_segmentation(spark, model):
    docs = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect()]
    texts = [t for t in TEXTS if t] + docs
    for text, data in zip(texts, model.encode(texts)):
        assert ids_of(data) == plain_viterbi(model, text)
        assert model.decode(data) == text


def test_encoding_agrees_with_the_library_on_the_same_scores(model):
    """The library as a unigram model over the same pieces and scores (its sums are 32-bit, exact on short texts)."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    for _, _, ids, scores in model.tables.values():
        for i, s in zip(ids.tolist(), scores.tolist()):
            proto.pieces[i].score = s
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = [t for t in TEXTS if t]
    assert [ids_of(d) for d in model.encode(texts)] == library.encode(texts)


def test_windows_and_forgetting_change_nothing(model, monkeypatch):
    words = ["thereou" * 40, "x" * 500, "résumé" * 30, "a b c d e f g"]
    want = model.encode(words)
    with open(PIECES, "rb") as f:
        small = codec.Model(f.read())
    monkeypatch.setattr(codec, "CELLS", 64)
    monkeypatch.setattr(codec, "REMEMBERED", 2)
    assert [small.encode([w])[0] for w in words] == want == small.encode(words)


def test_codec_on_rows(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(1, "twice", "x", 1), (1, "twice", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n int")
    got = codec.decode(codec.encode(docs, PIECES), PIECES).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted((i, t or "") for i, t, _, _ in rows)
    assert codec.decode(codec.encode(docs.limit(0), PIECES), PIECES).count() == 0


def lm_by_hand(rows, targets):
    """The same models with dictionaries of slots."""
    texts = {i: lm_score.tokens((t or "").encode()) for i, t in rows}
    models = []
    size = [sum(len(w) for w, _ in texts.values()), sum(len(texts[i][0]) for i in targets)]
    for ids, scale in ((list(texts), size[1] / size[0]), (targets, 1.0)):
        words, pairs = Counter(), Counter()
        for i in ids:
            words.update(texts[i][0].tolist())
            pairs.update(texts[i][1].tolist())
        models.append(({k: v * scale for k, v in words.items()}, {k: v * scale for k, v in pairs.items()}, size[1]))
    out = {}
    for i, (w, p) in texts.items():
        losses = []
        for words, pairs, total in models:
            own = []
            for k, word in enumerate(w.tolist()):
                q = (words.get(word, 0) + 1) / (total + lm_score.WORD_SLOTS)
                if k:
                    c = words.get(int(w[k - 1]), 0)
                    q = (min(pairs.get(int(p[k - 1]), 0), c) + lm_score.PRIOR * q) / (c + lm_score.PRIOR)
                own.append(-math.log(q))
            losses.append(sum(own) / len(own) if own else None)
        out[i] = (len(w), losses[1], losses[0])
    return out


def test_lm_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").filter("quality = 1")
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "One"), (-4, "w " * 40_000)], "doc_id long, text string")
    rows = docs.select("doc_id", "text").union(extra).withColumn("target", F.lit("x")).repartition(5)
    got = lm_score.cross_entropy_difference(rows, good).collect()
    want = lm_by_hand([(r.doc_id, r.text) for r in rows.collect()], [r.doc_id for r in good.collect()])
    assert len(got) == len(want)
    for r in got:
        n, target, background = want[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert r.target_loss == pytest.approx(target, rel=1e-5, abs=1e-5) and r.background_loss == pytest.approx(background, rel=1e-5, abs=1e-5)
            assert r.score == pytest.approx(target - background, abs=1e-4)
        else:
            assert r.score is None


def test_lm_scores_are_those_of_exact_counts(spark):
    """Dictionaries of words and pairs themselves, without hashes; small blocks and many ranges of keys."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(3)
    good = {r.doc_id for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").filter("quality = 1").collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    assert len(texts) == docs.count()
    models = []
    size = [sum(map(len, texts.values())), sum(len(t) for i, t in texts.items() if i in good)]
    for scale, chosen in ((size[1] / size[0], texts), (1.0, good & texts.keys())):
        words, pairs = Counter(), Counter()
        for i in chosen:
            words.update(texts[i])
            pairs.update(zip(texts[i], texts[i][1:]))
        models.append((words, pairs, scale))
    assert len(models[0][1]) > 100_000
    ids = spark.createDataFrame([(i,) for i in good], "doc_id long")
    got = lm_score.cross_entropy_difference(docs, ids, 20_000, 100_000).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    for r in got:
        own, mean = texts[r.doc_id], []
        for words, pairs, scale in models:
            total = 0.0
            for k, word in enumerate(own):
                q = (words[word] * scale + 1) / (size[1] + lm_score.WORD_SLOTS)
                if k:
                    c = words[own[k - 1]] * scale
                    q = (pairs[own[k - 1], word] * scale + lm_score.PRIOR * q) / (c + lm_score.PRIOR)
                total -= math.log(q)
            mean.append(total / len(own) if own else None)
        assert r.n_tokens == len(own)
        if own:
            assert (r.background_loss, r.target_loss) == pytest.approx(mean, abs=1e-9) and r.score == pytest.approx(mean[1] - mean[0], abs=1e-9)


def test_lm_scores_of_texts_without_words(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    got = lm_score.cross_entropy_difference(docs, docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.score) for r in got) == [(0, 0, None), (1, 0, None), (2, 0, None)]


def test_lm_scores_tell_domains_apart(spark):
    rng = np.random.default_rng(1)
    vocab = {k: [f"{k}{i}" for i in range(50)] for k in "ab"}
    rows = [(i, " ".join(rng.choice(vocab["ab"[i % 2]], 60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_score.cross_entropy_difference(docs, docs.filter("doc_id % 2 = 0 AND doc_id < 100")).collect()
    assert max(r.score for r in got if r.doc_id % 2 == 0) < min(r.score for r in got if r.doc_id % 2)
    none = lm_score.cross_entropy_difference(docs, docs.limit(0)).collect()
    assert len(none) == 200 and all(r.target_loss > r.background_loss - 20 for r in none)
    assert lm_score.cross_entropy_difference(docs.limit(0), docs.limit(0)).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, node string, ids int, code string"


def vector_rows(spark, items):
    return spark.createDataFrame([(i, v, 0, "n", 1, "c") for i, v in items], VECTORS)


def nearest_by_hand(items, ids, k=5):
    usable = {}
    for i, v in items:
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 16:
            usable[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in ids:
        if q in usable:
            scores = [(-float(usable[q] @ v / (np.linalg.norm(usable[q]) * np.linalg.norm(v))), i) for i, v in usable.items() if i != q]
            out[q] = sorted((round(s, 9), i) for s, i in scores)[:k]
    return out


def test_neighbours_of_copies_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(8)
    items = [(i, rng.normal(size=16).astype(float).tolist()) for i in range(400)]
    items += [(400 + i, items[3][1]) for i in range(200)]  # copies
    items += [(700, None), (750, [0.0] * 16), (800, [float("nan")] * 16), (850, [float("inf")] + [1.0] * 15), (900, [None] + [1.0] * 15), (950, [1.0, 2.0]), (1000, [])]
    got = neighbours.nearest(vector_rows(spark, items), vector_rows(spark, items).filter("vec_id % 50 = 0")).collect()
    want = nearest_by_hand(items, [i for i, _ in items if i % 50 == 0])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert found.keys() == want.keys()
    hits = 0
    for q, rows in found.items():
        rows.sort()
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        assert [(round(-s, 9), i) for _, s, i in rows] == sorted((round(-s, 9), i) for _, s, i in rows)
        hits += len({i for _, _, i in rows} & {i for _, i in want[q]})
    assert hits >= 0.98 * 5 * len(want)
    assert [i for _, _, i in found[400]] == [3, 401, 402, 403, 404]


def test_neighbours_of_few_rows_and_of_none(spark):
    items = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (7, [1.0, 1.0])]
    got = neighbours.nearest(vector_rows(spark, items), vector_rows(spark, items).filter("vec_id % 50 = 0")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert got[0].score == pytest.approx(math.sqrt(0.5), abs=1e-12)
    assert neighbours.nearest(vector_rows(spark, []), vector_rows(spark, [])).count() == 0


def test_neighbour_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    local = [(r.vec_id, r.embedding) for r in rows.select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in local]), np.array([v for _, v in local], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = {}
    for r in neighbours.nearest(rows, rows.filter("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in np.nonzero(ids % 50 == 0)[0]:
        near = x @ x[q]
        near[q] = -2
        hits += len(found[int(ids[q])] & set(ids[np.argsort(-near)[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(found)


def test_beams_grow_until_the_recall_is_reached(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    local = [(r.vec_id, r.embedding) for r in rows.select("vec_id", "embedding").collect()]
    ids, x = np.array([i for i, _ in local]), np.array([v for _, v in local], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    found = {}
    for r in neighbours.nearest(rows, rows.filter("vec_id % 50 = 0"), beam=6).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in np.nonzero(ids % 50 == 0)[0]:
        near = x @ x[q]
        near[q] = -2
        hits += len(found[int(ids[q])] & set(ids[np.argsort(-near)[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(found)


def test_neighbours_within_tight_clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(2, 16))
    x = np.concatenate([centres[0] + 0.001 * rng.normal(size=(900, 16)), centres[1] + 0.01 * rng.normal(size=(500, 16)), rng.normal(size=(200, 16))])
    items = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32).astype(float))]
    rows = vector_rows(spark, items)
    want = nearest_by_hand(items, range(0, len(items), 50))
    hits = 0
    for r in neighbours.nearest(rows, rows.filter("vec_id % 50 = 0")).collect():
        hits += r.vec_id in {i for _, i in want[r.query_id]}
    assert hits >= 0.95 * 5 * len(want)
