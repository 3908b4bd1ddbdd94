"""The quality classifier: its parts, held-out accuracy, and odd rows."""
import zlib

import numpy as np
import pytest

from sigspark.llm import quality

SCHEMA = "doc_id long, text string, score string, held_out int, quality int"


def test_describing_is_per_document_and_per_passage():
    texts = [b"", b"one two", b"a " * 1000, "é ñ ß".encode() * 50, b"x" * 1_300_000, b" \n"]
    together, per = quality.describe(texts)
    assert list(per) == [1, 1, 16, 2, 1, 1]  # passages go on across the windows of a long text
    alone = [quality.describe([t])[0] for t in texts]
    assert np.allclose(together, np.concatenate(alone))
    shares = together[:, : quality.N_FINE] ** 2
    assert np.allclose(shares.sum(axis=1), (shares.sum(axis=1) > 0))


def passages_by_hand(text):
    """Counts of every passage, byte by byte."""
    out, words, before, last = [], 0, 3, True
    for byte in text or b"":
        white = chr(byte) in "\t\n\x0b\x0c\r "
        begins = last and not white
        words += begins
        number = max(words - 1, 0) // 64
        while len(out) <= number:
            out.append(([0] * quality.N_FINE, [0] * 64, 0))
        fine, pairs, n = out[number]
        fine[quality.FINE[byte]] += 1
        pairs[8 * before + quality.COARSE[byte]] += 1
        out[number] = (fine, pairs, n + begins)
        before, last = quality.COARSE[byte], white
    return out or [([0] * quality.N_FINE, [0] * 64, 0)]


def features_by_hand(text):
    rows = []
    for fine, pairs, n in passages_by_hand(text):
        size = sum(fine)
        rows.append([(x / max(size, 1)) ** 0.5 for x in fine + pairs] + [np.log1p(size), np.log1p(n), size / max(n, 1)])
    return np.array(rows)


def score_by_hand(model, text):
    """The forward pass, one passage after the other."""
    encoded, gates = [], []
    for f in features_by_hand(text):
        x = (f - model["mean"]) / model["std"]
        h = np.array([np.tanh(sum(x[i] * model["W"][i, j] for i in range(len(x))) + model["b"][j]) for j in range(len(model["b"]))])
        t, g = np.tanh(h @ model["V"]), 1 / (1 + np.exp(-(h @ model["U"])))
        encoded.append(h)
        gates.append(sum(t[k] * g[k] * model["w"][k] for k in range(len(t))))
    top = max(gates)
    weights = [np.exp(e - top) for e in gates]
    bag = sum(w / sum(weights) * h for w, h in zip(weights, encoded))
    return 1 / (1 + np.exp(-(float(bag @ model["c"]) + float(model["d"]))))


def odd_texts():
    rng = np.random.default_rng(3)
    made = [bytes(rng.choice(list(b"abcXY09 .,\n\t\xc3\xa9<"), size=n).tolist()) for n in (1, 7, 60, 700, 5000)]
    return [None, b"", b" ", b"\n\n x", b"word " * 200, b"x" * 900, b" lead" * 64, b" lead" * 65, b"a b" * 400, *made]


@pytest.mark.parametrize("window", [1, 13, 64, 1000, 1 << 19])
def test_passages_do_not_depend_on_windows(monkeypatch, window):
    monkeypatch.setattr(quality, "WINDOW", window)
    texts = [t or b"" for t in odd_texts()]
    f, per = quality.describe(texts)
    want = [features_by_hand(t) for t in texts]
    assert list(per) == [len(w) for w in want]
    assert np.allclose(f, np.concatenate(want), atol=1e-5)


def test_scores_against_a_plain_forward_pass(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = quality.train(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    texts = dict(enumerate(odd_texts())) | {1000 + r.doc_id: r.text.encode() for r in docs.orderBy("doc_id").limit(20).collect()}
    rows = spark.createDataFrame([(i, None if t is None else t.decode("utf-8", "ignore"), "s", 5, 9) for i, t in texts.items()], SCHEMA)
    got = {r.doc_id: r for r in quality.scores(rows, model).collect()}
    for r in rows.collect():
        want = score_by_hand(model, (r.text or "").encode())
        assert got[r.doc_id].score == pytest.approx(want, abs=1e-5)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)


def test_gradients():
    rng = np.random.default_rng(0)
    per, y = np.array([3, 1, 4]), np.array([1.0, 0.0, 1.0])
    f = rng.normal(size=(8, quality.N_FEATURES))
    model = {
        "mean": np.zeros(quality.N_FEATURES), "std": np.ones(quality.N_FEATURES), "W": rng.normal(size=(quality.N_FEATURES, 5)) * 0.1, "b": rng.normal(size=5),
        "V": rng.normal(size=(5, 4)), "U": rng.normal(size=(5, 4)), "w": rng.normal(size=4), "c": rng.normal(size=5), "d": np.array(0.3),
    }

    def loss(m):
        p = quality.forward(m, f, per)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = quality.gradients(model, quality.forward(model, f, per), per, y, np.ones(3))
    for k in "WbVUwcd":
        flat = np.atleast_1d(model[k]).ravel()
        for i in rng.integers(0, flat.size, 4):
            up, down = (dict(model) for _ in range(2))
            for m, e in ((up, 1e-6), (down, -1e-6)):
                value = np.array(model[k], float).ravel().copy()
                value[i] += e
                m[k] = value.reshape(np.shape(model[k]))
            assert (loss(up) - loss(down)) / 2e-6 == pytest.approx(np.ravel(found[k])[i], abs=1e-6)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = quality.scores(docs, quality.train(docs, labels)).join(labels, "doc_id").filter("held_out").collect()
    good, bad = [r for r in got if r.quality == 1], [r for r in got if r.quality == 0]
    assert len(got) > 500
    assert np.mean([r.predicted for r in good]) > 0.99
    assert np.mean([r.predicted for r in bad]) < 0.1
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    order = np.argsort([r.score for r in got])
    y = np.array([r.quality for r in got])[order]
    ranks = np.arange(1, len(y) + 1)
    assert (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum())) > 0.98


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "fine words of prose"), (3, "fine words of prose"), (None, "no id"), (4, "x" * 300_000)]
    docs = spark.createDataFrame([(i, t, "s", 5, 9) for i, t in rows], SCHEMA)
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (None, 1, 0), (1, None, 0), (99, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    got = quality.scores(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    nothing = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.scores(docs, nothing).collect()} == {0.5}
    assert quality.scores(docs.limit(0), nothing).count() == 0
    kept = quality.accepted(docs, nothing)
    assert kept.dtypes == docs.dtypes and sorted(kept.collect(), key=str) == sorted(docs.collect(), key=str)
