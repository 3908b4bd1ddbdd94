"""Quality classifier: gated attention over the passages of a document.

A document is a bag of passages (PASSAGE words each, whole text). Each passage
is described by shares of byte classes and of pairs of coarse classes, then
encoded by a learned layer, h = tanh(W f). Gated attention
a = softmax(w . (tanh(V h) * sigmoid(U h))) weighs the passages of the bag, and the
weighted sum of their encodings is scored by a logistic unit. Only document labels
are used; which passages matter is learned.

The fit reads at most TRAIN_DOCS labelled rows whose crc32(doc_id as text) mod 5
is not 0, those with the least hash of doc_id (a documented bound), in one task,
and gives a few thousand weights. Scoring reads every row and whole text in
independent Arrow batches; label, lang, source and doc_id are no inputs.

Defined cases: null and empty texts are one passage of zeros and get a score; rows
without a label or doc_id don't train; of several labels of one document the
least counts; without labelled rows of both classes every score is the share of
label 1 among them (0.5 without any); repeated rows score alike; other columns
are ignored by ``scores`` and kept by ``accepted``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.llm.common import encoded, map_texts, small_batches

TRAIN_DOCS = 6000
PASSAGE = 64
THRESHOLD = 0.3
ENCODED, GATE = 32, 16
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.003, 1e-4
#: Bytes and documents described at a time; several arrays of eight bytes for each byte are held.
WINDOW, GROUP = 1 << 19, 256


def _classes() -> tuple[np.ndarray, np.ndarray, int]:
    """Class of each byte (every ASCII sign its own) and coarse class (8)."""
    fine, coarse = np.zeros(256, np.int64), np.zeros(256, np.int64)
    signs = [b for b in range(33, 127) if not chr(b).isalnum()]
    for b in range(256):
        c = chr(b)
        if c in "aeiou":
            fine[b], coarse[b] = 0, 0
        elif "a" <= c <= "z":
            fine[b], coarse[b] = 1, 0
        elif "A" <= c <= "Z":
            fine[b], coarse[b] = 2, 1
        elif "0" <= c <= "9":
            fine[b], coarse[b] = 3, 2
        elif c == " ":
            fine[b], coarse[b] = 4, 3
        elif c in "\n\r":
            fine[b], coarse[b] = 5, 4
        elif b in signs:
            fine[b], coarse[b] = 9 + signs.index(b), 5 if c in ".,;:'\"-()?" else 6
        elif b >= 0xC0:
            fine[b], coarse[b] = 6, 0
        elif b >= 0x80:
            fine[b], coarse[b] = 7, 0
        else:
            fine[b], coarse[b] = 8, 7
    return fine, coarse, 9 + len(signs)


FINE, COARSE, N_FINE = _classes()
WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
N_FEATURES = N_FINE + 64 + 3


def describe(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and the number of passages of each text.

    Texts of at most WINDOW bytes are described together, a longer one alone and window by window; passages go on across windows.
    """
    parts, counts, group, size = [], [], [], 0

    def flush() -> None:
        nonlocal group, size
        if group:
            f, n = _describe(group)
            parts.append(f)
            counts.extend(n)
        group, size = [], 0

    for text in texts:
        if len(text) > WINDOW:
            flush()
            parts.append(_describe_long(text))
            counts.append(len(parts[-1]))
            continue
        if size + len(text) > WINDOW:
            flush()
        group.append(text)
        size += len(text)
    flush()
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float32), np.array(counts, np.int64)


def _features(fine: np.ndarray, pairs: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Features of passages from their counts of byte classes, of pairs of coarse classes and of words."""
    length = fine.sum(axis=1)
    safe = np.maximum(length, 1)[:, None]
    more = np.stack([np.log1p(length), np.log1p(words), length / np.maximum(words, 1)], axis=1)
    return np.concatenate([np.sqrt(fine / safe), np.sqrt(pairs / safe), more], axis=1).astype(np.float32)


def _counts(data: np.ndarray, passage: np.ndarray, start: np.ndarray, previous: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts for ``total`` passages, from the passage, the word start and the coarse class before each byte."""
    fine = np.bincount(passage * N_FINE + FINE[data], minlength=total * N_FINE).reshape(total, N_FINE)
    pairs = np.bincount(passage * 64 + previous * 8 + COARSE[data], minlength=total * 64).reshape(total, 64)
    return fine, pairs, np.bincount(passage, weights=start, minlength=total)


def _describe(texts: list[bytes]) -> tuple[np.ndarray, list[int]]:
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    begins = np.cumsum(sizes) - sizes
    held = sizes > 0
    white = WHITE[data]
    start = ~white
    start[1:] &= white[:-1]
    start[begins[held]] = ~white[begins[held]]
    words = np.cumsum(start)
    before = np.zeros(len(texts), np.int64)
    before[held] = words[begins[held]] - start[begins[held]]
    passage = np.maximum(words - np.repeat(before, sizes) - 1, 0) // PASSAGE
    number = np.ones(len(texts), np.int64)
    number[held] = passage[np.cumsum(sizes)[held] - 1] + 1
    passage += np.repeat(np.cumsum(number) - number, sizes)
    coarse = COARSE[data]
    previous = np.empty_like(coarse)
    previous[1:] = coarse[:-1]
    previous[begins[held]] = 3  # a text starts as after a space, whatever text stands before it
    return _features(*_counts(data, passage, start, previous, int(number.sum()))), number.tolist()


def _describe_long(text: bytes) -> np.ndarray:
    """Features of one text's passages; the last passage of a window, the words so far and the byte before go on to the next window."""
    done, open_, first, words, white, last = [], None, 0, 0, True, 3
    for at in range(0, len(text), WINDOW):
        data = np.frombuffer(text, np.uint8, min(WINDOW, len(text) - at), at)
        blank, coarse = WHITE[data], COARSE[data]
        start = ~blank & np.append(white, blank[:-1])
        passage = np.maximum(words + np.cumsum(start) - 1, 0) // PASSAGE
        number = int(passage[-1]) - first + 1
        counts = _counts(data, passage - first, start, np.append(last, coarse[:-1]), number)
        if open_ is not None:
            for new, old in zip(counts, open_, strict=True):
                new[0] += old[0]
        done.append(_features(*(c[:-1] for c in counts)))
        open_, first = tuple(c[-1:] for c in counts), int(passage[-1])
        words, white, last = words + int(start.sum()), bool(blank[-1]), int(coarse[-1])
    return np.concatenate([*done, _features(*open_)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(model: dict, f: np.ndarray, per: np.ndarray) -> dict:
    """All layers for bags of ``per`` passages each (at least one)."""
    begins = np.cumsum(per) - per
    x = (f - model["mean"]) / model["std"]
    h = np.tanh(x @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"]), _sigmoid(h @ model["U"])
    e = (t * g) @ model["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, begins), per))
    a = e / np.repeat(np.add.reduceat(e, begins), per)
    z = np.add.reduceat(a[:, None] * h, begins)
    return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ model["c"] + model["d"]), "begins": begins}


def gradients(model: dict, out: dict, per: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Of the weighted mean logistic loss."""
    dlogit = (out["p"] - y) * weight / weight.sum()
    dz = np.outer(dlogit, model["c"])
    dzp = np.repeat(dz, per, axis=0)
    da = (dzp * out["h"]).sum(axis=1)
    de = out["a"] * (da - np.repeat(np.add.reduceat(out["a"] * da, out["begins"]), per))
    du = de[:, None] * model["w"]
    dt, dg = du * out["g"] * (1 - out["t"] ** 2), du * out["t"] * out["g"] * (1 - out["g"])
    dh = dzp * out["a"][:, None] + dt @ model["V"].T + dg @ model["U"].T
    dx = dh * (1 - out["h"] ** 2)
    return {
        "W": out["x"].T @ dx, "b": dx.sum(axis=0), "V": out["h"].T @ dt, "U": out["h"].T @ dg,
        "w": (out["t"] * out["g"]).T @ de, "c": out["z"].T @ dlogit, "d": np.array(dlogit.sum()),
    }


def fit(f: np.ndarray, per: np.ndarray, y: np.ndarray, seed: int = 7) -> dict:
    """Weights by Adam on shuffled batches of bags."""
    if not len(y) or y.min() == y.max():
        return {"constant": float(y.mean()) if len(y) else 0.5}
    rng = np.random.default_rng(seed)
    scale = lambda *s: rng.normal(0, 1 / np.sqrt(s[0]), s)
    model = {
        "mean": f.mean(axis=0), "std": np.maximum(f.std(axis=0), 1e-3), "W": scale(N_FEATURES, ENCODED), "b": np.zeros(ENCODED),
        "V": scale(ENCODED, GATE), "U": scale(ENCODED, GATE), "w": scale(GATE), "c": scale(ENCODED), "d": np.zeros(()),
    }
    names = ["W", "b", "V", "U", "w", "c", "d"]
    first, second, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    begins = np.cumsum(per) - per
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            bags = order[i : i + BATCH]
            rows = np.concatenate([np.arange(begins[b], begins[b] + per[b]) for b in bags])
            out = forward(model, f[rows], per[bags])
            grads = gradients(model, out, per[bags], y[bags], np.ones(len(bags)))
            step += 1
            for k in names:
                g = grads[k] + DECAY * model[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                model[k] = model[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def score(model: dict, texts: list[bytes]) -> np.ndarray:
    if "constant" in model or not texts:
        return np.full(len(texts), model.get("constant", 0.5))
    f, per = describe(texts)
    return forward(model, f, per)["p"]


def batch_scores(model: dict, batch: pa.RecordBatch) -> np.ndarray:
    """Scores of a batch's texts, GROUP documents at a time."""
    parts = [score(model, list(encoded(batch.slice(i, GROUP), "text"))) for i in range(0, batch.num_rows, GROUP)]
    return np.concatenate(parts) if parts else np.zeros(0)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> dict:
    """The model from the labelled rows that aren't held out, at most ``train_docs`` of them."""
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("__y"))
    chosen = marked.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    chosen = chosen.select(F.col("doc_id").alias("__id"), "__y")
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("doc_id", "__y", "text")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for i in range(0, batch.num_rows, GROUP):
            f, per = describe(list(encoded(batch.slice(i, GROUP), "text")))
            found += [f[e - n : e].tobytes() for e, n in zip(np.cumsum(per), per, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("__y").cast(pa.int32()), pa.array(found, pa.binary())], ["doc_id", "y", "features"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(i, y, f) for b in batches for i, y, f in zip(b.column("doc_id").to_pylist(), b.column("y").to_pylist(), b.column("features").to_pylist(), strict=True)]
        found.sort()
        bags = [np.frombuffer(f, np.float32).reshape(-1, N_FEATURES) for _, _, f in found]
        y = np.array([float(v > 0) for _, v, _ in found])
        model = fit(np.concatenate(bags) if bags else np.zeros((0, N_FEATURES)), np.array([len(b) for b in bags], np.int64), y)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    described = map_texts(rows, features, "doc_id long, y int, features binary")
    return pickle.loads(described.repartition(1).mapInArrow(learn, "model binary").head()["model"])


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted; a row per document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(batch_scores(model, batch), pa.float64())], ["doc_id", "score"])

    out = map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The documents predicted to be good, with all their columns."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(batch_scores(model, batch) >= THRESHOLD))

    return small_batches(docs).mapInArrow(lambda batches: (run(b) for b in batches if b.num_rows), docs.schema)
