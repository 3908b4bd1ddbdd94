"""SentencePiece encoding and decoding: batched Viterbi in numpy.

A text is normalised as the model says (a space before it, spaces as U+2581) and
cut into words: a run of U+2581 and what follows up to the next. No piece
crosses such a cut (checked when the model is loaded; otherwise a text is one word),
so the best segmentation of a text is that of its words. Words of equal
length advance together, one position at a time:

* hashes of all substrings of a length come from prefix sums of a polynomial
  hash, and are looked up in the sorted hashes of the pieces of that length
  (a hit is compared character by character);
* the best score of a position is the maximum over the lengths of the last
  piece, taken for all words at once, with the length as the back-pointer.

Ties go to the longer last piece. A character that no piece covers is
an unknown of one character, written as the byte pieces of its UTF-8 form if the
model has them. Long words advance in windows, so memory doesn't grow with length.

A unigram model's scores are those of its file. The files of BPE models hold merge
ranks instead of probabilities; their piece of rank r gets the score of
Zipf's law, -log(r + 1), in steps of 1/256, and white space pieces, which such
files leave without a rank, count as the last ranks. Nothing is trained.

Decoding puts the pieces' bytes together, so it returns the text, except that
U+2581 itself, which the format uses for the space, comes back as a space, and
unknown characters come back as U+2047 where a model has no byte pieces.

Defined cases: null and empty texts have no ids; text that isn't in any piece is
bytes or unknowns; repeated rows are encoded each; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sigspark.llm.common import map_texts

SPACE = "▁"
UNKNOWN_SURFACE = " ⁇ "
#: Words of a worker whose ids are remembered, twice at most; (word, position, length) cells advanced at once.
REMEMBERED = 100_000
CELLS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Model:
    """Pieces of a model file, as sorted arrays by length."""

    def __init__(self, file: bytes):
        import sentencepiece

        spm = sentencepiece.SentencePieceProcessor(model_proto=file)
        size = spm.vocab_size()
        self.unknown = spm.unk_id()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [-1] * 256
        pieces: list[tuple[str, int, float]] = []
        for i in range(size):
            piece = spm.id_to_piece(i)
            if spm.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif spm.is_control(i) or spm.is_unknown(i):
                self.bytes_of.append(UNKNOWN_SURFACE.encode() if spm.is_unknown(i) else b"")
            else:
                self.bytes_of.append(piece.replace(SPACE, " ").encode())
                if not spm.is_unused(i):
                    pieces.append((piece, i, spm.get_score(i)))
        self.has_bytes = min(self.byte_ids) >= 0
        scores = np.array([s for _, _, s in pieces])
        if len(pieces) and (scores == np.rint(scores)).all():  # merge ranks
            ranks = np.where(scores < -size, size + np.arange(len(pieces)), -scores)
            scores = np.rint(-np.log(ranks + 1) * 256) / 256
        self.unknown_score = float(scores.min() - 10) if len(pieces) else -10.0
        self.longest = max((len(p) for p, _, _ in pieces), default=1)
        self.cut = not any(SPACE in p.lstrip(SPACE) for p, _, _ in pieces)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({len(p) for p, _, _ in pieces}):
            own = [k for k, (p, _, _) in enumerate(pieces) if len(p) == n]
            codes = np.array([[ord(c) for c in pieces[k][0]] for k in own], np.uint64)
            keys = hash_of(codes)
            order = np.argsort(keys)
            if (np.diff(keys[order].astype(object)) == 0).any():
                raise ValueError("two pieces of one hash")
            self.tables[n] = (keys[order], codes[order], np.array([pieces[own[k]][1] for k in order]), scores[own][order])
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def words(self, text: str) -> list[str]:
        shown = SPACE + text.replace(" ", SPACE)
        return _WORD.findall(shown) if self.cut else [shown]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts as little-endian 32-bit values."""
        split = [self.words(t) if t else [] for t in texts]
        fresh = {w for words in split for w in words if w not in self.young}
        known = {w: self.old[w] for w in fresh if w in self.old}
        fresh.difference_update(known)
        known.update(self.segment(list(fresh)))
        if len(self.young) + len(known) > REMEMBERED:
            # the words of this batch must all be at hand: the older ones stay reachable as ``old``
            self.old, self.young = self.young, {}
            known.update({w: self.old[w] for words in split for w in words if w in self.old and w not in known})
        self.young.update(known)
        found = self.young.__getitem__
        out = [b"".join(map(found, words)) for words in split]
        if len(self.young) > 2 * REMEMBERED:
            self.young = {}
        return out

    def segment(self, words: list[str]) -> dict[str, bytes]:
        """Best segmentation of every word; words of a length together."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            by_length.setdefault(len(word), []).append(word)
        out: dict[str, bytes] = {}
        for length, own in by_length.items():
            many = max(1, CELLS // (length * (self.longest + 1)))
            for i in range(0, len(own), many):
                out.update(self.advance(own[i : i + many], length))
        return out

    def advance(self, words: list[str], length: int) -> dict[str, bytes]:
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), length).astype(np.uint64)
        n, every = len(words), np.arange(len(words))
        lengths = [k for k in sorted(self.tables, reverse=True) if k <= length]
        longest = max([1, *lengths])
        steps = np.array([*lengths, 1])  # the last row: a single character that is no piece
        back, piece = np.zeros((length + 1, n), np.uint16), np.full((length + 1, n), -1, np.int32)
        past = np.full((longest, n), -np.inf)  # best scores of the last positions
        past[-1] = 0.0
        window = max(64, CELLS // (n * (longest + 1)))
        for begin in range(0, length, window):
            end = min(length, begin + window)  # pieces that end in (begin, end]
            score = np.full((end - begin, len(steps), n), -np.inf)
            found = np.full((end - begin, len(steps), n), -1, np.int32)
            for r, k in enumerate(lengths):
                first = max(begin, k - 1)
                if first < end:
                    ids, values = self.probe(codes, k, first, end)
                    found[first - begin :, r], score[first - begin :, r] = ids.T, values.T
            lone = found[:, -2] < 0 if lengths and lengths[-1] == 1 else np.ones((end - begin, n), bool)
            score[:, -1] = np.where(lone, self.unknown_score, -np.inf)
            best = np.concatenate([past, np.empty((end - begin, n))])
            picks = np.empty((end - begin, n), np.int64)
            at = longest - steps
            for j in range(end - begin):
                total = best[at + j] + score[j]
                pick = picks[j] = total.argmax(axis=0)
                best[longest + j] = total[pick, every]
            past = best[-longest:]
            back[begin + 1 : end + 1] = steps[picks]
            piece[begin + 1 : end + 1] = np.take_along_axis(found, picks[:, None], axis=1)[:, 0]
        return self.trace(words, back, piece)

    def probe(self, codes: np.ndarray, k: int, first: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the pieces of length k that end at characters first .. end - 1; -1 and -inf if none."""
        keys, pieces, ids, scores = self.tables[k]
        width = end - first
        if width <= 0:
            return np.zeros((len(codes), 0), np.int32), np.zeros((len(codes), 0))
        part = codes[:, first - k + 1 : end]
        hashes = np.zeros((len(codes), width), np.uint64)
        for i in range(k):
            hashes = hashes * _BASE + part[:, i : i + width] + np.uint64(1)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        row, column = np.nonzero(keys[at] == hashes)
        hit = at[row, column]
        same = np.ones(len(hit), bool)
        for i in range(k):
            same &= pieces[hit, i] == part[row, column + i]
        row, column, hit = row[same], column[same], hit[same]
        found, score = np.full(hashes.shape, -1, np.int32), np.full(hashes.shape, -np.inf)
        found[row, column], score[row, column] = ids[hit], scores[hit]
        return found, score

    def trace(self, words: list[str], back: np.ndarray, piece: np.ndarray) -> dict[str, bytes]:
        """Follow the back-pointers of all words of a length together."""
        every = np.arange(len(words))
        at = np.full(len(words), len(back) - 1)
        taken, odd = [], np.zeros(len(words), bool)
        while at.any():
            ids = np.where(at > 0, piece[at, every], -2)
            odd |= ids == -1
            taken.append(ids)
            at = at - np.where(at > 0, back[at, every], 0)
        path = np.stack(taken[::-1], axis=1) if taken else np.zeros((len(words), 0), np.int32)
        held = path >= 0
        ends = np.cumsum(held.sum(axis=1)) * 4
        data = path[held].astype("<u4").tobytes()
        out = {w: data[b:e] for w, b, e in zip(words, [0, *ends[:-1].tolist()], ends.tolist(), strict=True)}
        for i in np.nonzero(odd)[0]:
            out[words[i]] = self.with_unknowns(words[i], back[:, i], piece[:, i])
        return out

    def with_unknowns(self, word: str, back: np.ndarray, piece: np.ndarray) -> bytes:
        ids: list[int] = []
        j = len(word)
        while j:
            if piece[j] >= 0:
                ids.append(int(piece[j]))
            elif self.has_bytes:
                ids.extend(self.byte_ids[b] for b in reversed(word[j - 1].encode("utf-8", "surrogatepass")))
            elif not ids or ids[-1] != self.unknown:  # neighbouring unknowns are one
                ids.append(self.unknown)
            j -= int(back[j])
        return struct.pack(f"<{len(ids)}I", *reversed(ids))

    def decode(self, ids: bytes) -> str:
        """The text of ids given as little-endian 32-bit values."""
        data = b"".join([self.bytes_of[i] for i in struct.unpack(f"<{len(ids) // 4}I", ids)])
        return data.decode("utf-8", "replace").removeprefix(" ")


def hash_of(codes: np.ndarray) -> np.ndarray:
    """Polynomial hash of the rows of a matrix of code points."""
    out = np.zeros(len(codes), np.uint64)
    for i in range(codes.shape[1]):
        out = out * _BASE + codes[:, i] + np.uint64(1)
    return out


_MODELS: dict[int, Model] = {}


def loaded(file: bytes) -> Model:
    key = zlib.crc32(file)
    if key not in _MODELS:
        _MODELS[key] = Model(file)
    return _MODELS[key]


def model_file(docs: DataFrame, path: str):
    """The model file's bytes, sent to the tasks once (about 0.5 MB)."""
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), step: int = 500) -> DataFrame:
    """The columns ``keep`` and ids (array<int>); ``step`` texts of a batch are encoded together."""
    file = model_file(docs, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, parts = loaded(file.value), []
        for at in range(0, batch.num_rows, step):
            parts += model.encode([t or "" for t in batch.column("text").slice(at, step).to_pylist()])
        ends = np.cumsum([0, *(len(p) // 4 for p in parts)]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), ids], [*keep, "ids"])

    rows = docs.select(*keep, "text")
    names = ", ".join(f"`{c}` {t}" for c, t in rows.select(*keep).dtypes)
    return map_texts(rows, run, f"{names}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of ``encoded`` and ``text``."""
    file = model_file(encoded, path)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model, lists = loaded(file.value), batch.column("ids")
        ends = np.asarray(lists.offsets)
        flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
        texts = [model.decode(flat[b:e].tobytes()) for b, e in zip(ends[:-1], ends[1:], strict=True)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "text"])

    names = ", ".join(f"`{c}` {t}" for c, t in encoded.dtypes)
    return map_texts(encoded, run, f"{names}, text string")


