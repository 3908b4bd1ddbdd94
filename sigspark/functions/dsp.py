"""Numpy helpers for one clip, called on Arrow batches: byte decoding and Fourier transforms.

Everything that can be a Spark expression is one; only these steps are not.
"""

from __future__ import annotations

import io
import math
from functools import lru_cache

import numpy as np

from sigspark.functions import wav
from sigspark.functions.arrays import mel_weights

TINY = 1e-10
BLOCK_FRAMES = 4096
BLOCK_TARGETS = 65_536
#: Zero crossings of the resampling filter on each side.
ZEROS = 16


def decode_wav(content: bytes) -> tuple[int, np.ndarray]:
    """Sample rate and mono samples of wav bytes, PCM or float; raises when unreadable."""
    head = wav.read_header(io.BytesIO(content), len(content))
    if head.n_samples == 0:
        raise ValueError("no samples")
    return head.rate, wav.to_mono(content[head.data_start : head.data_start + head.n_samples * head.step], head)


@lru_cache
def sinc_phases(up: int, down: int, zeros: int = ZEROS) -> np.ndarray:
    """Low-pass weights for a change of rate by up / down, a row per phase (Hann-windowed sinc of ``zeros`` zero crossings a side).

    A target lies at source position base + phase / up; its weights belong to the sources base - reach + 1 ... base + reach, where
    a row has 2 * reach of them. The pass band ends at the lower of the two Nyquist frequencies; every row sums to one.
    """
    cutoff = min(1.0, up / down)
    reach = int(np.ceil(zeros / cutoff))
    t = np.arange(1 - reach, reach + 1)[None, :] - np.arange(up)[:, None] / up
    window = np.where(np.abs(t) < zeros / cutoff, 0.5 + 0.5 * np.cos(np.pi * t * cutoff / zeros), 0)
    weights = np.sinc(cutoff * t) * window
    return weights / weights.sum(1, keepdims=True)


def rate_ratio(rate: int, wanted: int) -> tuple[int, int]:
    common = math.gcd(rate, wanted)
    return wanted // common, rate // common


def resample(x: np.ndarray, rate: int, wanted: int) -> np.ndarray:
    """Band-limited change of the sample rate; silence is assumed before and after. Works off BLOCK_TARGETS targets at a time."""
    if rate == wanted:
        return x
    up, down = rate_ratio(rate, wanted)
    weights = sinc_phases(up, down)
    reach = weights.shape[1] // 2
    near = np.lib.stride_tricks.sliding_window_view(np.pad(x, (reach - 1, reach)), 2 * reach)
    n = -(-len(x) * up // down)
    out = np.empty(n, "float32")
    for at in range(0, n, BLOCK_TARGETS):
        place = np.arange(at, min(at + BLOCK_TARGETS, n)) * down
        out[at : at + len(place)] = np.einsum("ij,ij->i", near[place // up], weights[place % up])
    return out


@lru_cache
def window(n: int) -> np.ndarray:
    return 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(n) / n)


def frames_of(x: np.ndarray, length: int, hop: int, edge: str) -> np.ndarray:
    """Centred frames (a view); the edges are filled by ``edge``."""
    padded = np.pad(x, length // 2, mode=edge)
    return np.lib.stride_tricks.sliding_window_view(padded, length)[::hop]


def spectra(x: np.ndarray, length: int, hop: int):
    """Magnitudes of the frames, a block of frames at a time."""
    cut = frames_of(x, length, hop, "reflect")
    for at in range(0, len(cut), BLOCK_FRAMES):
        yield np.abs(np.fft.rfft(cut[at : at + BLOCK_FRAMES] * window(length), axis=1))


@lru_cache
def mel_matrix(bands: int, bins: int, rate: int) -> np.ndarray:
    return np.array(mel_weights(bands, bins, rate))


@lru_cache
def dct_matrix(n: int, rows: int) -> np.ndarray:
    c, k = np.arange(rows)[:, None], np.arange(n)[None, :]
    scale = np.where(c == 0, np.sqrt(1 / n), np.sqrt(2 / n))
    return scale * np.cos(np.pi * c * (2 * k + 1) / (2 * n))


def series_of(mag: np.ndarray, length: int, rate: int, n_cepstral: int) -> dict[str, np.ndarray]:
    """Frame series of a block of spectra (frames x bins)."""
    bins = mag.shape[1]
    hz = np.arange(bins) * rate / (2 * (bins - 1))
    half = np.ones(bins)
    half[0] = 0.5
    if length % 2 == 0:
        half[-1] = 0.5
    total = mag.sum(1)
    norm = np.where(total > 0, total, 1)[:, None]
    center = (mag / norm) @ hz
    spread = ((hz[None, :] - center[:, None]) ** 2 * mag / norm).sum(1)
    power = np.maximum(mag**2, TINY)
    upto = mag.cumsum(1)
    roll = {s: hz[(upto < s / 100 * total[:, None]).sum(1).clip(max=bins - 1)] for s in (15, 85)}
    return {
        "rms": np.sqrt(2 * (mag**2 @ half) / length**2),
        "centroid": center,
        "bandwidth": np.sqrt(spread),
        "flatness": np.exp(np.log(power).mean(1)) / power.mean(1),
        "rolloff_15": roll[15],
        "rolloff_85": roll[85],
        "coef": mag @ dct_matrix(bins, n_cepstral)[1:].T,
    }


def zero_crossings(x: np.ndarray, length: int, hop: int) -> np.ndarray:
    """Share of sign changes per centred frame, edges repeated."""
    low = np.where(np.abs(x) <= TINY, 0, x) < 0
    padded = np.pad(low, length // 2, mode="edge")
    moved = np.concatenate([[0], np.cumsum(padded[1:] != padded[:-1])])
    first = np.arange(0, len(padded) - length + 1, hop)
    return (moved[first + length - 1] - moved[first]) / length


def onset_flux(x: np.ndarray, rate: int, length: int, hop: int, bands: int) -> np.ndarray:
    """Mean positive rise of the mel bands in dB from frame to frame.

    Short signals keep their bands; long recordings are transformed twice, once
    for the loudest band value and once for the rises, so memory stays bounded.
    """
    weights = mel_matrix(bands, length // 2 + 1, rate).T

    def in_db():
        return (10 * np.log10(np.maximum(mag**2 @ weights, TINY)) for mag in spectra(x, length, hop))

    short = list(in_db()) if len(x) // hop < BLOCK_FRAMES else None
    floor = max(db.max() for db in short or in_db()) - 80
    rises, last = [], None
    for db in short or in_db():
        db = np.maximum(db, floor)
        rises.append(np.maximum(np.diff(db, axis=0, prepend=db[:1] if last is None else last), 0).mean(1))
        last = db[-1:]
    return np.concatenate(rises)


def stretch(x: np.ndarray, rate: float, length: int = 2048) -> np.ndarray:
    """Change the speed and keep the pitch: phase vocoder with a hop of a quarter frame."""
    hop = length // 4
    spec = np.fft.rfft(frames_of(x, length, hop, "reflect") * window(length), axis=1)
    at = np.arange(0, len(spec), rate)
    low = at.astype(int)
    spec = np.concatenate([spec, np.zeros((2, spec.shape[1]))])
    a, b, share = spec[low], spec[low + 1], (at - low)[:, None]
    step = np.pi * hop * np.linspace(0, 1, spec.shape[1])
    turn = np.angle(b) - np.angle(a) - step
    turn = step + turn - 2 * np.pi * np.round(turn / (2 * np.pi))
    phase = np.angle(spec[0]) + np.concatenate([np.zeros((1, spec.shape[1])), np.cumsum(turn, axis=0)[:-1]])
    parts = np.fft.irfft(((1 - share) * np.abs(a) + share * np.abs(b)) * np.exp(1j * phase), length, axis=1)
    n = (len(parts) - 1) * hop + length
    out, weight = np.zeros(n), np.zeros(n)
    for i, part in enumerate(parts):
        out[i * hop : i * hop + length] += part * window(length)
        weight[i * hop : i * hop + length] += window(length) ** 2
    out = np.where(weight > TINY, out / np.maximum(weight, TINY), out)[length // 2 :]
    wanted = int(round(len(x) / rate))
    return np.pad(out[:wanted], (0, max(0, wanted - len(out)))).astype("float32")


def shift_pitch(x: np.ndarray, semitones: float) -> np.ndarray:
    """Change the pitch and keep the length."""
    rate = 2.0 ** (-semitones / 12)
    slow = stretch(x, rate)
    y = np.interp(np.arange(len(x)) / rate, np.arange(len(slow)), slow, right=0.0)
    return y.astype("float32")
