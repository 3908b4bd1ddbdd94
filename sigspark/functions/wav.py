"""The wav container: header and sample bytes, PCM and IEEE float, plain and extensible."""

from __future__ import annotations

import struct
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

# Format codes of the container.
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


@dataclass(frozen=True)
class Header:
    rate: int
    channels: int
    bits: int
    encoding: str  # pcm or float
    data_start: int
    n_samples: int  # per channel

    @property
    def step(self) -> int:
        """Bytes of one sample of all channels."""
        return self.channels * self.bits // 8


def read_header(f: BinaryIO, size: int) -> Header:
    """The header of an open file of ``size`` bytes; only chunk heads are read. Raises ValueError when it isn't a wav file.

    A data chunk that promises more than the file holds ends with the file, at a whole sample.
    """
    head = f.read(12)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        raise ValueError("no wav file")
    kind = None
    while True:
        chunk = f.read(8)
        if len(chunk) < 8:
            raise ValueError("no samples")
        name, length = struct.unpack("<4sI", chunk)
        if name == b"fmt ":
            body = f.read(length)
            code, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", body)
            if code == EXTENSIBLE and length >= 26:
                code = struct.unpack_from("<H", body, 24)[0]
            kind = {PCM: "pcm", FLOAT: "float"}.get(code)
            if kind is None or bits not in {"pcm": (8, 16, 24, 32), "float": (32, 64)}[kind] or not channels or not rate:
                raise ValueError(f"unknown format {code} of {bits} bits")
            f.seek(length & 1, 1)
        elif name == b"data":
            if kind is None:
                raise ValueError("samples before the format")
            start = f.tell()
            step = channels * bits // 8
            return Header(rate, channels, bits, kind, start, min(length, size - start) // step)
        else:
            f.seek(length + (length & 1), 1)


def to_mono(raw: bytes, header: Header) -> np.ndarray:
    """Mean of the channels, -1..1, as float32."""
    bits = header.bits
    if header.encoding == "float":
        x = np.frombuffer(raw, f"<f{bits // 8}").astype("float32")
    elif bits == 8:  # unsigned
        x = (np.frombuffer(raw, "u1").astype("float32") - 128) / 128
    elif bits == 24:
        b = np.frombuffer(raw, "u1").reshape(-1, 3)
        wide = np.zeros((len(b), 4), "u1")
        wide[:, 1:] = b
        x = wide.view("<i4")[:, 0].astype("float32") / 2**31
    else:
        x = np.frombuffer(raw, f"<i{bits // 8}").astype("float32") / 2 ** (bits - 1)
    return x if header.channels == 1 else x.reshape(-1, header.channels).mean(axis=1)


def encode(x: np.ndarray, rate: int, encoding: str = "pcm") -> bytes:
    """A mono file: 16-bit PCM (clipped to -1..1) or 32-bit float."""
    x = np.asarray(x, "float32")
    if encoding == "float":
        code, bits, raw = FLOAT, 32, x.astype("<f4").tobytes()
    else:
        code, bits, raw = PCM, 16, np.clip(np.rint(x.astype("float64") * 2**15), -(2**15), 2**15 - 1).astype("<i2").tobytes()
    step = bits // 8
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, code, 1, rate, rate * step, step, bits)
    body = b"WAVE" + form + struct.pack("<4sI", b"data", len(raw)) + raw
    return struct.pack("<4sI", b"RIFF", len(body)) + body
