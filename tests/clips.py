"""Small wav files for tests."""

import io
import wave

import numpy as np

RATE = 22050


def tone(hz, seconds=0.6, level=0.5, fade=True, rate=RATE):
    t = np.arange(int(seconds * rate)) / rate
    x = level * np.sin(2 * np.pi * hz * t)
    return x * np.exp(-4 * t) if fade else x


def noise(seed, seconds=0.4, level=0.5):
    n = int(seconds * RATE)
    return np.random.default_rng(seed).uniform(-level, level, n) * np.exp(-8 * np.arange(n) / n)


def wav_bytes(x, rate=RATE, channels=1, width=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(width)
        f.setframerate(rate)
        data = np.repeat(np.asarray(x)[:, None], channels, axis=1).clip(-1, 1)
        if width == 1:
            f.writeframes((data * 127 + 128).astype("u1").tobytes())
        elif width == 3:
            whole = (data * (2**23 - 1)).astype("<i4")
            f.writeframes(whole.reshape(-1, 1).view("u1").reshape(-1, 4)[:, :3].tobytes())
        else:
            f.writeframes((data * (2**15 - 1)).astype("<i2").tobytes())
    return out.getvalue()


def write(path, x, **kw):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(wav_bytes(x, **kw))
