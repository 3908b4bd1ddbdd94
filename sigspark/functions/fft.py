"""The Fourier transform of real frames as array expressions: radix 2, no Python.

A frame of n points (a power of two) is taken as n / 2 complex numbers, even points as real and odd points as imaginary parts. Each of
log2(n / 2) stages adds and subtracts the two halves of the array, turns the differences and puts both into place, so that the
result comes out in order (Stockham). A last step separates the spectrum of the real frame. A stage is a few dozen nodes whatever n is, and its
input is computed once (``let``), so the work is n log n.
"""

from __future__ import annotations

import cmath
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from sigspark.functions.arrays import hann, let, lit_array


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def _times(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x * y)


def _pair(re: Column, im: Column) -> Column:
    return F.struct(re.alias("re"), im.alias("im"))


def _turn(v: Column, factors: list[complex]) -> Column:
    """Every element of a complex array times its factor."""
    c, s = lit_array(w.real for w in factors), lit_array(w.imag for w in factors)
    return _pair(_minus(_times(v["re"], c), _times(v["im"], s)), _plus(_times(v["re"], s), _times(v["im"], c)))


def _stage(v: Column, n: int, m: int) -> Column:
    """One stage on n numbers, of which blocks of ``m`` are neighbours in the result."""
    half = n // 2
    first = lambda a: F.slice(a, F.lit(1), F.lit(half))
    second = lambda a: F.slice(a, F.lit(half + 1), F.lit(half))
    sums = _pair(*(_plus(first(v[p]), second(v[p])) for p in ("re", "im")))
    differences = _pair(*(_minus(first(v[p]), second(v[p])) for p in ("re", "im")))
    angles = [cmath.exp(-2j * math.pi * (i // m) * m / n) for i in range(half)]
    # a block of sums, then the block of turned differences
    source = [i // (2 * m) * m + i % m + (half if i % (2 * m) >= m else 0) for i in range(n)]
    order = F.expr("array(" + ", ".join(map(str, source)) + ")")

    def placed(a: Column) -> Column:
        return F.transform(order, lambda i: F.get(a, i))

    def together(d: Column) -> Column:
        turned = _turn(d, angles)
        return let(_pair(*(F.concat(sums[p], turned[p]) for p in ("re", "im"))), lambda a: _pair(placed(a["re"]), placed(a["im"])))

    return let(differences, together)


def _stage_at(n: int, m: int):
    return lambda v: _stage(v, n, m)


def rfft(frame: Column, n: int, window: list[float] | None = None) -> Column:
    """Struct (re, im) of bins 0..n/2 of the first ``n`` points of a frame; ``window`` has a weight for every point."""
    if n < 4 or n & (n - 1):
        raise ValueError("the length must be a power of two, 4 at least")
    half = n // 2
    points = F.slice(frame, F.lit(1), F.lit(n))
    if window is not None:
        points = _times(points, lit_array(window))
    every_other = lambda a, odd: F.filter(a, lambda _, i: i % 2 == odd)
    now = let(points, lambda a: _pair(every_other(a, 0), every_other(a, 1)))
    m = 1
    while m < half:
        now = let(now, _stage_at(half, m))
        m *= 2

    def separated(v: Column) -> Column:
        # bin k belongs with bin half - k
        ahead = [F.concat(v[p], F.slice(v[p], F.lit(1), F.lit(1))) for p in ("re", "im")]

        def bins(a: Column) -> Column:
            back_re, back_im = F.reverse(a["re"]), F.reverse(a["im"])
            even = _pair(_plus(a["re"], back_re), _minus(a["im"], back_im))
            odd = _pair(_plus(a["im"], back_im), _minus(back_re, a["re"]))
            turned = _turn(odd, [cmath.exp(-2j * math.pi * k / n) for k in range(half + 1)])
            half_sum = lambda x, y: F.zip_with(x, y, lambda p, q: (p + q) / 2)
            return let(turned, lambda t: _pair(half_sum(even["re"], t["re"]), half_sum(even["im"], t["im"])))

        return let(_pair(*ahead), bins)

    return let(now, separated)


def magnitude(frame: Column, n: int) -> Column:
    """Magnitudes of bins 0..n/2 of a Hann-windowed frame; NULL for frames that are shorter."""
    spectrum = let(rfft(frame, n, hann(n)), lambda s: F.zip_with(s["re"], s["im"], lambda a, b: F.sqrt(a * a + b * b)))
    return F.when(F.size(frame) >= n, spectrum)
