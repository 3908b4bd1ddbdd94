"""Frame series from magnitude spectra, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.functions import arrays as A


SERIES = ("rms", "centroid", "bandwidth", "flatness", "rolloff_15", "rolloff_85", "coef")


def spectrum_series(
    spectra: DataFrame, bins: int, sample_rate: int, wanted: tuple[str, ...] = SERIES, n_cepstral: int = 12
) -> DataFrame:
    """Add the wanted series of ``SERIES`` to rows with ``mag``.

    Row-local: the spectrum is read where it lies and nothing is exploded.
    """
    hz, mag = A.lit_array(A.bin_hz(bins, sample_rate)), F.col("mag")
    makers = {
        "rms": lambda: A.rms_of_spectrum(mag, 2 * (bins - 1)),
        "centroid": lambda: A.centroid(mag, hz),
        "bandwidth": lambda: A.bandwidth(mag, hz, A.centroid(mag, hz)),
        "flatness": lambda: A.flatness(mag),
        "rolloff_15": lambda: A.rolloff(mag, hz, 0.15),
        "rolloff_85": lambda: A.rolloff(mag, hz, 0.85),
        "coef": lambda: A.cepstrum(mag, bins, 1, n_cepstral),
    }
    return spectra.select("*", *[makers[name]().alias(name) for name in wanted])


def cell_statistics(df: DataFrame, cells: str) -> DataFrame:
    """One row (mean, std) over all cells of all arrays: sums per row, then one merge."""
    sums = df.select(
        F.size(cells).alias("n"),
        A.total(F.col(cells)).alias("s"),
        A.total(F.transform(cells, lambda v: v * v)).alias("q"),
    )
    merged = sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    mean = F.col("s") / F.col("n")
    return merged.select(
        mean.alias("mean"), F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0))).alias("std")
    )
