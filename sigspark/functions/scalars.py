"""Column helpers for paths, names, times and safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN_TIME = "yyyyMMdd-HHmmss"
MODEL_TIME = "yyyyMMdd_HHmmss"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    """Last part of a path; a trailing slash does not count."""
    return F.element_at(F.split(F.rtrim(col(path), F.lit("/")), "/"), -1)


def suffix(name: Column | str) -> Column:
    """``.wav`` of ``a/b.wav``; empty when there is none or the name only starts with a dot."""
    return F.regexp_extract(base_name(name), r"[^.](\.[^.]*)$", 1)


def stem(path: Column | str) -> Column:
    base = base_name(path)
    return F.substring(base, F.lit(1), F.length(base) - F.length(suffix(path)))


def flat_name(path: Column | str, root: str = "") -> Column:
    """Path below ``root`` with the slashes written as ``__``."""
    below = F.replace(col(path), F.lit(root + "/"), F.lit("")) if root else col(path)
    return F.replace(below, F.lit("/"), F.lit("__"))


def run_id(library: Column | str, at: Column | str) -> Column:
    """``yyyyMMdd-HHmmss-<last path part, blanks as _>``."""
    name = F.replace(base_name(library), F.lit(" "), F.lit("_"))
    return F.concat_ws("-", F.date_format(col(at), RUN_TIME), name)


def model_id(key: str, at: Column | str) -> Column:
    return F.concat_ws("_", F.lit(key.upper()), F.date_format(col(at), MODEL_TIME))


def family(model_name: Column | str) -> Column:
    """Model family: what stands before the first underscore."""
    return F.substring_index(col(model_name), "_", 1)


def log10_pos(x: Column | str) -> Column:
    """log10, NULL where the value is not positive."""
    return F.log10(F.when(col(x) > 0, col(x)))


def finite(x: Column | str) -> Column:
    """NULL instead of NaN and infinities."""
    c = col(x)
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def decibel(x: Column | str, floor: float = 1e-5) -> Column:
    """Amplitude in dB."""
    return 20 * F.log10(F.greatest(col(x), F.lit(floor)))


def hash60(*parts: Column) -> Column:
    """60-bit number from the md5 text: the same in every SQL engine."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_unit(*parts: Column) -> Column:
    """Number in [0, 1) from the first 52 bits of the md5 text."""
    text = F.concat_ws("-", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(16**13))


def micros(df, name: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without time zone stays free of the session's zone."""
    if df.schema[name].dataType.typeName() == "timestamp_ntz":
        since = F.col(name) - F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))
        return (since.cast("interval second").cast("decimal(20,6)") * 1000000).cast("long")
    return F.unix_micros(F.col(name))
