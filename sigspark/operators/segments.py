"""Long series without long groups.

A series (one key: a signal, a class, a user) may hold a large share of all
rows, so nothing here brings a whole key into one task:

* ``with_positions``  ranks rows in their key; a heavy key is cut into ranges
  of about equal size and each range is ranked alone, plus the rows before it.
* ``chunked``         cuts a ranked series into fixed-size chunks.
* ``with_halo``       copies rows near a chunk edge into the neighbour chunk, so
  windows over (key, chunk) see the same neighbours as windows over key.
* ``attach``          joins one row per key back to the series by (key, chunk).
* ``running_sum``     chunk-wise running sums plus the totals of earlier chunks.
* ``join_small``      broadcasts a table only after its size was checked and
  salts the join when it is larger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_LOCAL_ROWS = 100_000
HEAVY_ROWS = 1_000_000
CHUNK = 500_000
SALTS = 64
#: Sampled rows for every piece of a heavy key.
EDGE_SAMPLE = 64


def local_table(df: DataFrame, max_rows: int = MAX_LOCAL_ROWS) -> DataFrame | None:
    """``df`` as an in-memory relation if it has at most ``max_rows`` rows, else None."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def join_small(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "left", max_rows: int = MAX_LOCAL_ROWS
) -> DataFrame:
    """Join a per-group table to its rows.

    Small enough (counted, not guessed): broadcast. Else the join is salted,
    so a group with very many rows is spread over ``SALTS`` tasks.
    """
    table = local_table(small, max_rows)
    if table is not None:
        return big.join(F.broadcast(table), on, how)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int"))
    return spread.join(salted.hint("merge"), [*on, "_salt"], how).drop("_salt")


def _place(order: str, ties: tuple[str, ...], columns: list[str]) -> Column:
    """What rows of a heavy key are sorted by: order, ties, and a hash of the row where these are equal."""
    return F.struct(F.col(order).alias("o"), *[F.col(t).alias(f"t{i}") for i, t in enumerate(ties)], F.xxhash64(*columns).alias("h"))


def _edges(known: DataFrame, keys: list[str], heavy_rows: int) -> DataFrame:
    """Per heavy key the sorted places (``_place``) at which its pieces start, as arrays ``_e1``; every 16th and 256th of them in ``_e16`` and ``_e256``.

    Places come from a sample of the rows, EDGE_SAMPLE for every piece, taken by a hash: samples of parts of a table merge into that
    of the table, and the same rows are taken whatever the partitions. With about heavy_rows / 4 rows a piece, a piece is
    off by one part in sqrt(EDGE_SAMPLE), however skewed the order values are.
    """
    slots = 1 << 30
    taken = int(min(1.0, 4 * EDGE_SAMPLE / heavy_rows) * slots)
    sample = known.where(F.pmod(F.xxhash64(F.lit(heavy_rows), F.col("_place")), F.lit(slots)) < taken)
    inside = Window.partitionBy(*keys)
    ranked = sample.withColumn("_r", F.row_number().over(inside.orderBy("_place"))).withColumn("_s", F.count(F.lit(1)).over(inside))
    pieces = F.ceil(F.col("_n") * 4 / heavy_rows)
    step = lambda r: F.floor(r * pieces / F.col("_s"))
    # a piece starts at the first sampled row of each share
    starts = ranked.where((F.col("_r") > 1) & (step(F.col("_r") - 1) != step(F.col("_r") - 2)))
    held = starts.groupBy(*keys).agg(F.array_sort(F.collect_set("_place")).alias("_e1"))
    every = lambda n: F.filter("_e1", lambda _, i: i % n == n - 1)
    return held.withColumn("_e16", every(16)).withColumn("_e256", every(256))


def _with_pieces(df: DataFrame, keys: list[str], order: str, heavy: DataFrame, heavy_rows: int, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add ``_piece``: the range of places a row of a heavy key falls in, 0 for other keys."""
    place = _place(order, ties, df.columns)
    known = df.select(*keys, place.alias("_place")).join(F.broadcast(heavy), keys)
    # one row per heavy key, about four places for every heavy_rows rows
    edges = heavy.join(local_table(_edges(known, keys, heavy_rows)), keys, "left").drop("_n")
    placed = df.withColumn("_place", place).join(F.broadcast(edges.withColumn("_heavy", F.lit(True))), keys, "left")
    # how many edges are not above the place: in steps of 256, 16 and 1
    upto = lambda a: F.size(F.filter(a, lambda e: e <= F.col("_place")))
    placed = placed.withColumn("_far", upto(F.col("_e256")))
    placed = placed.withColumn("_mid", F.col("_far") * 16 + upto(F.slice("_e16", F.col("_far") * 16 + 1, F.lit(16))))
    piece = F.col("_mid") * 16 + upto(F.slice("_e1", F.col("_mid") * 16 + 1, F.lit(16)))
    cut = placed.withColumn("_piece", F.when(F.col("_e1").isNotNull(), piece).otherwise(0).cast("long"))
    return cut.withColumn("_heavy", F.coalesce("_heavy", F.lit(False))).select(*df.columns, "_piece", "_heavy")


def with_positions(
    df: DataFrame,
    keys: list[str],
    order: str,
    ties: tuple[str, ...] = (),
    out: str = "pos",
    heavy_rows: int | None = None,
) -> DataFrame:
    """Add the 0-based rank of each row in its key, by ``order`` then ``ties``.

    First pass: count rows per key (combined before the shuffle) and keep the
    heavy keys; there are at most rows / heavy_rows of them. Without any, this
    is a plain window. Otherwise heavy keys are cut into ranges of (order, ties, row hash) of
    about equal size (``_edges``), ranges are ranked alone, and each adds the row count of the
    ranges before it. Equal order values are cut as well, only equal rows stay together.
    """
    keys, heavy_rows = list(keys), heavy_rows or HEAVY_ROWS
    if not keys:
        return with_positions(df.withColumn("_all", F.lit(0)), ["_all"], order, ties, out, heavy_rows).drop("_all")
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = local_table(sizes.where(F.col("_n") > heavy_rows))
    while heavy is None:
        heavy_rows *= 10
        heavy = local_table(sizes.where(F.col("_n") > heavy_rows))
    sort = [F.col(order), *[F.col(t) for t in ties]]
    if heavy.isEmpty():
        w = Window.partitionBy(*keys).orderBy(*sort)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))

    cut = _with_pieces(df, keys, order, heavy, heavy_rows, ties)
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.where("_heavy")
        .groupBy(*keys, "_piece")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    # at most 4 * rows / heavy_rows + 1 per heavy key
    cut = join_small(cut, starts, [*keys, "_piece"], max_rows=10 * MAX_LOCAL_ROWS)
    w = Window.partitionBy(*keys, "_piece").orderBy(*sort, F.when(F.col("_heavy"), F.xxhash64(*df.columns)))
    rank = F.row_number().over(w) - 1 + F.coalesce(F.col("_start"), F.lit(0))
    return cut.withColumn(out, rank.cast("long")).select(*df.columns, out)


def chunk_of(idx: str, size: int | None = None) -> Column:
    return F.floor(F.col(idx) / (size or CHUNK)).cast("long")


def chunked(df: DataFrame, idx: str, size: int | None = None) -> DataFrame:
    return df.withColumn("_chunk", chunk_of(idx, size))


def with_halo(df: DataFrame, idx: str, before: int, after: int, size: int | None = None) -> DataFrame:
    """Cut by dense index ``idx`` and copy edge rows to the neighbour chunks.

    Adds ``_chunk`` and ``_home``; windows over (key, _chunk) may look
    ``before`` rows back and ``after`` rows ahead. Keep ``_home`` rows at the end.
    """
    size = size or CHUNK
    own = chunk_of(idx, size)
    place = F.col(idx) - own * size
    copies = F.array_compact(
        F.array(
            own,
            F.when((place < after) & (own > 0), own - 1),
            F.when(place >= size - before, own + 1),
        )
    )
    return df.withColumn("_chunk", F.explode(copies)).withColumn("_home", F.col("_chunk") == own)


def attach(series: DataFrame, per_key: DataFrame, keys: list[str], idx: str, length: str, size: int | None = None) -> DataFrame:
    """Join per-key values to every row of the series.

    ``per_key[length]`` is the number of rows (or frames) of the key. The
    per-key row is repeated once per chunk, so the join key is (key, chunk)
    and a heavy key is spread over as many tasks as it has chunks.
    """
    last = F.floor(F.greatest(F.col(length) - 1, F.lit(0)) / (size or CHUNK)).cast("long")
    spread = per_key.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return chunked(series, idx, size).join(spread, [*keys, "_chunk"]).drop("_chunk")


def running_sum(df: DataFrame, keys: list[str], idx: str, values: dict[str, str], size: int | None = None) -> DataFrame:
    """Running sums over a whole series: inside chunks, plus earlier chunk totals.

    The totals are made from the windowed chunks, so both sides of the join
    start at the same exchange and the rows before it are computed once.
    """
    w = Window.partitionBy(*keys, "_chunk").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    local = chunked(df, idx, size).withColumns({out: F.sum(src).over(w) for out, src in values.items()})
    totals = local.groupBy(*keys, "_chunk").agg(*[F.max_by(out, idx).alias(f"_t_{out}") for out in values])
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "_chunk", *[F.coalesce(F.sum(f"_t_{o}").over(before), F.lit(0.0)).alias(f"_b_{o}") for o in values]
    )
    joined = local.join(carried, [*keys, "_chunk"])
    return joined.withColumns({o: F.col(o) + F.col(f"_b_{o}") for o in values}).drop("_chunk", *[f"_b_{o}" for o in values])
