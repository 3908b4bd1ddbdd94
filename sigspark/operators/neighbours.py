"""Exact nearest rows: class means and k nearest neighbours."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.functions.arrays import dot, lit_array
from sigspark.session import stored

MAX_BROADCAST_CELLS = 10_000_000
BLOCK = 20_000
MAX_BLOCKS = 100_000
#: Numbers of features that a batch of (query, block) pairs holds in Python.
PAIR_CELLS = 500_000
#: Numbers of features, and rows, of a shelf of blocks and of the group of queries that meets it in one task.
SHELF_CELLS, SHELF_ROWS = 4_000_000, 200_000
#: Queries and rows whose distances are computed at once.
SLICE, CHUNK = 256, 8192
#: Principal directions that a block's box is measured in.
AXES = 6


def class_means(df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """Mean feature array per class; cells are combined before the shuffle."""
    cells = df.select(label, F.posexplode(features).alias("idx", "v"))
    means = cells.groupBy(label, "idx").agg(F.avg("v").alias("m"))
    return means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("idx", "m")))["m"].alias("center"))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def nearest_mean(df: DataFrame, means: DataFrame, id_col: str, label: str = "label", features: str = "features") -> DataFrame:
    """Scores of all classes per row as one array, then the best: no pair leaves its row.

    The table of means has one row per class.
    """
    packed = means.agg(
        F.sort_array(F.collect_list(F.struct(F.col(label).alias("code"), "center"))).alias("p")
    ).scalar()
    scored = df.withColumn("_means", packed)
    costs = F.transform("_means", lambda m: F.struct(squared_distance(F.col(features), m["center"]).alias("d"), m["code"].alias("code")))
    return scored.withColumn("predicted", F.array_min(costs)["code"]).drop("_means")


def _ids(values) -> np.ndarray:
    """Ids as an array that sorts: numbers stay, text becomes fixed width and sorts by code point as Spark's does."""
    made = np.asarray(values)
    return made if made.dtype != object else np.array([str(v) for v in made])


def _matrix(rows) -> np.ndarray:
    return np.array(list(rows), dtype="float64")


def _top_k(q: np.ndarray, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int):
    """k nearest of ``rows`` for each query: squared distances, ids and labels, by distance then id."""
    d = ((q**2).sum(1)[:, None] - 2.0 * q @ rows.T) + (rows**2).sum(1)[None, :]
    k = min(k, len(ids))
    # everything as near as the k-th, measured again without cancellation
    near = np.partition(d, k - 1, axis=1)[:, k - 1] + 1e-6 * (1 + np.abs(d).max())
    out = []
    for i in range(len(q)):
        at = np.flatnonzero(d[i] <= near[i])
        exact = ((rows[at] - q[i]) ** 2).sum(1)
        order = np.lexsort((ids[at], exact))[:k]
        out.append((exact[order], ids[at][order], labels[at][order]))
    return out


def _neighbour_rows(query_ids, found) -> pd.DataFrame:
    sizes = [len(f[0]) for f in found]
    if not sizes:
        return pd.DataFrame({"query_id": [], "row_id": [], "label": [], "dist": []})
    return pd.DataFrame(
        {
            "query_id": np.repeat(np.asarray(query_ids, dtype=object), sizes),
            "row_id": [i for f in found for i in f[1].tolist()],
            "label": np.concatenate([f[2] for f in found]),
            "dist": np.concatenate([f[0] for f in found]),
        }
    )


def _meet(queries: pd.DataFrame, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int) -> pd.DataFrame:
    """Neighbours among ``rows`` of all queries, a slice of queries at a time."""
    made = []
    for at in range(0, len(queries), 256):
        part = queries.iloc[at : at + 256]
        made.append(_neighbour_rows(part["query_id"], _top_k(_matrix(part["features"]), ids, labels, rows, k)))
    return pd.concat(made) if made else _neighbour_rows([], [])


def principal_axes(train: DataFrame, width: int, n_rows: int, axes: int = AXES) -> np.ndarray:
    """Orthonormal directions (width x axes) of largest variance; the driver sees width x width numbers."""
    axes = min(axes, width)
    if n_rows < 2:
        return np.eye(width)[:, :axes]
    rows = train.select(array_to_vector("features").alias("v"))
    return PCA(k=axes, inputCol="v", outputCol="c").fit(rows).pc.toArray()


def with_coordinates(df: DataFrame, axes: np.ndarray) -> DataFrame:
    """Adds ``_c``: the projection on every axis, and the length of what the axes leave out.

    The distance of two rows' coordinates is never above the distance of the rows: the axes are
    orthonormal, and the lengths of two remainders differ by at most the length of their difference.
    """
    df = df.withColumn("_p", F.array(*[dot(F.col("features"), lit_array(axis)) for axis in axes.T]))
    square = lambda name: dot(F.col(name), F.col(name))
    rest = F.sqrt(F.greatest(square("features") - square("_p"), F.lit(0.0)))
    return df.withColumn("_c", F.concat("_p", F.array(rest))).drop("_p")


@dataclass
class Blocks:
    """Training rows cut into blocks of near rows, and a box of coordinates around each."""

    rows: DataFrame  # row_id, label, features, _block
    axes: np.ndarray
    ids: np.ndarray
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def bounds(self, c: np.ndarray) -> np.ndarray:
        """Lower bound of the distance from each query (rows of coordinates) to every block's rows."""
        out = np.zeros((len(c), len(self.ids)))
        for i in range(c.shape[1]):
            gap = np.maximum(np.maximum(self.low[:, i][None, :] - c[:, i][:, None], c[:, i][:, None] - self.high[:, i][None, :]), 0)
            out += gap**2
        # the coordinates are rounded sums: allow for their error
        scale = 1 + np.abs(c).max(1)[:, None] + np.maximum(np.abs(self.low), np.abs(self.high)).max(1)[None, :]
        return np.maximum(np.sqrt(out) - 1e-6 * scale, 0)


def cut_into_blocks(train: DataFrame, width: int, block: int = BLOCK) -> Blocks:
    """Cells between quantiles of the principal coordinates; a cell above ``block`` rows is dealt into several blocks by row id.

    The tables of cells and blocks have about one row per ``block`` training rows, MAX_BLOCKS at most: ``block`` grows beyond that.
    """
    n = train.count()
    block = max(block, -(-n // MAX_BLOCKS))
    axes = principal_axes(train, width, n)
    rows = with_coordinates(train, axes)
    m = axes.shape[1]
    # at most as many cells as blocks are wanted, most cuts along the first axis
    wanted, cuts = max(1, -(-n // block)), [1] * m
    while np.prod(cuts) * 2 <= wanted:
        # the axis whose cells are widest, by the order of variance
        cuts[min(range(m), key=lambda i: (cuts[i] * (i + 1), i))] *= 2
    shares = [[j / c for j in range(1, c)] for c in cuts]
    asked = [F.percentile_approx(F.col("_c")[i], s, 10_000).alias(f"q{i}") for i, s in enumerate(shares) if s]
    edges = rows.agg(*asked).first() if asked else None
    cell = F.lit(0).cast("long")
    for i, c in enumerate(cuts):
        if c > 1:
            inner = F.size(F.filter(lit_array(edges[f"q{i}"]), lambda e, i=i: e <= F.col("_c")[i]))
            cell = cell * c + inner
    rows = rows.withColumn("_cell", cell)
    counts = rows.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / block).alias("_parts"))
    parts = train.sparkSession.createDataFrame(counts.toArrow(), counts.schema)  # one row per cell
    rows = rows.join(F.broadcast(parts), "_cell")
    rows = rows.withColumn("_block", F.concat_ws("/", F.col("_cell").cast("string"), F.pmod(F.xxhash64("row_id"), F.col("_parts")).cast("string")))
    rows = stored(rows.select("row_id", "label", "features", "_c", "_block"), "knn-blocks")
    ends = [f(F.col("_c")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(m + 1)]
    boxes = rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n"), *ends).orderBy("_block").toPandas()  # one row per block
    side = lambda name: boxes[[f"{name}{i}" for i in range(m + 1)]].to_numpy("float64")
    return Blocks(rows.drop("_c"), axes, boxes["_block"].to_numpy(), boxes["n"].to_numpy("int64"), side("low"), side("high"))


def _pairs(queries: pd.DataFrame, hit: np.ndarray, ids: np.ndarray, width: int):
    """(query_id, features, _block) of all hits, in batches: a query may ask for every block, so its features are copied for a few pairs at a time."""
    which, block = np.nonzero(hit)
    step = max(1, PAIR_CELLS // max(1, width))
    for at in range(0, len(which), step):
        some = which[at : at + step]
        yield pd.DataFrame(
            {
                "query_id": queries["query_id"].to_numpy()[some],
                "features": queries["features"].to_numpy()[some],
                "_block": ids[block[at : at + step]],
            }
        )


def blocks_asked(queries: DataFrame, blocks: Blocks, k: int, kind: str) -> DataFrame:
    """(query_id, features, _block): the blocks that may hold one of a query's k nearest rows.

    With a column ``bound`` (a distance that k rows are known to keep) these are all blocks whose box is not farther away. Without,
    the nearest blocks that hold k rows together.
    """
    known = "bound" in queries.columns
    parts = Blocks(None, blocks.axes, blocks.ids, blocks.sizes, blocks.low, blocks.high)  # a data frame can't go to the tasks
    shared = queries.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        b = shared.value
        step = max(1, 2_000_000 // max(1, len(b.ids)))
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at : at + step]
                away = b.bounds(_matrix(part["_c"]))
                if known:
                    hit = away <= part["bound"].to_numpy()[:, None]
                else:
                    order = np.argsort(away, axis=1, kind="stable")
                    before = np.cumsum(b.sizes[order], axis=1) - b.sizes[order]
                    hit = np.zeros(away.shape, bool)
                    np.put_along_axis(hit, order, before < k, axis=1)
                yield from _pairs(part, hit, b.ids, len(b.axes))

    return with_coordinates(queries, blocks.axes).mapInPandas(run, f"query_id {kind}, features array<double>, _block string")


def search_blocks(asked: DataFrame, blocks: Blocks, k: int, schema: str, block: int = BLOCK) -> DataFrame:
    """The k nearest rows of every (query, block) asked for.

    A block that many queries ask for meets them in groups of at most about ``block`` queries: only its rows are copied, once per group.
    """
    asked = stored(asked, "knn-asked")
    counts = asked.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / block).alias("_groups"))
    groups = asked.sparkSession.createDataFrame(counts.toArrow(), counts.schema)  # at most one row per block
    left = asked.join(F.broadcast(groups), "_block").withColumn("_group", F.pmod(F.xxhash64("query_id"), F.col("_groups")))
    right = blocks.rows.join(F.broadcast(groups), "_block").withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)))

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if len(a) == 0 or len(b) == 0:
            return _neighbour_rows([], [])
        return _meet(a, _ids(b["row_id"]), b["label"].to_numpy(), _matrix(b["features"]), k)

    return left.drop("_groups").groupBy("_block", "_group").cogroup(right.drop("_groups").groupBy("_block", "_group")).applyInPandas(meet, schema)


def shelved(blocks: Blocks, width: int, tasks: int) -> np.ndarray:
    """The shelf of every block: neighbouring blocks, together as many rows as a task may hold, fewer where there would be less than ``tasks`` shelves."""
    total = int(blocks.sizes.sum())
    rows = max(1, min(SHELF_CELLS // max(1, width), SHELF_ROWS, -(-total // tasks)))
    order = sorted(range(len(blocks.ids)), key=lambda i: [int(part) for part in blocks.ids[i].split("/")])
    out = np.zeros(len(order), "int64")
    before = np.cumsum(blocks.sizes[order]) - blocks.sizes[order]
    out[order] = np.unique(before // rows, return_inverse=True)[1]
    return out


def shelves_asked(queries: DataFrame, blocks: Blocks, shelf: np.ndarray, kind: str) -> DataFrame:
    """(query_id, features, bound, _shelf): the shelves with a block whose box is not farther away than ``bound``, one copy of a query for each."""
    order = np.argsort(shelf, kind="stable")
    parts = Blocks(None, blocks.axes, blocks.ids[order], blocks.sizes[order], blocks.low[order], blocks.high[order])
    starts = np.flatnonzero(np.diff(shelf[order], prepend=-1))
    shared = queries.sparkSession.sparkContext.broadcast((parts, starts))

    def run(batches):
        b, at_shelf = shared.value
        step = max(1, 2_000_000 // max(1, len(b.ids)))
        for pdf in batches:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at : at + step]
                hit = b.bounds(_matrix(part["_c"])) <= part["bound"].to_numpy()[:, None]
                found = np.logical_or.reduceat(hit, at_shelf, axis=1)
                yield part.drop(columns="_c").assign(_shelves=[np.flatnonzero(row) for row in found])

    rows = with_coordinates(queries, blocks.axes).select("query_id", "features", "bound", "_c")
    made = rows.mapInPandas(run, f"query_id {kind}, features array<double>, bound double, _shelves array<long>")
    return made.select("query_id", "features", "bound", F.explode("_shelves").alias("_shelf"))


def _rows_of(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _first_k(which: np.ndarray, d: np.ndarray, ties: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of every value of ``which``, by ``d``, then ``ties``."""
    order = np.lexsort((ties, d, which))
    group = which[order]
    starts = np.flatnonzero(np.diff(group, prepend=-1))
    rank = np.arange(len(group)) - np.repeat(starts, np.diff(starts, append=len(group)))
    return order[rank < k]


def _search_shelf(q: np.ndarray, bound: np.ndarray, rows: np.ndarray, ties: np.ndarray, at: np.ndarray, box: Blocks, k: int):
    """(query, row, squared distance) of the k nearest of ``rows`` within ``bound`` of each query; ``at`` is every row's block.

    Queries with the same nearest block go in slices, which leave out blocks that none of them needs. Products of a slice with some rows
    at a time tell which rows are near enough, allowing for the rounding; only those are measured, and the best so far tighten the bound.
    """
    order = np.argsort(at, kind="stable")
    rows, ties = rows[order], ties[order]
    edges = np.searchsorted(at[order], np.arange(len(box.ids) + 1))
    p = q @ box.axes
    own = (q**2).sum(1)
    c = np.column_stack([p, np.sqrt(np.maximum(own - (p**2).sum(1), 0))])
    step = max(1, 2_000_000 // max(1, len(box.ids)))
    nearest = np.concatenate([box.bounds(c[i : i + step]).argmin(1) for i in range(0, len(q), step)])
    square = (rows**2).sum(1)
    slack = 1e-9 * (1 + own.max() + square.max())
    turn, found = np.argsort(nearest, kind="stable"), []
    for start in range(0, len(q), SLICE):
        some = turn[start : start + SLICE]
        hit = np.concatenate([(box.bounds(c[some[i : i + step]]) <= bound[some[i : i + step], None]).any(0, keepdims=True) for i in range(0, len(some), step)]).any(0)
        ranges = [np.arange(edges[b], edges[b + 1]) for b in np.flatnonzero(hit)]
        if not ranges:
            continue
        near = np.concatenate(ranges)
        x = q[some]
        # of |q - r|^2 <= t, the parts that depend on r: q r - |r|^2 / 2 >= (|q|^2 - t) / 2
        least = (own[some] - bound[some] ** 2 - slack) / 2
        kept_q, kept_r, kept_v = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
        for i in range(0, len(near), CHUNK):
            part = near[i : i + CHUNK]
            value = x @ rows[part].T - square[part] / 2
            a, b = np.nonzero(value >= least[:, None])
            kept_q, kept_r, kept_v = np.concatenate([kept_q, a]), np.concatenate([kept_r, part[b]]), np.concatenate([kept_v, value[a, b]])
            if len(kept_q) > 20 * k * len(some) or i + CHUNK >= len(near):
                best = _first_k(kept_q, -kept_v, kept_r, k)
                counts = np.bincount(kept_q[best], minlength=len(some))
                low = np.full(len(some), np.inf)
                np.minimum.at(low, kept_q[best], kept_v[best])
                least = np.where(counts >= k, np.maximum(least, low - slack), least)
                stay = kept_v >= least[kept_q]
                kept_q, kept_r, kept_v = kept_q[stay], kept_r[stay], kept_v[stay]
        exact = ((rows[kept_r] - x[kept_q]) ** 2).sum(1)
        best = _first_k(kept_q, exact, ties[kept_r], k)
        found.append((some[kept_q[best]], order[kept_r[best]], exact[best]))
    if not found:
        return np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
    return tuple(np.concatenate(part) for part in zip(*found))


def search_shelves(bounded: DataFrame, blocks: Blocks, k: int, kind: str, schema: str, width: int) -> DataFrame:
    """The k nearest rows within ``bound`` of every query, for each shelf of blocks it needs.

    A query is copied once for every shelf, not for every block, and a row once for every group of queries that asks for its shelf.
    """
    spark = bounded.sparkSession
    shelf = shelved(blocks, width, 2 * spark.sparkContext.defaultParallelism)
    asked = shelves_asked(stored(bounded, "knn-bounded"), blocks, shelf, kind)
    size = max(1, min(SHELF_CELLS // width, SHELF_ROWS))
    groups = {r["_shelf"]: r["n"] for r in asked.groupBy("_shelf").agg(F.ceil(F.count(F.lit(1)) / size).alias("n")).collect()}  # one row per shelf
    places = [(str(b), int(i), int(s), int(groups[s])) for i, (b, s) in enumerate(zip(blocks.ids, shelf)) if s in groups]
    dealt = spark.createDataFrame(places, "_block string, _at int, _shelf long, _groups long")  # one row per block
    left = asked.join(F.broadcast(dealt.select("_shelf", "_groups").distinct()), "_shelf")
    left = left.withColumn("_group", F.pmod(F.xxhash64("query_id", "features"), F.col("_groups"))).drop("_groups")
    right = blocks.rows.join(F.broadcast(dealt), "_block").withColumn("_group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_groups") - 1)))
    right = right.select("row_id", "label", "features", "_at", "_shelf", "_group")
    shared = spark.sparkContext.broadcast((blocks.axes, blocks.ids, blocks.sizes, blocks.low, blocks.high))
    names = ["query_id", "row_id", "label", "dist"]

    def meet(a: pa.Table, b: pa.Table) -> pa.Table:
        if a.num_rows == 0 or b.num_rows == 0:
            return pa.table({"query_id": a["query_id"][:0], "row_id": b["row_id"][:0], "label": b["label"][:0], "dist": pa.array([], pa.float64())})
        axes, ids, sizes, low, high = shared.value
        at, local = np.unique(b["_at"].to_numpy(), return_inverse=True)
        ties = np.unique(_ids(b["row_id"].to_pandas()), return_inverse=True)[1]
        box = Blocks(None, axes, ids[at], sizes[at], low[at], high[at])
        which, row, d = _search_shelf(_rows_of(a["features"]), a["bound"].to_numpy(), _rows_of(b["features"]), ties, local, box, k)
        return pa.table([pc.take(a["query_id"], pa.array(which)), pc.take(b["row_id"], pa.array(row)), pc.take(b["label"], pa.array(row)), pa.array(d)], names)

    return left.groupBy("_shelf", "_group").cogroup(right.groupBy("_shelf", "_group")).applyInArrow(meet, schema)


def k_nearest(
    queries: DataFrame, train: DataFrame, id_col: str, k: int, max_cells: int = MAX_BROADCAST_CELLS, block: int = BLOCK
) -> DataFrame:
    """(query_id, row_id, label, dist): the k nearest training rows of every query, exact; ids keep their type.

    Training sets are capped per class, so they usually fit a checked broadcast and each batch of queries is one
    matrix product. A larger set is cut into blocks of near rows (``cut_into_blocks``) and searched twice:

    * every query meets the nearest blocks that hold k rows; its k-th distance there is an upper bound;
    * it then meets every block whose box is not farther away than that. What is left out is proven to be farther. For this,
      neighbouring blocks are put together in shelves (``search_shelves``).

    So training rows stay where they are but for one copy per group of queries, and a query is copied to the shelves it needs. In
    data without any structure these may be all of them; the answer is exact in any case.

    Defined cases: without training rows there are no neighbours; with fewer than k all of them are; equal distances go by
    the row id; repeated rows count each.
    """
    kind = queries.schema[id_col].dataType.simpleString()
    schema = f"query_id {kind}, row_id {train.schema[id_col].dataType.simpleString()}, label int, dist double"
    wide = F.col("features").cast("array<double>").alias("features")
    train = train.select(F.col(id_col).alias("row_id"), F.col("label").cast("int").alias("label"), wide)
    queries = queries.select(F.col(id_col).alias("query_id"), wide)
    width = (train.select(F.size("features").alias("w")).head() or [0])[0]
    if width == 0:
        return queries.sparkSession.createDataFrame([], schema)
    limit = max_cells // width
    head = train.limit(limit + 1).toArrow()
    if head.num_rows <= limit:
        ids, labels, rows = _ids(head["row_id"].to_pandas()), head["label"].to_numpy(), _matrix(head["features"].to_pylist())
        shared = train.sparkSession.sparkContext.broadcast((ids, labels, rows))

        def scan(batches):
            for pdf in batches:
                yield _meet(pdf, *shared.value, k)

        return queries.mapInPandas(scan, schema)

    blocks = cut_into_blocks(train, width, block)
    first = search_blocks(blocks_asked(queries, blocks, k, kind), blocks, k, schema, block)
    ranked = Window.partitionBy("query_id").orderBy("dist", "row_id")
    # of queries that share an id, every one keeps its own bound: the largest k-th distance holds for all of them
    at_k = first.withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= k)
    bounds = at_k.groupBy("query_id").agg(F.max("dist").alias("d"), F.count(F.lit(1)).alias("n"))
    total = int(blocks.sizes.sum())
    bound = F.when(F.col("n") >= min(k, total), F.sqrt("d") * (1 + 1e-9) + 1e-9).otherwise(F.lit(float("inf"))).alias("bound")
    bounded = queries.join(bounds.select("query_id", bound), "query_id")
    met = search_shelves(bounded, blocks, k, kind, schema, width)
    return met.withColumn("_r", F.row_number().over(ranked)).where(F.col("_r") <= k).drop("_r")


def vote(neighbours: DataFrame) -> DataFrame:
    """Label most of the neighbours have; the smallest one when tied."""
    counts = neighbours.groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("label").alias("l")))
    return counts.groupBy("query_id").agg(best["l"].alias("predicted"))


def knn_predict(queries: DataFrame, train: DataFrame, id_col: str, k: int = 5, **sizes) -> DataFrame:
    found = vote(k_nearest(queries, train, id_col, k, **sizes)).withColumnRenamed("query_id", id_col)
    return queries.join(found, id_col)
