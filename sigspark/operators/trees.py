"""Importances of large forests: whole trees grown side by side, each one by a task.

Spark ML grows all trees of a forest node group by node group, a job over all rows for each group: a forest of millions of nodes takes
thousands of jobs. Rows matter to a tree only by the bins of their features, a byte each, so a table of many rows fits a
checked broadcast. A task then grows its trees alone, level by level, by the rules of Spark ML: Poisson bootstrap, a reservoir
of features for each node, gini gain between bins, leaves that predict the same merged with their parent. Bins are cut at quantiles
of all rows. The rows are put in an order of their own first, so a repeated task and a repeated run give the same trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a broadcast table; larger tables are Spark ML's.
MAX_CELLS = 64_000_000
#: Rows of the nodes that are split at once.
NODE_ROWS = 200_000


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if column.null_count or len(flat) != width * len(column) or not np.isfinite(flat).all():
        raise ValueError("features must be vectors of one length without null, NaN or infinite values")
    return flat.reshape(-1, width)


def cut_points(rows: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Thresholds of every feature of ``rows`` (features array<double>): between all values of a feature that has at most ``bins``, else quantiles."""

    def few(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.zeros(0)] * width
        for batch in batches:
            x = _matrix(batch.column("features"), width)
            # one value too many is kept, to tell that there are too many
            seen = [s if len(s) > bins else np.union1d(s, x[:, i])[: bins + 1] for i, s in enumerate(seen)]
        at = np.repeat(np.arange(width), [len(s) for s in seen])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(np.concatenate(seen), pa.float64())], ["idx", "v"])

    values = rows.select("features").mapInArrow(few, "idx int, v double").groupBy("idx").agg(F.sort_array(F.collect_set("v")).alias("v"))
    shares = [j / bins for j in range(1, bins)]
    cells = rows.select(F.posexplode("features").alias("idx", "v"))
    quantiles = cells.groupBy("idx").agg(F.percentile_approx("v", shares, 10_000).alias("q"))
    cuts = [np.zeros(0)] * width
    for r in quantiles.join(values, "idx").collect():  # one row per feature
        v = np.unique(r["v"])
        cuts[r["idx"]] = (v[1:] + v[:-1]) / 2 if len(v) <= bins else np.unique(r["q"])
    return cuts


def binned(rows: DataFrame, cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins (rows x features), codes and weights of (features array<double>, code, weight), in an order that the rows alone decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("features"), len(cuts))
                made = np.column_stack([np.searchsorted(c, x[:, i]) for i, c in enumerate(cuts)]).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([pa.array([m.tobytes() for m in made], pa.binary()), *batch.columns[1:]], ["bins", "code", "weight"])

    found = rows.mapInArrow(run, "bins binary, code double, weight double").toArrow()
    bins = np.frombuffer(b"".join(found["bins"].to_pylist()), np.uint8).reshape(found.num_rows, -1)
    codes, weights = found["code"].to_numpy(), found["weight"].to_numpy()
    if not ((codes >= 0) & (codes == np.floor(codes))).all() or not (weights >= 0).all():
        raise ValueError("codes must be whole numbers from 0, weights not below 0")
    whole = np.concatenate([bins, codes.reshape(-1, 1).view(np.uint8), weights.reshape(-1, 1).view(np.uint8)], axis=1)
    order = np.argsort(np.ascontiguousarray(whole).view(f"S{whole.shape[1]}").ravel(), kind="stable")
    return bins[order], codes[order].astype("int64"), weights[order]


def _drawn(nodes: int, width: int, n_features: int, rng: np.random.Generator) -> np.ndarray:
    """Features of every node, by a reservoir: as in Spark ML, the order they end in decides between equal gains."""
    out = np.tile(np.arange(min(n_features, width)), (nodes, 1))
    for f in range(n_features, width):
        place = (rng.random(nodes) * (f + 1)).astype("int64")
        at = np.flatnonzero(place < n_features)
        out[at, place[at]] = f
    return out


def _best_splits(bins: np.ndarray, node: np.ndarray, code: np.ndarray, weight: np.ndarray, totals: np.ndarray, n_bins: int):
    """(gain, slot, last bin of the left side, counts of the left side) of the best split of every node, the first of equal ones.

    ``bins`` has a column per random feature of the row's node; rows are sorted by node.
    """
    m, k = totals.shape
    size = totals.sum(1)
    alone = (totals**2).sum(1) / size
    gain, slot, cut, left = np.zeros(m), np.zeros(m, "int64"), np.zeros(m, "int64"), np.zeros((m, k))
    for j in range(bins.shape[1]):
        key = node * n_bins + bins[:, j]
        if m * n_bins <= 1.2 * len(node):
            counts = np.bincount(key * k + code, weight, m * n_bins * k).reshape(m, n_bins, k).cumsum(1).reshape(-1, k)
            of, at, starts = np.repeat(np.arange(m), n_bins), np.tile(np.arange(n_bins), m), np.arange(0, m * n_bins, n_bins)
        else:
            order = np.argsort(key)
            key = key[order]
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            group = np.cumsum(fresh) - 1
            of, at = np.divmod(key[fresh], n_bins)
            starts = np.searchsorted(of, np.arange(m))
            counts = np.bincount(group * k + code[order], weight[order], len(of) * k).reshape(-1, k).cumsum(0)
            before = counts[starts - 1]
            before[0] = 0
            counts -= before[of]
        n_left = counts.sum(1)
        n_right = size[of] - n_left
        own = np.einsum("ij,ij->i", counts, counts)
        both = np.einsum("ij,ij->i", totals[of], counts)
        other = (alone * size)[of] - 2 * both + own
        able = (n_left > 0) & (n_right > 1e-9 * size[of])
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(able, own / n_left + other / n_right, -1.0)
        best = np.maximum.reduceat(score, starts)
        made = (best - alone) / size
        better = made > gain + 1e-14
        if better.any():
            first = np.flatnonzero(score == best[of])
            place = np.zeros(m, "int64")
            place[of[first][::-1]] = first[::-1]
            place = place[better]
            gain[better], slot[better], cut[better], left[better] = made[better], j, at[place], counts[place]
    return gain, slot, cut, left


def tree_importance(
    bins: np.ndarray, codes: np.ndarray, weights: np.ndarray, n_bins: int, n_features: int, max_depth: int, rng: np.random.Generator
) -> np.ndarray:
    """Importance of each feature in one tree over a bootstrap of the rows; they add up to 1, or are all 0 without a split."""
    width, k = bins.shape[1], int(codes.max(initial=0)) + 1
    weight = rng.poisson(1.0, len(codes)) * weights
    row = np.flatnonzero(weight > 0)
    weight, code, node = weight[row], codes[row], np.zeros(len(row), "int64")
    levels = []
    m = 1 if len(row) else 0
    while m and len(levels) < max_depth:
        totals = np.bincount(node * k + code, weight, m * k).reshape(m, k)
        ends = np.searchsorted(node, np.arange(m + 1))
        gain, feature, cut, left = np.zeros(m), np.zeros(m, "int64"), np.zeros(m, "int64"), np.zeros((m, k))
        first = 0
        while first < m:
            last = max(first + 1, int(np.searchsorted(ends, ends[first] + NODE_ROWS, "right")) - 1)
            some, part = slice(first, last), slice(ends[first], ends[last])
            drawn = _drawn(last - first, width, n_features, rng)
            local = node[part] - first
            asked = bins[row[part, None], drawn[local]]
            gain[some], slot, cut[some], left[some] = _best_splits(asked, local, code[part], weight[part], totals[some], n_bins)
            feature[some] = drawn[np.arange(last - first), slot]
            first = last
        split = gain > 0
        sides = np.stack([left, totals - left], axis=1)
        n_side = np.where(split[:, None], sides.sum(2), 1.0)
        impure = 1 - (sides**2).sum(2) / n_side**2 >= 2.0**-52
        more = split[:, None] & impure & (len(levels) + 1 < max_depth)
        below = np.where(more, np.cumsum(more).reshape(m, 2) - 1, -1)
        levels.append((split, feature, gain * totals.sum(1), totals.argmax(1), sides.argmax(2), below))
        right = bins[row, feature[node]] > cut[node]
        child = below[node, right.astype("int64")]
        stay = np.flatnonzero(child >= 0)
        stay = stay[np.argsort(child[stay], kind="stable")]
        row, weight, code, node, m = row[stay], weight[stay], code[stay], child[stay], int(more.sum())
    # from the leaves up: a node whose children are leaves of one class is a leaf
    sums = np.zeros(width)
    leaf_below, class_below = np.zeros(0, bool), np.zeros(0, "int64")
    for split, feature, worth, own, classes, below in reversed(levels):
        leaf, found = below < 0, classes.copy()
        inner = ~leaf
        leaf[inner], found[inner] = leaf_below[below[inner]], class_below[below[inner]]
        merged = split & leaf.all(1) & (found[:, 0] == found[:, 1])
        stays = split & ~merged
        sums += np.bincount(feature[stays], worth[stays], width)
        leaf_below, class_below = ~stays, np.where(merged, found[:, 0], own)
    total = sums.sum()
    return sums / total if total > 0 else sums


def tree_importances(forest: RandomForestClassifier, rows: DataFrame, n_rows: int) -> np.ndarray | None:
    """Importances of every tree (trees x features) of ``forest`` over ``rows``; None where the rows or the settings are not for this module."""
    features, label, weight = forest.getFeaturesCol(), forest.getLabelCol(), F.lit(1.0)
    if forest.isDefined("weightCol") and forest.getWeightCol():
        weight = F.col(forest.getWeightCol()).cast("double")
    plain = rows.select(vector_to_array(features).alias("features"), F.col(label).cast("double").alias("code"), weight.alias("weight"))
    head = plain.select(F.size("features").alias("n")).head()
    width, n_bins = head["n"] if head else 0, min(forest.getMaxBins(), n_rows)
    able = (
        forest.getFeatureSubsetStrategy() == "sqrt" and forest.getImpurity() == "gini" and forest.getBootstrap() and forest.getSubsamplingRate() == 1.0
        and forest.getMinInstancesPerNode() == 1 and forest.getMinInfoGain() == 0.0 and forest.getMinWeightFractionPerNode() == 0.0
    )
    if not able or width <= 0 or not 2 <= n_bins <= 256 or n_rows * width > MAX_CELLS:
        return None
    spark, seed, depth = rows.sparkSession, forest.getSeed(), forest.getMaxDepth()
    kept = plain.persist()
    shared = spark.sparkContext.broadcast(binned(kept, cut_points(kept, width, n_bins)))
    kept.unpersist()

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column("id").to_pylist():
                found = tree_importance(*shared.value, n_bins, math.ceil(math.sqrt(width)), depth, np.random.default_rng([seed % 2**63, tree]))
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int64()), pa.array([found.tolist()], pa.list_(pa.float64()))], ["tree", "found"])

    n_trees = forest.getNumTrees()
    tasks = min(n_trees, 8 * spark.sparkContext.defaultParallelism)
    made = spark.range(0, n_trees, 1, tasks).mapInArrow(grow, "tree long, found array<double>").collect()  # a row of importances per tree
    shared.destroy()
    return np.array([r["found"] for r in sorted(made, key=lambda r: r["tree"])])
