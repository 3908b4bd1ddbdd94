"""Trees grown in tasks, against a plain version and against Spark ML's forests."""

import numpy as np
import pytest
from pyspark.ml import classification as C
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sigspark.config import Settings
from sigspark.operators import models, trees


def gini(c):
    return 1 - (c**2).sum() / c.sum() ** 2


def plain_importance(x, y, w, k, max_depth):
    """Importances of the features not normalised, by recursion, all features at every node."""
    sums = np.zeros(x.shape[1])
    counts = lambda y, w: np.bincount(y, w, k)

    def grow(x, y, w, depth):
        """(leaf, class)"""
        c = counts(y, w)
        best = (1e-12, None, None)
        for f in range(x.shape[1]) if depth < max_depth and gini(c) > 1e-15 else []:
            for b in np.unique(x[:, f])[:-1]:
                at = x[:, f] <= b
                l, r = counts(y[at], w[at]), counts(y[~at], w[~at])
                gain = gini(c) - (l.sum() * gini(l) + r.sum() * gini(r)) / c.sum()
                if gain > best[0] + 1e-12:
                    best = (gain, f, b)
        gain, f, b = best
        if f is None:
            return True, c.argmax()
        at = x[:, f] <= b
        left, right = grow(x[at], y[at], w[at], depth + 1), grow(x[~at], y[~at], w[~at], depth + 1)
        if left[0] and right[0] and left[1] == right[1]:
            return True, left[1]
        sums[f] += gain * c.sum()
        return False, None

    grow(x, y, w, 0)
    return sums


@pytest.mark.parametrize("max_depth,node_rows,weighted", [(30, 10**6, False), (30, 20, False), (3, 10**6, False), (30, 10**6, True)])
def test_a_tree_against_a_plain_one(monkeypatch, max_depth, node_rows, weighted):
    monkeypatch.setattr(trees, "NODE_ROWS", node_rows)
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 8, (150, 1)).astype(np.uint8), rng.integers(0, 3, 150)
    weights = rng.uniform(0.5, 2, 150) if weighted else np.ones(150)
    got = trees.tree_importance(np.repeat(x, 3, axis=1), y, weights, 8, 3, max_depth, np.random.default_rng(4))
    assert got == pytest.approx([1, 0, 0])  # of equal gains the first feature's
    two = np.concatenate([x, rng.integers(0, 8, (150, 1)).astype(np.uint8)], axis=1)
    drawn = np.random.default_rng(5).poisson(1.0, 150) * weights
    kept = drawn > 0
    want = plain_importance(two[kept], y[kept], drawn[kept], 3, max_depth)
    got = trees.tree_importance(two, y, weights, 8, 2, max_depth, np.random.default_rng(5))
    assert got == pytest.approx(want / want.sum(), abs=1e-9)


def labelled(spark, n=700, width=9):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, width))
    x[:, 3] = rng.integers(0, 4, n)
    x[:, 5] = 1.0
    y = (x[:, 0] + 0.5 * x[:, 1] + 0.5 * rng.normal(size=n) > 0).astype(int) + (x[:, 3] > 2)
    rows = spark.createDataFrame([(v.tolist(), float(c)) for v, c in zip(x, y)], "features array<double>, code double")
    return x, rows.select(array_to_vector("features").alias("features"), "code", F.lit(1.0).alias("weight"))


def test_large_forests_have_the_importances_of_spark_ml(spark, monkeypatch):
    _, rows = labelled(spark)
    forest, names = models.random_forest(Settings(forest_trees=150), 9, 3), list("abcdefghi")
    want = {r.feature: r for r in models.fitted_importance(forest, rows, names).collect()}

    def none(*_):
        raise AssertionError("a job for every group of nodes")

    monkeypatch.setattr(models, "GROWN_APART", 0)
    monkeypatch.setattr(C.RandomForestClassifier, "fit", none)
    got = {r.feature: r for r in models.fitted_importance(forest, rows, names).collect()}
    assert got.keys() == want.keys() and sum(r.importance for r in got.values()) == pytest.approx(1)
    for f in names:
        assert got[f].importance == pytest.approx(want[f].importance, abs=0.02)
        assert got[f].std == pytest.approx(want[f].std, abs=0.03)
    assert got["f"].importance == 0
    again = models.fitted_importance(forest, rows.repartition(3), names).collect()
    assert {r.feature: r for r in again} == got


def test_features_of_nodes_are_drawn_alike():
    drawn = trees._drawn(20_000, 9, 3, np.random.default_rng(1))
    assert all(len(set(d)) == 3 for d in drawn.tolist()[:200])
    assert np.abs(np.bincount(drawn.ravel(), minlength=9) / 20_000 - 1 / 3).max() < 0.02
    assert trees._drawn(5, 2, 3, np.random.default_rng(1)).tolist() == [[0, 1]] * 5


def test_cuts_and_bins(spark):
    x, rows = labelled(spark)
    from pyspark.ml.functions import vector_to_array

    plain = rows.select(vector_to_array("features").alias("features"), "code", "weight")
    cuts = trees.cut_points(plain.repartition(4), 9, 32)
    assert cuts[3].tolist() == [0.5, 1.5, 2.5] and cuts[5].tolist() == [] and len(cuts[0]) == 31
    bins, codes, weights = trees.binned(plain, cuts)
    assert bins.shape == (700, 9) and (bins[:, 5] == 0).all() and (weights == 1).all()
    counts = np.bincount(bins[:, 0], minlength=32)
    assert counts.min() > 10 and counts.max() < 40
    assert sorted(bins[:, 3].tolist()) == sorted(x[:, 3].astype(int).tolist())
    bad = spark.createDataFrame([([1.0, float("nan")], 0.0, 1.0)], "features array<double>, code double, weight double")
    with pytest.raises(Exception, match="without null"):
        trees.binned(bad, [np.zeros(1), np.zeros(1)])
