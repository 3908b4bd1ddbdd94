"""k nearest rows through blocks, against brute force; text ids; models that take weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigspark.config import Settings
from sigspark.operators import models, neighbours


def frame(spark, ids, labels, x, kind="string"):
    rows = [(i, int(y), v.tolist()) for i, y, v in zip(ids, labels, x)]
    return spark.createDataFrame(rows, f"id {kind}, label int, features array<double>")


def brute(q, q_ids, x, ids, k):
    out = set()
    for v, i in zip(q, q_ids):
        d = ((x - v) ** 2).sum(1)
        out |= {(i, ids[j]) for j in np.lexsort((np.array(ids), d))[:k]}
    return out


def clusters(seed, n, width, copies=0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 20, (8, width))
    x = centers[rng.integers(0, 8, n)] + rng.normal(size=(n, width)) * rng.uniform(0.1, 2, width)
    x[:copies] = x[0]
    return x, rng.integers(0, 3, n)


@pytest.mark.parametrize("copies,k", [(0, 5), (150, 5), (0, 1), (0, 700)])
def test_blocks_against_brute_force(spark, copies, k):
    x, y = clusters(1, 600, 9, copies)
    q, _ = clusters(2, 40, 9)
    q[0], q[1] = x[0], 1e3
    ids, q_ids = [f"/clips/é{i:04d}.wav" for i in range(600)], [f"q{i}" for i in range(40)]
    got = neighbours.k_nearest(frame(spark, q_ids, y, q), frame(spark, ids, y, x), "id", k, max_cells=0, block=40).collect()
    assert {(r.query_id, r.row_id) for r in got} == brute(q, q_ids, x, ids, k)
    assert len(got) == 40 * min(k, 600)
    d = {(r.query_id, r.row_id): r.dist for r in got}
    assert d[("q0", ids[0])] == 0


def test_far_blocks_are_left_out(spark):
    x, y = clusters(3, 2000, 6)
    train, ids = frame(spark, [str(i) for i in range(2000)], y, x), [str(i) for i in range(100)]
    blocks = neighbours.cut_into_blocks(train.withColumnRenamed("id", "row_id"), 6, block=100)
    assert blocks.sizes.sum() == 2000 and len(blocks.ids) >= 10
    queries = frame(spark, ids, y[:100], x[:100]).withColumnRenamed("id", "query_id").drop("label")
    near = neighbours.blocks_asked(queries.withColumn("bound", F.lit(2.0)), blocks, 5, "string")
    assert near.count() < 100 * len(blocks.ids) / 3
    assert neighbours.blocks_asked(queries, blocks, 5, "string").count() < 100 * 3


def test_bounds_never_exceed_distances(spark):
    x, y = clusters(4, 300, 12)
    blocks = neighbours.cut_into_blocks(frame(spark, range(300), y, x, "long").withColumnRenamed("id", "row_id"), 12, block=20)
    rows = blocks.rows.toPandas()
    q = np.random.default_rng(5).normal(0, 15, (50, 12))
    coordinates = np.column_stack([q @ blocks.axes, np.sqrt(np.maximum((q**2).sum(1) - ((q @ blocks.axes) ** 2).sum(1), 0))])
    low = blocks.bounds(coordinates)
    for j, block in enumerate(blocks.ids):
        members = np.array(rows[rows["_block"] == block]["features"].tolist())
        assert (low[:, j] <= np.sqrt(((q[:, None, :] - members[None]) ** 2).sum(2)).min(1) + 1e-9).all()


def test_one_hot_block_is_met_in_groups(spark):
    x = np.ones((50, 3))
    ids = [f"{i:02d}" for i in range(50)]
    got = neighbours.k_nearest(frame(spark, ids, [0] * 50, x), frame(spark, ids, [0] * 50, x), "id", 3, max_cells=0, block=10).collect()
    assert {(r.query_id, r.row_id) for r in got} == {(q, r) for q in ids for r in ids[:3]}


@pytest.mark.parametrize("how", [{}, {"max_cells": 0, "block": 2}])
def test_few_rows(spark, how):
    none = frame(spark, [], [], np.zeros((0, 2)))
    one = frame(spark, ["a"], [1], np.array([[1.0, 2.0]]))
    assert neighbours.k_nearest(one, none, "id", 5, **how).collect() == []
    assert neighbours.k_nearest(none, one, "id", 5, **how).collect() == []
    assert [tuple(r) for r in neighbours.k_nearest(one, one, "id", 5, **how).collect()] == [("a", "a", 1, 0.0)]


def prepared(spark):
    """Two overlapping classes of 300 and 30 rows."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1, (300, 2)), rng.normal(1.0, 1, (30, 2))])
    rows = [(f"c{i}", "a" if i < 300 else "b", int(i >= 300), v.tolist(), "train") for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id string, label string, code int, features array<double>, split string")


@pytest.mark.parametrize("key", ["gb", "svc"])
def test_weights_change_the_fit(spark, key):
    rows, few = prepared(spark), Settings(boost_rounds=3, impute_rounds=1)
    found = []
    for weighted in (False, True):
        made = models.train(rows, "id", key, few, weighted)
        found.append(made.score(rows, "id").where("predicted = 'b'").count())
    assert found[1] > 2 * found[0] and found[1] > 40


def test_knn_model_on_text_ids_survives_writing(spark, tmp_path):
    rows = prepared(spark)
    made = models.train(rows, "id", "knn", Settings(impute_rounds=1))
    made.write(spark, str(tmp_path / "m"))
    read = models.Trained.read(spark, str(tmp_path / "m"))
    names = lambda m: {r.id: r.predicted for r in m.score(rows, "id").collect()}
    assert names(made) == names(read) and len(names(made)) == 330


def test_pairs_come_in_bounded_batches(monkeypatch):
    """Queries that ask for all blocks: no batch holds more than PAIR_CELLS numbers, no pair is lost."""
    import pandas as pd

    monkeypatch.setattr(neighbours, "PAIR_CELLS", 100)
    queries = pd.DataFrame({"query_id": range(30), "features": [np.full(7, float(i)) for i in range(30)]})
    hit = np.random.default_rng(1).uniform(size=(30, 40)) < 0.9
    made = list(neighbours._pairs(queries, hit, np.array([f"b{i}" for i in range(40)]), 7))
    assert max(len(m) for m in made) * 7 <= 100
    rows = [r for m in made for r in zip(m["query_id"], m["_block"], m["features"])]
    assert sorted((q, b) for q, b, _ in rows) == sorted((q, f"b{i}") for q, i in zip(*map(np.ndarray.tolist, np.nonzero(hit))))
    assert all((f == q).all() for q, _, f in rows)


def test_queries_are_copied_per_shelf_not_per_block(spark, monkeypatch):
    """Rows without structure, so that every query needs every block: what is written does not grow with the blocks."""
    rng = np.random.default_rng(9)
    x, q = rng.normal(size=(900, 16)), rng.normal(size=(70, 16))
    ids, q_ids = [f"r{i:03d}" for i in range(900)], [f"q{i}" for i in range(70)]
    written, keep = {}, neighbours.stored

    def counted(df, name):
        out = keep(df, name)
        written[name] = written.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(neighbours, "stored", counted)
    got = neighbours.k_nearest(frame(spark, q_ids, [0] * 70, q), frame(spark, ids, [0] * 900, x), "id", 5, max_cells=0, block=20).collect()
    assert {(r.query_id, r.row_id) for r in got} == brute(q, q_ids, x, ids, 5) and len(got) == 350
    assert sum(n for name, n in written.items() if name != "knn-blocks") <= 3 * 70


def test_shelves_hold_whole_blocks_within_their_size(monkeypatch):
    monkeypatch.setattr(neighbours, "SHELF_CELLS", 1000)
    sizes = np.array([30, 5, 40, 20, 40, 10, 40, 15])
    blocks = neighbours.Blocks(None, None, np.array(["0/0", "0/1", "1/0", "10/0", "2/0", "3/0", "4/0", "9/0"]), sizes, None, None)
    shelf = neighbours.shelved(blocks, 10, 1)
    held = np.bincount(shelf, sizes)
    assert len(held) > 1 and (held > 0).all() and held.max() < 100 + sizes.max()
    assert (np.diff(shelf[[0, 1, 2, 4, 5, 6, 7, 3]]) >= 0).all()  # cell 10 comes last


@pytest.mark.parametrize("bound", [np.inf, 3.0])
def test_a_shelf_gives_the_nearest_of_its_rows(monkeypatch, bound):
    """In small slices and chunks, with equal distances and repeated rows."""
    monkeypatch.setattr(neighbours, "SLICE", 7)
    monkeypatch.setattr(neighbours, "CHUNK", 11)
    rng = np.random.default_rng(10)
    rows, q = rng.integers(0, 3, (200, 4)).astype(float), rng.integers(0, 3, (30, 4)).astype(float)
    at, ties, axes = rng.integers(0, 6, 200), rng.permutation(200), np.eye(4)[:, :2]
    c = np.column_stack([rows @ axes, np.sqrt((rows[:, 2:] ** 2).sum(1))])
    low, high = (np.array([f(c[at == b], axis=0) for b in range(6)]) for f in (np.min, np.max))
    box = neighbours.Blocks(None, axes, np.arange(6), np.bincount(at), low, high)
    which, row, d = neighbours._search_shelf(q, np.full(30, bound), rows, ties, at, box, 5)
    away = ((rows[None] - q[:, None]) ** 2).sum(2)
    for i in range(30):
        want = np.lexsort((ties, away[i]))[:5]
        assert row[which == i].tolist() == want.tolist() and d[which == i].tolist() == away[i][want].tolist()
