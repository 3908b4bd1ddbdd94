"""NN-descent in parts: what is written, graphs, searches."""

import numpy as np
import pytest

from sigspark.llm import neighbours


def unit_rows(seed, n, width=16):
    x = np.random.default_rng(seed).normal(size=(n, width)).astype(np.float32).astype(float)
    return x / np.linalg.norm(x, axis=1)[:, None]


def table(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")


def test_parts_give_the_nearest_of_all_and_are_written_once(spark, monkeypatch):
    """Rounds and beams write nothing: every table is written once, whatever the number of parts."""
    monkeypatch.setattr(neighbours, "PART", 300)
    x, written, keep = unit_rows(1, 1500), [], neighbours.stored
    monkeypatch.setattr(neighbours, "stored", lambda df, name: written.append(name) or keep(df, name))
    rows = table(spark, x)
    got = neighbours.nearest(rows, rows.filter("vec_id % 50 = 0")).collect()
    assert len(written) == len(set(written)) <= 7
    hits = 0
    for q in range(0, 1500, 50):
        near = x @ x[q]
        near[q] = -2
        found = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in found] == [1, 2, 3, 4, 5]
        hits += len({r.vec_id for r in found} & set(np.argsort(-near)[:5].tolist()))
    assert hits >= 0.98 * 5 * 30


def test_vectors_cross_no_round(spark):
    """The graph is made in one pass over the nodes: a row per node, links within its part."""
    x = unit_rows(2, 700)
    nodes = neighbours.nodes_of(neighbours.usable(table(spark, x)))
    rows = neighbours.build(nodes).collect()
    assert sorted(r["node"] for r in rows) == list(range(700))
    for r in rows:
        places = np.frombuffer(r["links"], np.int32)
        assert len(set(places.tolist())) == len(places) >= 10 and places.max() < sum(o["part"] == r["part"] for o in rows)


def test_lists_keep_the_nearest_that_were_met():
    x = unit_rows(3, 60)
    lists = neighbours.Lists(x)
    rng = np.random.default_rng(4)
    met = {i: {} for i in range(60)}
    for _ in range(4):
        a, b = rng.integers(0, 60, 700), rng.integers(0, 60, 700)
        a, b = a[a != b], b[a != b]
        lists.enter(a, b, np.einsum("ij,ij->i", x[a], x[b]))
        for i, j in zip(a.tolist(), b.tolist()):
            met[i][j] = float(x[i] @ x[j])
    for i in range(60):
        want = sorted(met[i], key=lambda j: -met[i][j])[: neighbours.DEGREE]
        assert lists.other[i][lists.other[i] >= 0].tolist() == want


@pytest.mark.parametrize("n", [1, 2, 9, 400])
def test_graph_and_search_of_a_part(n):
    x = unit_rows(5, n)
    links = neighbours.linked(x, 9, np.random.default_rng(6))
    near = x @ x.T
    np.fill_diagonal(near, -2)
    if n == 400:
        top = np.argsort(-near, axis=1)[:, :10]
        assert np.mean([np.isin(t, row).mean() for t, row in zip(top, links)]) > 0.9
    assert all(i not in row for i, row in enumerate(links.tolist()))
    for own in (np.arange(n), np.full(n, -1)):
        query, node, score = neighbours.greedy(x, links, x, own, 60, np.random.default_rng(7))
        for i in range(0, n, 7):
            held = dict(zip(node[query == i].tolist(), score[query == i].tolist()))
            assert len(held) == (query == i).sum() >= min(n, neighbours.KEEP)
            assert i in held and held[i] == pytest.approx(2 if own[i] >= 0 else 1)
            assert len(set(np.argsort(-near[i])[:5].tolist()) & held.keys()) >= min(4, n - 1)
