"""Approximate nearest neighbours: NN-descent graphs, searched greedily.

Equal vectors are one node (named by its least vec_id, with the least KEEP ids of its copies), so copies cost nothing and crowd nothing out.

Parts. Nodes are dealt into parts by hash, at most about PART of them in each: a part's vectors and graph fit a task. So a vector moves
once, whatever the rounds, and a part's recall doesn't depend on the size of the table.

Building. In each part, nodes meet at random in small groups, which gives each node its first
DEGREE neighbours. Then, round by round, the neighbours of every node (both
directions, at most SAMPLE new and SAMPLE old ones, picked at random) meet each other: a neighbour's neighbour that is nearer than the
worst of a node's list enters it. Vectors are 32-bit floats, compared in double precision. Rounds end when less than SETTLED
of the lists change.

Searching. Every query searches every part. Its beam holds the nearest nodes seen, at first the best of some random ones and, in the part
that holds the query, its own node; each step opens the nearest nodes of the beam that weren't, and meets their neighbours. It ends when
the ``beam`` nearest nodes are all open. The nearest nodes of TRIED queries, found by
comparing them with every node, tell the recall; while it is below WANTED, the
beam doubles, until it could hold a whole part. Then all queries search with that beam. All nodes that are
within ERROR of the KEEP-th best are scored exactly, by cosine in double precision on the original vectors.

Graphs and answers are written to the shared folder; random choices come from the nodes' ids.

Defined cases: vectors that are null, empty or zero, or hold null or non-finite
components, take no part, neither do those whose length isn't the most frequent
one (the smaller of equally frequent ones) nor rows without vec_id; ties go to the smaller vec_id;
rows with a query's own vec_id aren't its candidates; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigspark.llm.common import small_batches
from sigspark.session import stored

NEAREST = 5
KEEP = NEAREST + 1
DEGREE, SAMPLE, REVERSE = 20, 24, 64
BEST_OF_GROUP = 6
ROUNDS, SETTLED = 9, 0.08
BEAM = 320
#: Nodes of a part at most, and at least where there are tasks to spare; queries that search a part in one task.
PART, SMALL_PART, ASKING = 20_000, 4_000, 50_000
#: Above what 32-bit components change in a difference of two cosines.
ERROR = 1e-6
#: Nodes whose neighbours meet at once, and numbers of a table of queries x nodes.
MEET_AT_ONCE, CELLS = 2_000, 8_000_000
#: Queries that are compared with every node, and the recall their beams must reach.
TRIED, WANTED = 128, 0.93
#: Meetings and size of the random groups that the first lists come from.
MEETINGS, MEETING = 5, 8


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array<double>) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).filter(finite & F.exists("vector", lambda x: x != 0))
    width = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").head()
    return rows.filter(F.size("vector") == (width["n"] if width else 0))


def small(values: np.ndarray) -> np.ndarray:
    """32-bit versions of the rows of a matrix: direction only."""
    return (values / np.abs(values).max(axis=1, keepdims=True)).astype(np.float32)


def unit(data: list[bytes]) -> np.ndarray:
    """Unit vectors from 32-bit ones."""
    x = np.frombuffer(b"".join(data), np.float32).reshape(len(data), -1).astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nodes_of(rows: DataFrame) -> DataFrame:
    """node, ids (least KEEP), vector, code (32-bit); a row per distinct vector.

    Copies are counted down in two steps, the first one salted by row count, so
    that no group grows with the number of copies.
    """
    salts = max(1, rows.count() // 100_000)
    least = lambda c: F.slice(F.array_sort(c), 1, KEEP)
    part = rows.groupBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(salts)).alias("salt")).agg(least(F.collect_list("vec_id")).alias("ids"))
    whole = part.groupBy("vector").agg(least(F.flatten(F.collect_list("ids"))).alias("ids"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
                codes = small(flat.reshape(batch.num_rows, -1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary())], ["node", "ids", "vector", "code"])

    return whole.select(F.element_at("ids", 1).alias("node"), "ids", "vector").mapInArrow(encode, "node long, ids array<long>, vector array<double>, code binary")


def first_of(rows: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every key; cut down before the shuffle, too."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("__r") <= n).drop("__r")


def _ranks(key: np.ndarray) -> np.ndarray:
    """Place of every element among the equal ones of a sorted array."""
    starts = np.flatnonzero(np.diff(key, prepend=key[:1] - 1))
    return np.arange(len(key)) - np.repeat(starts, np.diff(starts, append=len(key)))


class Lists:
    """The DEGREE nearest nodes that each node of a part has met so far, nearest first; -1 is none."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.x, self.other = x, np.full((n, DEGREE), -1, "int64")
        self.near, self.fresh = np.full((n, DEGREE), -2.0), np.zeros((n, DEGREE), bool)

    def enter(self, node: np.ndarray, other: np.ndarray, near: np.ndarray) -> None:
        """Nodes ``other`` that ``node`` has met; pairs may come again."""
        n = len(self.x)
        touched = np.unique(node)
        old = self.other[touched].ravel()
        owner, held = np.repeat(touched, DEGREE), old >= 0
        # a pair that is already listed stays as it is: its first place counts
        key = np.concatenate([owner[held] * n + old[held], node * n + other])
        near = np.concatenate([self.near[touched].ravel()[held], near])
        fresh = np.concatenate([self.fresh[touched].ravel()[held], np.ones(len(node), bool)])
        key, at = np.unique(key, return_index=True)
        node, other = np.divmod(key, n)
        order = np.lexsort((other, -near[at], node))
        rank = _ranks(node[order])
        order, rank = order[rank < DEGREE], rank[rank < DEGREE]
        self.other[touched], self.near[touched], self.fresh[touched] = -1, -2.0, False
        to = (node[order], rank)
        self.other[to], self.near[to], self.fresh[to] = other[order], near[at][order], fresh[at][order]

    def both_ways(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(node, other, near, fresh) of all links, and again from their other end."""
        node, other = np.repeat(np.arange(len(self.x)), DEGREE), self.other.ravel()
        held = other >= 0
        node, other, near, fresh = node[held], other[held], self.near.ravel()[held], self.fresh.ravel()[held]
        return np.concatenate([node, other]), np.concatenate([other, node]), np.tile(near, 2), np.tile(fresh, 2)

    def meet_at_random(self, rng: np.random.Generator) -> None:
        n = len(self.x)
        for _ in range(MEETINGS):
            dealt = np.full(-(-n // MEETING) * MEETING, -1)
            dealt[:n] = rng.permutation(n)
            self._meet(dealt.reshape(-1, MEETING), MEETING)

    def meet_neighbours(self, rng: np.random.Generator) -> int:
        """One round; the number of links that are new."""
        n = len(self.x)
        node, other, _, fresh = self.both_ways()
        key = np.sort((node * n + other) * 2 + ~fresh)  # new before old
        key = key[np.diff(key >> 1, prepend=-1) != 0]
        old, (node, other) = key & 1, np.divmod(key >> 1, n)
        kind = node * 2 + old
        order = np.lexsort((rng.random(len(kind)), kind))
        rank = _ranks(kind[order])
        some = order[rank < SAMPLE]
        members = np.full((n, 2 * SAMPLE), -1)
        members[node[some], old[some] * SAMPLE + rank[rank < SAMPLE]] = other[some]
        self.fresh[:] = False
        members = members[(members[:, :SAMPLE] >= 0).any(1)]
        for at in range(0, len(members), MEET_AT_ONCE):
            self._meet(members[at : at + MEET_AT_ONCE], SAMPLE)
        return int(self.fresh.sum())

    def _meet(self, groups: np.ndarray, n_new: int) -> None:
        """The first ``n_new`` members of a group meet all others; the best few for each member enter its list."""
        x = self.x[groups]
        near = x[:, :n_new] @ x.transpose(0, 2, 1)
        new, all_ = groups[:, :n_new, None], groups[:, None, :]
        near[(new < 0) | (all_ < 0) | (new == all_)] = -3
        worst = self.near[groups, -1]
        k = min(BEST_OF_GROUP, groups.shape[1])
        for_new = (near >= np.partition(near, -k, axis=2)[:, :, -k, None]) & (near > worst[:, :n_new, None])
        k = min(BEST_OF_GROUP, n_new)
        for_all = (near >= np.partition(near, -k, axis=1)[:, -k, None, :]) & (near > worst[:, None, :])
        g, i, j = np.nonzero(for_new)
        h, p, q = np.nonzero(for_all)
        node, other = np.concatenate([groups[g, i], groups[h, q]]), np.concatenate([groups[g, j], groups[h, p]])
        if len(node):
            self.enter(node, other, np.concatenate([near[g, i, j], near[h, p, q]]))


def linked(x: np.ndarray, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """The graph of a part with unit vectors ``x``: the neighbours of every node in both directions, the nearest REVERSE of those that list it; -1 is none."""
    n = len(x)
    lists = Lists(x)
    lists.meet_at_random(rng)
    for _ in range(rounds):
        if lists.meet_neighbours(rng) < SETTLED * n * DEGREE:
            break
    node, other, near, _ = lists.both_ways()
    half = len(node) // 2
    order = np.lexsort((other[half:], -near[half:], node[half:])) + half
    back = order[_ranks(node[order]) < REVERSE]
    keep = np.concatenate([np.arange(half), back])
    node, other = np.divmod(np.unique(node[keep] * n + other[keep]), n)
    out = np.full((n, DEGREE + REVERSE), -1, "int32")
    out[node, _ranks(node)] = other
    return out


def greedy(x: np.ndarray, links: np.ndarray, q: np.ndarray, own: np.ndarray, beam: int, rng: np.random.Generator):
    """(query, node, near) of the nodes within ERROR of the KEEP-th best that greedy search finds for every row of ``q``; ``own`` is the query's node, or -1."""
    n, found = len(x), []
    beam = min(beam, n)
    seeds = rng.permutation(n)[: max(4 * beam, n // 32)]
    at_seeds = x[seeds].T
    step, some = max(16, beam // 8), max(1, CELLS // n)
    for first in range(0, len(q), some):
        v, mine = q[first : first + some], own[first : first + some]
        rows = np.arange(len(v))
        known = np.flatnonzero(mine >= 0)
        seen = np.zeros((len(v), n), bool)
        seen[:, seeds] = True
        start = v @ at_seeds
        start[mine[:, None] == seeds[None, :]] = -3
        at = np.argpartition(start, -beam, axis=1)[:, -beam:]
        node, near = seeds[at], start[rows[:, None], at]
        # the own node takes the place of the last one
        seen[known, mine[known]] = True
        last = near[known].argmin(1)
        node[known, last], near[known, last] = mine[known], 2.0
        closed = near <= -3
        while True:
            order = np.argsort(-near, axis=1, kind="stable")
            node, near, closed = (np.take_along_axis(t, order, 1) for t in (node, near, closed))
            pick = ~closed & (np.cumsum(~closed, axis=1) <= step)
            i, j = np.nonzero(pick)
            if not len(i):
                break
            closed |= pick
            to = links[node[i, j]]
            met = (i[:, None] * n + to)[to >= 0]
            met = np.sort(met[~seen.ravel()[met]])
            met = met[np.diff(met, prepend=-1) > 0]
            seen.ravel()[met] = True
            row, new = np.divmod(met, n)
            ends = np.searchsorted(row, np.arange(len(v) + 1))
            value = np.concatenate([x[new[b:e]] @ v[r] for r, (b, e) in enumerate(zip(ends[:-1], ends[1:], strict=True))])
            better = value > near[row, -1]
            row, new, value = row[better], new[better], value[better]
            place = beam + _ranks(row)
            wide = int(place.max(initial=beam - 1)) + 1
            grown = [np.full((len(v), wide), fill, t.dtype) for t, fill in ((node, 0), (near, -3.0), (closed, True))]
            for t, to_, held in zip(grown, (new, value, False), (node, near, closed), strict=True):
                t[:, :beam], t[row, place] = held, to_
            best = np.argpartition(grown[1], -beam, axis=1)[:, -beam:]
            node, near, closed = (np.take_along_axis(t, best, 1) for t in grown)
        i, j = np.nonzero((near > -3) & (near >= near[:, [min(KEEP, beam) - 1]] - ERROR))
        found.append((first + i, node[i, j], near[i, j]))
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def parts(total: int, tasks: int) -> int:
    return max(1, -(-total // PART), min(tasks, total // SMALL_PART))


def build(nodes: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """The graphs: part, node, code, links (32-bit places among the part's nodes, by id)."""
    n_parts = parts(nodes.count(), nodes.sparkSession.sparkContext.defaultParallelism)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        ids = table["node"].to_numpy()
        links = linked(unit(table["code"].to_pylist()), rounds, np.random.default_rng([len(ids), int(ids[0]) % 2**63]))
        return table.append_column("links", pa.array([row[row >= 0].tobytes() for row in links], pa.binary()))

    rows = nodes.select(F.pmod(F.xxhash64("node"), F.lit(n_parts)).alias("part"), "node", "code")
    return stored(rows.groupBy("part").applyInArrow(run, "part long, node long, code binary, links binary"), "graph")


def brute_force(nodes: DataFrame, queries: DataFrame) -> dict[int, list[float]]:
    """How near the NEAREST other nodes are to each of TRIED rows of ``queries``; every node is compared."""
    tried = queries.orderBy(F.xxhash64("query"), "query").limit(TRIED).collect()
    if not tried:
        return {}
    ids, codes = np.array([r["query"] for r in tried]), [bytes(r["query_code"]) for r in tried]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = unit(codes)
        for batch in batches:
            if batch.num_rows:
                near = q @ unit(batch.column("code").to_pylist()).T
                near[ids[:, None] == batch.column("node").to_numpy()[None, :]] = -3
                best = -np.sort(-near, axis=1)[:, :NEAREST]
                query, best = np.repeat(ids, best.shape[1]), best.ravel().astype(float)
                yield pa.RecordBatch.from_arrays([pa.array(query[best > -3], pa.int64()), pa.array(best[best > -3], pa.float64())], ["query", "near"])

    found = small_batches(nodes.select("node", "code")).mapInArrow(run, "query long, near double")
    out: dict[int, list[float]] = {}
    for row in first_of(found, ["query"], [F.desc("near")], NEAREST).collect():
        out.setdefault(row["query"], []).append(row["near"])
    return out


def recall(beams: DataFrame, truth: dict[int, list[float]]) -> float:
    """Part of the nearest nodes of the queries in ``truth`` that their beams hold."""
    rows = beams.filter(F.col("query").isin(list(truth)) & (F.col("node") != F.col("query")))
    hits = Counter(r["query"] for r in rows.collect() if r["near"] >= min(truth[r["query"]]) - 1e-12)
    most = sum(map(len, truth.values()))
    return sum(min(hits[q], len(near)) for q, near in truth.items()) / most if most else 1.0


def best_of(beams: DataFrame) -> DataFrame:
    """The rows of beams that answers are made of: all within ERROR of the KEEP-th best."""
    placed = beams.withColumn("__r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("near"), "node")))
    last = F.min(F.when(F.col("__r") <= KEEP, F.col("near"))).over(Window.partitionBy("query"))
    return placed.withColumn("__last", last).filter(F.col("near") >= F.col("__last") - ERROR).drop("__r", "__last")


def search_parts(graph: DataFrame, queries: DataFrame, beam: int) -> DataFrame:
    """(query, node, near): what every row of ``queries`` (query, query_code) finds in every part."""
    spark = graph.sparkSession
    held = [r["part"] for r in graph.select("part").distinct().collect()]
    n_groups = max(1, -(-queries.count() // ASKING), -(-2 * spark.sparkContext.defaultParallelism // max(1, len(held))))
    left = graph.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))
    right = queries.withColumn("group", F.pmod(F.xxhash64("query", F.lit("group")), F.lit(n_groups)).cast("int"))
    right = right.withColumn("part", F.explode(F.array(*[F.lit(p) for p in held]).cast("array<bigint>")))

    def run(own: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query", "node", "near"]
        if not own.num_rows or not asked.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        own = own.sort_by("node")
        ids, query = own["node"].to_numpy(), asked["query"].to_numpy()
        places = [np.frombuffer(b, np.int32) for b in own["links"].to_pylist()]
        links = np.full((len(ids), max(1, max(map(len, places)))), -1, np.int32)
        sizes = np.array([len(p) for p in places])
        links[np.arange(links.shape[1])[None, :] < sizes[:, None]] = np.concatenate(places)
        at = np.minimum(np.searchsorted(ids, query), len(ids) - 1)
        mine = np.where(ids[at] == query, at, -1)
        q, rng = unit(asked["query_code"].to_pylist()), np.random.default_rng([len(ids), int(ids[0]) % 2**63])
        which, node, near = greedy(unit(own["code"].to_pylist()), links, q, mine, beam, rng)
        return pa.table([pa.array(query[which]), pa.array(ids[node]), pa.array(near)], names)

    return left.groupBy("part", "group").cogroup(right.groupBy("part", "group")).applyInArrow(run, "query long, node long, near double")


def search(graph: DataFrame, nodes: DataFrame, queries: DataFrame, beam: int = BEAM) -> DataFrame:
    """(query, node, near): what each row of ``queries`` (query, query_code) finds with beams of ``beam`` nodes, or as many more as the recall needs."""
    wanted = stored(queries, "queries")
    truth, total = brute_force(nodes, wanted), nodes.count()
    tried = wanted.filter(F.col("query").isin(list(truth)))
    while beam < total and recall(best_of(search_parts(graph, tried, beam)), truth) < WANTED:
        beam *= 2
    return stored(search_parts(graph, wanted, beam), "beam")


def cosine(a: str, b: str) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, beam: int = BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows of ``vectors`` (k <= NEAREST) for every
    row of ``queries``, which are rows of ``vectors``, its own left out."""
    rows = stored(usable(vectors), "vectors")
    nodes = stored(nodes_of(rows), "nodes")
    graph = build(nodes)
    asked = rows.join(queries.select(F.col("vec_id").cast("long").alias("__id")).distinct(), F.col("vec_id") == F.col("__id"), "left_semi")
    asked = stored(asked.join(nodes.select("node", "vector"), "vector").select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).distinct(), "asked")
    wanted = asked.select("query").distinct().join(nodes.select(F.col("node").alias("query"), F.col("code").alias("query_code")), "query")
    best = best_of(search(graph, nodes, wanted, beam))
    exact = best.join(nodes.select("node", "ids", "vector"), "node").join(nodes.select(F.col("node").alias("query"), F.col("vector").alias("asked")), "query")
    exact = exact.select("query", F.explode("ids").alias("vec_id"), cosine("asked", "vector").alias("score")).distinct()
    order = [F.desc("score"), F.col("vec_id")]
    exact = stored(first_of(exact, ["query"], order, k + 1), "nearest")
    each = asked.join(exact, "query").filter(F.col("vec_id") != F.col("query_id"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
