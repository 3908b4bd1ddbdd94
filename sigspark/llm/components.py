"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigspark.session import stored


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x"), F.sum(F.xxhash64("lo", "hi") % 1_000_003).alias("s")).head()
    return row["n"], row["x"], row["s"]


def large_star(edges: DataFrame) -> DataFrame:
    """Each node points its larger neighbours at the least of its neighbours and itself."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    return larger.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node points its smaller neighbours and itself at the least of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").filter(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge between different nodes;
    component is the least node reachable.

    Per node only its least neighbour is gathered (combined before the shuffle),
    so a node with very many edges needs no large group. Each round is a
    written table, which cuts the lineage.
    """
    now = stored(edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = _print_of(now)
    for _ in range(rounds):
        now = stored(small_star(large_star(now)), "stars")
        after = _print_of(now)
        if after == before:
            roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(roots)
        before = after
    raise RuntimeError(f"components did not settle in {rounds} rounds")
