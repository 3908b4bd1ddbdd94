"""The operators for long series against plain windows, with heavy keys and small chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sigspark.operators import frames, neighbours, ranking, segments, series, vocoder


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 3000
    key = np.where(rng.uniform(size=n) < 0.4, 0, rng.integers(1, 40, n))
    return spark.createDataFrame(
        pd.DataFrame({"k": key, "t": rng.exponential(1000, n).round(1), "i": np.arange(n), "v": rng.normal(size=n)})
    ).cache()


def test_positions_of_a_heavy_key(skewed):
    w = Window.partitionBy("k").orderBy("t", "i")
    want = skewed.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    got = segments.with_positions(skewed, ["k"], "t", ("i",), heavy_rows=100)
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in plan  # the heavy key is cut


def test_positions_by_text(skewed):
    named = skewed.select("k", F.concat(F.lit("/lib/é/"), F.col("i").cast("string")).alias("p"))
    w = Window.partitionBy("k").orderBy("p")
    want = named.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))
    got = segments.with_positions(named, ["k"], "p", heavy_rows=100)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    cut = segments._with_pieces(named, ["k"], "p", segments.local_table(named.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where("_n > 100")), 100)
    assert cut.where("_heavy").select("k", "_piece").distinct().count() > 10


def test_positions_without_key(skewed):
    got = segments.with_positions(skewed, [], "t", ("i",), heavy_rows=50).orderBy("t", "i").select("pos").toPandas()
    assert list(got["pos"]) == list(range(3000))


def test_gradients_over_chunks(skewed):
    rows = segments.with_positions(skewed, ["k"], "t", ("i",), out="place").withColumnRenamed("k", "signal_id")
    got = frames.gradients(rows, {"g": F.col("v")}, size=7).toPandas().sort_values(["signal_id", "place"])
    for _, part in got.groupby("signal_id"):
        if len(part) > 1:
            want = np.gradient(part["v"].to_numpy())
            assert np.allclose(part["g_d"], want)
            assert np.allclose(part["g_d_prev"].to_numpy()[1:], want[:-1])


def test_gradient_by_hand(spark):
    rows = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("a", 2, 4.0), ("b", 0, 1.0)], "signal_id string, place long, v double")
    got = {(r.signal_id, r.place): r.g_d for r in frames.gradients(rows, {"g": F.col("v")}).collect()}
    assert got == {("a", 0): 1.0, ("a", 1): 1.5, ("a", 2): 2.0, ("b", 0): None}


def test_running_sum_and_attach(skewed):
    rows = segments.with_positions(skewed, ["k"], "t", ("i",))
    got = segments.running_sum(rows, ["k"], "pos", {"s": "v"}, size=11).toPandas().sort_values(["k", "pos"])
    assert len(got) == 3000
    assert np.allclose(got["s"], got.groupby("k")["v"].cumsum())
    per = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("all"))
    joined = segments.attach(rows, per, ["k"], "pos", "n", size=11)
    assert joined.count() == 3000
    assert joined.groupBy("k").agg(F.countDistinct("all").alias("d")).where("d > 1").count() == 0


def test_join_small_and_salted_agree(skewed):
    per = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    a = segments.join_small(skewed, per, ["k"])
    b = segments.join_small(skewed, per, ["k"], max_rows=3)
    assert a.count() == 3000 and a.exceptAll(b.select(*a.columns)).count() == 0
    semi = segments.join_small(skewed, per.where("k > 20"), ["k"], "left_semi", max_rows=3)
    assert semi.count() == skewed.where("k > 20").count()


def test_peak_slice_and_resample(skewed):
    points = segments.with_positions(skewed, ["k"], "t", ("i",)).select(F.col("k").alias("signal_id"), "pos", F.col("v").alias("x"))
    table = points.toPandas().sort_values(["signal_id", "pos"])
    whole = {k: p["x"].to_numpy() for k, p in table.groupby("signal_id")}
    got = series.peak_normalise(points, size=13).toPandas().sort_values(["signal_id", "pos"])
    for k, p in got.groupby("signal_id"):
        assert np.allclose(p["y"], whole[k] / np.abs(whole[k]).max())
    got = series.resample_linear(points, 1.5).toPandas().sort_values(["signal_id", "j"])
    for k, p in got.groupby("signal_id"):
        at = np.arange(0, len(whole[k]) - 1 + 1e-9, 1.5)
        assert np.allclose(p["x"], np.interp(at, np.arange(len(whole[k])), whole[k]))
    bounds = series.lengths(points).select("signal_id", "n", F.lit(3).alias("start"), F.lit(9).alias("end"))
    cut = series.slice_points(points, bounds, size=4).toPandas()
    assert set(cut.groupby("signal_id").size()) <= {5, 6}


def test_splits_are_exact(skewed):
    split = ranking.random_split(skewed, "i", 0.25, 7).toPandas()
    assert len(split) == 3000 and (split["split"] == "test").sum() == 750
    strat = ranking.stratified_split(skewed, "i", "k", 0.1, 7).toPandas()
    for _, part in strat.groupby("k"):
        assert (part["split"] == "validation").sum() == int(np.floor(len(part) * 0.1 + 0.5))
    capped = ranking.cap_per_class(skewed, "k", "i", 30)
    beyond = ranking.cap_per_class(skewed, "k", "i", 1200)
    assert capped.groupBy("k").count().where("count > 30").count() == 0
    assert beyond.groupBy("k").count().agg(F.max("count")).first()[0] == 1200
    again = ranking.random_split(skewed.repartition(5), "i", 0.25, 7)
    assert again.where("split = 'test'").select("i").exceptAll(
        ranking.random_split(skewed, "i", 0.25, 7).where("split = 'test'").select("i")
    ).count() == 0


def test_balanced_sample(skewed):
    got = ranking.balanced_sample(skewed.where("k < 4"), "i", "k", 1).toPandas()
    assert len(got) == skewed.where("k < 4").count()
    shares = got.groupby("k").size() / len(got)
    assert shares.min() > 0.18 and shares.max() < 0.32


def test_label_codes(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), ("c", 4)], "label string, i int")
    assert {r.label: r.code for r in ranking.label_codes(df, "label", "i").collect()} == {"b": 0, "a": 1, "c": 2}


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 8)), rng.integers(0, 3, 60)
    x[5] = x[9]
    df = spark.createDataFrame([(i, int(y[i]), x[i].tolist()) for i in range(60)], "id long, label int, features array<double>")
    test, train = df.where("id >= 45"), df.where("id < 45")
    for how in ({}, {"max_cells": 80, "block": 7}):
        got = neighbours.k_nearest(test, train, "id", 5, **how).toPandas()
        for q in range(45, 60):
            d = ((x[:45] - x[q]) ** 2).sum(1)
            want = np.lexsort((np.arange(45), d))[:5]
            assert sorted(got[got.query_id == q].row_id) == sorted(want)


def test_vocoder_tables_match_numpy(spark):
    from sigspark.functions import dsp

    rng = np.random.default_rng(2)
    signals = {"a": rng.normal(size=41), "b": rng.normal(size=64)}
    points = spark.createDataFrame(
        [(k, i, float(v)) for k, x in signals.items() for i, v in enumerate(x)], "signal_id string, pos long, x double"
    )
    got = vocoder.time_stretch(points, 1.25, size=10).toPandas().sort_values(["signal_id", "pos"])
    for k, x in signals.items():
        want = dsp.stretch(x, 1.25, 8)
        have = got[got.signal_id == k]
        table = np.zeros(len(want))
        table[have["pos"].to_numpy()] = have["x"]
        assert np.allclose(table, want, atol=1e-5)
    same = vocoder.pitch_shift(points, 0.0, size=10).toPandas().sort_values(["signal_id", "pos"])
    assert np.allclose(same[same.signal_id == "b"]["x"][4:-8], signals["b"][4:-8], atol=1e-6)


def pieces_of(df, order, ties=(), heavy_rows=400):
    heavy = segments.local_table(df.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).where(f"_n > {heavy_rows}"))
    return segments._with_pieces(df, ["k"], order, heavy, heavy_rows, ties)


@pytest.mark.parametrize("kind", ["outlier", "exponential", "constant", "constant without ties", "text", "nulls", "few values"])
def test_pieces_of_a_heavy_key_are_of_one_size(spark, kind):
    rows = spark.range(20_000).withColumn("k", F.when(F.col("id") % 10 == 0, F.col("id") % 100).otherwise(7))
    orders = {
        "outlier": F.when(F.col("id") == 5, 1e15).otherwise(F.col("id") / 7),
        "exponential": F.exp(F.col("id") / 500),
        "constant": F.lit(3.0),
        "constant without ties": F.lit(3.0),
        "text": F.concat(F.lit("s3://a/very/long/prefix/"), F.when(F.col("id") % 2 == 0, "é").otherwise("z"), F.col("id").cast("string")),
        "nulls": F.when(F.col("id") % 3 > 0, F.col("id") % 5),
        "few values": F.when(F.col("id") % 100 < 90, 1).otherwise(F.col("id") % 4),
    }
    df = rows.withColumn("o", orders[kind])
    ties = () if kind == "constant without ties" else ("id",)
    sizes = [r["count"] for r in pieces_of(df, "o", ties).where("_heavy").groupBy("k", "_piece").count().collect()]
    assert sum(sizes) == 18_000 and len(sizes) >= 170 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = segments.with_positions(df, ["k"], "o", ties, heavy_rows=400)
    assert got.groupBy("k").agg(F.countDistinct("pos").alias("d"), F.min("pos").alias("a"), F.max("pos").alias("b"), F.count(F.lit(1)).alias("n")).where("a != 0 or b != n - 1 or d != n").isEmpty()
    if ties:
        want = df.withColumn("pos", (F.row_number().over(Window.partitionBy("k").orderBy("o", "id")) - 1).cast("long"))
        assert got.exceptAll(want).isEmpty()


def test_sampled_edges_of_a_large_key(spark, monkeypatch):
    monkeypatch.setattr(segments, "EDGE_SAMPLE", 32)
    df = spark.range(400_000).select(F.lit(1).alias("k"), F.exp(F.col("id") / 20_000).alias("o"), "id")
    sizes = [r["count"] for r in pieces_of(df, "o", ("id",), 4_000).groupBy("_piece").count().collect()]
    assert 390 <= len(sizes) <= 401 and max(sizes) <= 2 * 400_000 / len(sizes)


def test_equal_rows_stay_together_and_are_ranked(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.lit(2).alias("o"))
    got = segments.with_positions(df, ["k"], "o", heavy_rows=100)
    assert sorted(r.pos for r in got.collect()) == list(range(3000))
