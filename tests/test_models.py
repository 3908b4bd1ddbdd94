import numpy as np
import pytest
from clips import noise, tone, write
from dataclasses import replace
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sigspark.config import DEFAULT
from sigspark.operators import impute, models, prepare
from sigspark.plans import pipeline, predict
from sigspark.sources import library
from sigspark.streaming import arrivals

SMALL = replace(DEFAULT, forest_trees=20, boost_rounds=5, net_epochs=100, impute_rounds=5)


@pytest.fixture(scope="module")
def prepared(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        c = i % 4
        x = rng.normal(size=6) + 4 * np.eye(6)[c]
        rows.append((i, "kshz"[c], [None if rng.uniform() < 0.05 else float(v) for v in x]))
    df = spark.createDataFrame(rows, "id long, label string, features array<double>")
    return prepare.prepare(df, "id", SMALL).cache()


@pytest.mark.parametrize("key", ["lr", "svc", "rf", "gb", "knn", "nn"])
def test_separable_classes(spark, prepared, key, tmp_path):
    made, report = models.train_and_report(prepared, "id", key, SMALL, weighted=key in ("lr", "rf", "nn"))
    scores = {r["name"]: r for r in report.collect()}
    assert scores["accuracy"].f1 >= 0.9
    if key in ("rf", "knn", "svc"):
        made.write(spark, str(tmp_path / key))
        again = models.Trained.read(spark, str(tmp_path / key))
        test = prepared.where("split = 'test'")
        a = made.score(test, "id").select("id", "predicted")
        assert again.settings == SMALL and a.exceptAll(again.score(test, "id").select("id", "predicted")).count() == 0


def test_forest_in_batches(spark, prepared, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "WHOLE_FOREST", 0)
    monkeypatch.setattr(models, "FOREST_BATCH", 1500)
    made, report = models.train_and_report(prepared, "id", "rf", SMALL, weighted=True)
    sizes = [m.getNumTrees for m in made.model.stages]
    assert sum(sizes) == SMALL.forest_trees and len(sizes) > 2
    assert len({t.toDebugString.split("\n", 1)[1] for m in made.model.stages for t in m.trees}) > SMALL.forest_trees // 2
    assert {r["name"]: r for r in report.collect()}["accuracy"].f1 >= 0.9
    made.write(spark, str(tmp_path / "rf"))
    test = prepared.where("split = 'test'")
    a, b = (m.score(test, "id").select("id", "predicted") for m in (made, models.Trained.read(spark, str(tmp_path / "rf"))))
    assert a.exceptAll(b).count() == 0 and a.count() == test.count()
    ready = prepare.impute_mean(prepared, prepare.column_statistics(prepared)).withColumn("weight", F.lit(1.0))
    rows, forest = ready.withColumn("features", array_to_vector("features")), models.random_forest(SMALL, 6, 4)
    kept, unkept = models.importance(forest.fit(rows), list("abcdef"), spark), models.fitted_importance(forest, rows, list("abcdef"))
    assert kept.collect() == unkept.collect() and sum(r.importance for r in kept.collect()) == pytest.approx(1)
    assert {r.feature for r in models.top_features(kept, 4).collect()} == set("abcd")


def test_unknown_model(prepared):
    with pytest.raises(KeyError):
        models.train(prepared, "id", "tree", SMALL)


def test_merged_rows_are_made_in_tasks_of_their_own(spark):
    @F.udf("long")
    def task(_):
        from pyspark import TaskContext

        return TaskContext.get().taskAttemptId()

    rows = models.merged(spark.range(0, 60, 1, 6).withColumn("task", task("id")))
    assert rows.rdd.getNumPartitions() == 1 and rows.select("task").distinct().count() == 6
    assert [r.id for r in rows.collect()] == list(range(60))
    rows.unpersist()


def test_imputer_finds_a_linear_rule(spark):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=400), rng.normal(size=400)
    c = 2 * a - 3 * b + 1
    gone = rng.uniform(size=400) < 0.2
    rows = [(i, [float(a[i]), float(b[i]), None if gone[i] else float(c[i]), None]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    model = impute.fit_imputer(df, max_rounds=10)
    assert model.kept == [0, 1, 2]  # the empty column is gone
    got = np.array([r.features for r in model.transform(df).orderBy("id").collect()])
    assert np.abs(got[:, 2] - c).max() < 0.01


def test_imputer_round_trip(spark, prepared, tmp_path):
    model = impute.fit_imputer(prepared, max_rounds=2)
    model.write(spark, str(tmp_path / "imp"))
    again = impute.IterativeImputer.read(spark, str(tmp_path / "imp"))
    a, b = model.transform(prepared), again.transform(prepared)
    assert a.select("id", "features").exceptAll(b.select("id", "features")).count() == 0


def test_sweep_and_importance(spark, prepared):
    from pyspark.ml.functions import array_to_vector

    ready = prepare.impute_mean(prepared, prepare.column_statistics(prepared)).withColumn("weight", F.lit(1.0))
    found = models.sweep_forest(ready, SMALL, trees=(2, 5)).collect()
    assert [r.n_trees for r in found] == [2, 5] and all(r.accuracy > 0.5 for r in found)
    forest = models.random_forest(SMALL, 6, 4).fit(ready.withColumn("features", array_to_vector("features")))
    top = models.top_features(models.importance(forest, list("abcdef"), spark), 4).collect()
    assert {r.feature for r in top} == set("abcd")


@pytest.fixture(scope="module")
def trained_run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("runs")
    folder = tmp_path_factory.mktemp("train")
    for i in range(12):
        write(folder / f"kick {i}.wav", tone(55 + i))
        write(folder / f"hat {i}.wav", noise(i))
    pipeline_rows = pipeline.build_catalog(spark, str(root), "20240101-000000-a", str(folder))
    pipeline.store_features(spark, str(root), "20240101-000000-a", pipeline.extract_features(pipeline_rows))
    return str(root), predict.train_run(spark, str(root), "20240101-000000-a", "rf", SMALL)


def test_train_and_predict(spark, trained_run, tmp_path):
    root, (_, _, model_id) = trained_run
    model = predict.load_model(spark, root, "20240101-000000-a", model_id)
    write(tmp_path / "a.wav", tone(70))
    write(tmp_path / "b.wav", noise(99))
    write(tmp_path / "c.wav", tone(500, level=0.001))
    (tmp_path / "d.wav").write_bytes(b"nothing")
    wanted = [(str(i), f"{tmp_path}/{n}.wav") for i, n in enumerate("abcde")]
    got = predict.predict_keyed(spark, spark.createDataFrame(wanted, "key string, path string"), model, str(tmp_path))
    assert {r.key: r.outcome for r in got.collect()} == {
        "0": "kick", "1": "hat", "2": "Too quiet", "3": "Unreadable", "4": "Unreadable"
    }


def test_arriving_clips_are_scored_once(spark, trained_run, tmp_path):
    _, (model, _, _) = trained_run
    folder, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    write(folder / "a.wav", tone(70))
    arrivals.score_arrivals(spark, str(folder), model, out, mark).awaitTermination()
    write(folder / "sub" / "b.wav", noise(7))
    arrivals.score_arrivals(spark, str(folder), model, out, mark).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert {(r.path.rsplit("/", 1)[1], r.predicted) for r in rows} == {("a.wav", "kick"), ("b.wav", "hat")}
    assert len(rows) == 2


def test_repeated_paths_are_dropped(spark, tmp_path):
    schema = "path string, modificationTime timestamp"
    folder = str(tmp_path / "in")
    batch = spark.createDataFrame([("a",), ("a",), ("b",)], "path string").withColumn("modificationTime", F.current_timestamp())
    batch.write.parquet(folder)
    stream = arrivals.distinct_paths(spark.readStream.schema(schema).parquet(folder))
    out = str(tmp_path / "out")
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.path for r in spark.read.parquet(out).collect()) == ["a", "b"]


def test_late_rows_are_dropped(spark, tmp_path):
    folder, schema = str(tmp_path / "in"), "ts timestamp, name string"

    def add(*rows):
        spark.createDataFrame([(t, n) for t, n in rows], "ts string, name string").select(F.to_timestamp("ts").alias("ts"), "name").coalesce(1).write.mode("append").parquet(folder)

    add(("2024-01-01 01:00:00", "a"), ("2024-01-01 02:00:00", "a"))
    stream = lambda: spark.readStream.schema(schema).parquet(folder)
    run = lambda: arrivals.stream_counts(spark, stream(), "ts", "name", str(tmp_path / "out"), str(tmp_path / "mark"))
    run()
    add(("2024-01-09 00:00:00", "a"))
    run()
    add(("2024-01-01 03:00:00", "a"))
    got = {str(r.start)[:10]: r.n for r in run().collect()}
    assert got == {"2024-01-01": 2, "2024-01-09": 1}
    batch = arrivals.rolling_counts(spark.read.parquet(folder), "ts", "name")
    assert {str(r.start)[:10]: r.n for r in batch.collect()} == {"2024-01-01": 3, "2024-01-09": 1}


def test_derived_clips(spark):
    from sigspark.operators import clips

    df = spark.createDataFrame([("a", "stretch", 1.25, tone(200).tolist()), ("b", "pitch", 3.0, tone(200).tolist())], "id string, method string, factor double, x array<float>")
    got = {r.id: r.n for r in clips.derive_clips(df).select("id", F.size("x").alias("n")).collect()}
    n = len(tone(200))
    assert got == {"a": round(n / 1.25), "b": n}


def test_decode_of_a_library_feeds_augmentation(spark, tmp_path):
    write(tmp_path / "kick.wav", tone(60))
    decoded = library.decode(library.scan_library(spark, str(tmp_path)), onsets=False)
    assert decoded.where("status = 'ok'").count() == 1
