"""Rules on small tables worked out by hand."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sigspark.functions import scalars
from sigspark.functions.arrays import fit_width, with_channel
from sigspark.functions.summaries import sign_changes
from sigspark.operators import augment, catalog, evaluate, features, frames, prepare
from sigspark.sources import registry, words


@pytest.mark.parametrize(
    "path, default, compat",
    [
        ("Kicks/hat1.wav", ("kick", None), ("kick", None)),
        ("Snare roll.wav", (None, "blacklisted"), (None, "blacklisted")),
        ("roll.wav", (None, "unlabelled"), (None, "unlabelled")),
        ("that clap.wav", (None, "ignored"), (None, "ignored")),
        ("that snare.wav", ("snare", None), (None, "ignored")),
        ("that kick.wav", ("kick", None), ("kick", None)),
        ("clap.wav", (None, "unlabelled"), (None, "unlabelled")),
    ],
)
def test_label_rules(spark, path, default, compat):
    one = spark.createDataFrame([(path,)], "path string")
    for want, flag in ((default, False), (compat, True)):
        label, reason = catalog.label_rules("path", compat=flag)
        assert tuple(one.select(label, reason).first()) == want


def test_stem_first(spark):
    one = spark.createDataFrame([("kicks/hat1.wav",)], "path string")
    assert one.select(catalog.label_rules("path", match="stem_first")[0]).first()[0] == "hat"


def test_long_word_lists(spark):
    many = tuple(f"word{i}." for i in range(100))
    df = spark.createDataFrame([("a word7.wav",), ("a word777wav",)], "path string")
    assert [r[0] for r in df.select(catalog.contains_any(F.col("path"), many)).collect()] == [True, False]


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("roll, stomp,,enhancer\n that\n")
    assert words.as_words(words.read_word_list(spark, str(tmp_path / "w.txt"))) == ("enhancer", "roll", "stomp", "that")
    with pytest.raises(ValueError):
        words.as_words(spark.range(20).select(F.col("id").cast("string").alias("word")), 10)


def test_durations_and_length(spark):
    df = spark.createDataFrame([(2.0, 0.5, None), (2.0, 0.5, 1.5), (5.0, 0.0, None), (4.99, 0.0, None)], "orig_duration double, start_time double, end_time double")
    got = catalog.durations(df).withColumn("long", catalog.too_long()).collect()
    assert [(r.new_duration, r.long) for r in got] == [(1.5, False), (1.0, False), (5.0, True), (4.99, False)]


def test_routing_takes_the_first_reason(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "v int")
    got = catalog.route(df, [("a", F.col("v") < 3), ("b", F.col("v") < 6)])
    assert [r.reason for r in got.orderBy("v").collect()] == ["a", "b", None]


def test_quiet_limit(spark):
    df = spark.createDataFrame([("q", 0, 0.0199), ("k", 0, 0.02)], "signal_id string, frame_idx long, rms double")
    assert [r.signal_id for r in frames.too_quiet(df, 0.02, 44).collect()] == ["q"]


def test_sign_changes(spark):
    df = spark.createDataFrame([(1.0, None), (-1.0, 1.0), (0.0, -1.0), (2.0, 0.0)], "x double, p double")
    assert df.agg(sign_changes(F.col("x"), F.col("p"))).first()[0] == 0.75


def test_loudest_takes_the_first(spark):
    from sigspark.functions.summaries import at_loudest

    df = spark.createDataFrame([(3.0, 7.0, 0), (3.0, 9.0, 1)], "rms double, x double, i int")
    assert df.agg(at_loudest(F.col("x"), F.col("rms"), F.col("i"), "v")).first()[0] == 7.0


def test_envelope_by_hand(spark):
    rms = [0.0, 0.1, 1.0, 0.4, 0.0, 0.3, 0.0]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(rms)] + [("one", 0, 1.0)], "signal_id string, frame_idx long, rms double")
    got = {r.signal_id: r for r in features.envelope(df, 0.5, 0.2).collect()}
    s = got["s"]  # span 2..5, peak at 2
    assert s.log_attack_time == pytest.approx(-0.6020599913)
    assert s.temporal_centroid == pytest.approx((0.16 / 3 + 0.09) / 1.25)
    assert (s.duration, s.release) == (2.0, 1.5)
    one = got["one"]
    assert one.temporal_centroid == 0.0 and one.lat_tc_ratio is None and one.duration == 0.5


def test_single_frame_has_no_gradient(spark):
    df = spark.createDataFrame([("s", 0, 1.0, 0.5)], "signal_id string, frame_idx long, rms double, zcr double")
    row = features.summary_features(frames.ranked(df, True), ("rms", "zcr")).first()
    assert row.log_rms_d_avg is None and row.log_rms_d_zcr is None and row.crest_factor == 1.0 and row.zcr_loudest == 0.5


def test_scaling(spark):
    df = spark.createDataFrame([(0, [2.0, 1.0, None]), (1, [2.0, 3.0, 4.0])], "i int, features array<double>")
    stats = prepare.column_statistics(df)
    got = {r.i: r.features for r in prepare.standard_scale(df, stats).collect()}
    assert got == {0: [0.0, -1.0, None], 1: [0.0, 1.0, 0.0]}
    assert [r.features for r in prepare.impute_mean(df, stats).orderBy("i").collect()][0] == [2.0, 1.0, 4.0]


def test_feature_array_and_drop(spark):
    df = spark.createDataFrame([(1.0, float("nan"), float("inf"))], "a double, b double, c double")
    assert df.select(prepare.feature_array(["a", "b", "c"])).first()[0] == [1.0, None, None]
    assert prepare.drop_columns(df, "b", "nothing").columns == ["a", "c"]


def test_tensors(spark):
    rows = [(0, "train", [[1.0, 3.0], [1.0, 3.0]]), (1, "test", [[2.0] * 5, [3.0] * 5])]
    df = spark.createDataFrame(rows, "i int, split string, mel array<array<double>>")
    got = {r.i: r.tensor for r in prepare.tensors(df, width=3).collect()}
    assert got == {0: [[[-1.0, 1.0, 0.0]] * 2], 1: [[[0.0] * 3, [1.0] * 3]]}
    pair = spark.range(1).select(F.size(fit_width(F.array(F.lit(1.0)), 256)), F.size(with_channel(F.array(F.array(F.lit(1.0)))))).first()
    assert tuple(pair) == (256, 1)


def test_free_names(spark):
    names = ["x.wav", "x.wav", "x_new.wav", "x.wav", "y.tar", "x.mp3", "y.tar"]
    df = spark.createDataFrame(list(enumerate(names)), "i int, name string")
    got = [r.new_name for r in augment.free_names(df, "name", "i").orderBy("i").collect()]
    assert len(set(got)) == len(names)
    assert got[0] == "x.wav" and got[5] == "x.mp3" and got[4] == "y.tar" and got[6] == "y_new.tar"
    plain = augment.free_names(df.where("i in (0, 1, 3)"), "name", "i").orderBy("i").collect()
    assert [r.new_name for r in plain] == ["x.wav", "x_new.wav", "x_new_new.wav"]


def test_augment_plan_fills_every_class(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(20)], "i int, label string")
    plan = augment.augment_plan(df, "i", "label", 30)
    counts = {r.label: r["count"] for r in plan.groupBy("label").count().collect()}
    assert counts == {"a": 27, "b": 13}
    half = {r.method: r["count"] for r in plan.where("label = 'a'").groupBy("method").count().collect()}
    assert half == {"pitch": 13, "stretch": 14}
    assert plan.where("(method = 'pitch' and factor = 0) or (method = 'stretch' and factor = 1)").count() == 0
    assert plan.groupBy("i", "method", "factor").count().where("count > 1").count() == 0


def test_reports(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "label string, predicted string")
    got = {r["name"]: r for r in evaluate.class_report(df).collect()}
    assert got["b"]["precision"] == pytest.approx(1 / 3) and got["b"].recall == 1.0
    assert (got["c"]["precision"], got["c"].recall, got["c"].f1) == (0.0, 0.0, 0.0)
    assert got["accuracy"].f1 == 0.5 and got["macro avg"].support == 4
    conf = {r.label: (r.p_a, r.p_b, r.p_c) for r in evaluate.confusion(df, ["a", "b", "c"]).collect()}
    assert conf["a"] == (0.5, 0.5, 0.0)


def test_early_stop(spark):
    losses = [5.0, 4.0, 4.5, 4.2, 4.1, 1.0]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(losses)], "run_id string, epoch int, loss double")
    row = evaluate.early_stop(df, 3).first()
    assert (row.stop_epoch, row.best_epoch, row.best_loss) == (4, 1, 4.0)
    assert evaluate.early_stop(df, 10).first().best_epoch == 5


def test_histogram_last_edge(spark):
    df = spark.createDataFrame([("a", v) for v in (0.0, 5.0, 10.0)] + [("b", 1.0)], "g string, v double")
    got = {(r.g, r.bin): r.n for r in evaluate.histogram(df, "g", "v", 10).collect()}
    assert got == {("a", 0): 1, ("a", 5): 1, ("a", 9): 1, ("b", 0): 1}


def test_names_and_numbers(spark):
    df = spark.createDataFrame([("/a/my lib/x.b.wav",)], "p string")
    row = df.select(
        scalars.base_name("p").alias("base"), scalars.stem("p").alias("stem"), scalars.suffix("p").alias("suffix"),
        scalars.flat_name("p", "/a").alias("flat"), scalars.base_name(F.lit("/a/b c/")).alias("last"),
        scalars.log10_pos(F.lit(0.0)).alias("none"), scalars.finite(F.lit(float("-inf"))).alias("inf"),
    ).first()
    assert tuple(row) == ("x.b.wav", "x.b", ".wav", "my lib__x.b.wav", "b c", None, None)


def test_csv_table(spark, tmp_path):
    (tmp_path / "t.csv").write_text("name,class,length\nx,s,5.5\ny,k,none\n")
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("class", T.StringType()), T.StructField("length", T.FloatType())])
    got = registry.read_table(spark, str(tmp_path / "t.csv"), schema).orderBy("name").collect()
    assert [(r.name, r.length) for r in got] == [("x", 5.5), ("y", None)]


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in catalog.profile(df).collect()] == [("a", "int", 2, 2), ("b", "string", 2, 1)]
