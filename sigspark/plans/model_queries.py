"""Queries without SQL text: models, iterative imputation, vocoder; and counts on a stream."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from sigspark.config import DEFAULT
from sigspark.operators import impute, models, prepare, ranking, vocoder
from sigspark.operators.segments import join_small
from sigspark.plans.book import query, rounded
from sigspark.session import scratch_path
from sigspark.sources.adapters import feat_embeddings, sig_events
from sigspark.streaming import arrivals, samples

# all rows of the table and the default training, but for fewer rounds of boosting: one-vs-rest over the ten labels of the
# stand-in table makes ten times the default's trees
QUICK = replace(DEFAULT, boost_rounds=20)


def _prepared(spark, d):
    return prepare.prepare(feat_embeddings(spark, d, gaps=True), "vec_id", QUICK)


def _test_scores(spark, d, key, weighted=False):
    ready = _prepared(spark, d)
    made = models.train(ready, "vec_id", key, QUICK, weighted)
    return made.score(ready.where(F.col("split") == "test"), "vec_id").select("vec_id", "label", "predicted")


@query()
def q_forest(spark, d):
    return _test_scores(spark, d, "rf", weighted=True)


@query()
def q_boosting(spark, d):
    return _test_scores(spark, d, "gb")


@query()
def q_support_vectors(spark, d):
    return _test_scores(spark, d, "svc")


@query()
def q_logistic(spark, d):
    return _test_scores(spark, d, "lr", weighted=True)


@query()
def q_least_squares(spark, d):
    return _test_scores(spark, d, "ols")


@query()
def q_feed_forward(spark, d):
    return _test_scores(spark, d, "nn", weighted=True)


@query()
def q_impute_iterative(spark, d):
    rows = ranking.random_split(feat_embeddings(spark, d, gaps=True), "vec_id", DEFAULT.test_share, DEFAULT.seed)
    fitted = impute.fit_imputer(rows.where(F.col("split") == "train"))
    filled = fitted.transform(rows)
    return rounded(filled.select("vec_id", "split", F.posexplode("features").alias("idx", "v")), 4)


def _complete_rows(spark, d):
    rows = feat_embeddings(spark, d)
    coded = join_small(rows, ranking.label_codes(rows, "label", "vec_id"), ["label"])
    return coded.withColumn("code", F.col("code").cast("double"))


@query()
def q_sweep(spark, d):
    return models.sweep_forest(_complete_rows(spark, d), QUICK, trees=(10, 20, 50))


@query()
def q_feature_importance(spark, d):
    from pyspark.ml.functions import array_to_vector

    rows = _complete_rows(spark, d).withColumn("weight", F.lit(1.0)).withColumn("features", array_to_vector("features"))
    forest = models.random_forest(QUICK, 64, 10)
    table = models.fitted_importance(forest, rows, [f"f{i:02d}" for i in range(64)])
    return rounded(models.top_features(table))


@query()
def q_time_stretch(spark, d):
    return rounded(vocoder.time_stretch(sig_events(spark, d), 1.25))


@query()
def q_pitch_shift(spark, d):
    return rounded(vocoder.pitch_shift(sig_events(spark, d), 4))


@query("SELECT date_trunc('day', ts) AS start, event_type AS name, count(*) AS n FROM events GROUP BY 1, 2")
def q_stream_counts(spark, d):
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    # event time on a stream must be a timestamp with zone; the windows go back to plain time
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    out = scratch_path(spark, "counts")
    timed = stream.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = arrivals.stream_counts(spark, timed, "ts", "event_type", f"{out}/rows", f"{out}/checkpoint")
    return counts.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query("""WITH sig AS (SELECT user_id AS signal_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos, value AS x FROM events),
fr AS (SELECT signal_id, x, unnest(range(greatest(CAST(ceil((pos - 7) / 4.0) AS BIGINT), 0), pos // 4 + 1)) AS frame_idx FROM sig)
SELECT signal_id, frame_idx, count(*) AS n, round(sqrt(avg(x * x)), 6) AS rms, round(avg(x), 6) AS mean FROM fr GROUP BY 1, 2""")
def q_stream_frames(spark, d):
    """Frames of eight samples, four apart, of signals that arrive in pieces of five, dealt over files by a hash."""
    points = sig_events(spark, d)
    piece = F.floor(F.col("pos") / 5)
    pieces = points.groupBy("signal_id", piece.alias("piece")).agg(F.sort_array(F.collect_list(F.struct("pos", "x")))["x"].alias("x"))
    lengths = points.groupBy("signal_id").agg(F.count(F.lit(1)).alias("total"))
    arriving = join_small(pieces, lengths, ["signal_id"]).withColumn("start", F.col("piece") * 5).withColumn("ts", F.timestamp_seconds(86_400 + F.col("piece") % 60))
    out = scratch_path(spark, "frames")
    arriving.repartition(8, F.xxhash64("signal_id", "piece")).write.parquet(f"{out}/pieces")
    schema = "signal_id long, start long, x array<double>, total long, ts timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(f"{out}/pieces")
    return rounded(samples.run_frames(stream, f"{out}/rows", f"{out}/checkpoint", 8, 4))
