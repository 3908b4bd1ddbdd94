"""Queries on signals made from the events table (one signal per user)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from sigspark.functions import fft
from sigspark.functions.arrays import dft_magnitude, hann, rms_of_spectrum
from sigspark.functions.scalars import log10_pos, micros
from sigspark.functions.summaries import summaries
from sigspark.operators import catalog, features, frames, onset_lists, onsets, series
from sigspark.operators.frames import KEY
from sigspark.plans.book import query, rounded
from sigspark.session import scratch_path, stored
from sigspark.sources import wav
from sigspark.sources.adapters import read, sig_events

FRAME = 8
LOUD = 80.0
QUIET = 100.0
LOUD_SHARE = 0.5
BANDS = ("click", "error", "purchase", "signup", "view")

SIG = """sig AS (
  SELECT user_id AS signal_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         value AS x, event_type, ts
  FROM events)"""
FR = SIG + """, fr AS (
  SELECT signal_id, pos // 8 AS frame_idx, count(*) AS n, sqrt(avg(x * x)) AS rms, avg(x) AS mean
  FROM sig GROUP BY 1, 2)"""


def _frames(spark, d):
    return frames.frame_rms(sig_events(spark, d), FRAME)


@query(f"""WITH {FR}
SELECT signal_id, frame_idx, n, round(rms, 6) AS rms FROM fr""")
def q_frame_rms(spark, d):
    return rounded(_frames(spark, d).select(KEY, "frame_idx", "n", "rms"))


@query(f"""WITH {SIG}, o AS (
  SELECT signal_id, unnest(range(greatest(0, CAST(ceil((pos - 7) / 2.0) AS BIGINT)), pos // 2 + 1)) AS frame_idx, x FROM sig)
SELECT signal_id, frame_idx, count(*) AS n, round(avg(x), 6) AS mean, round(sqrt(avg(x * x)), 6) AS rms
FROM o GROUP BY 1, 2 HAVING count(*) = 8""")
def q_frames_overlap(spark, d):
    framed = frames.frame_rms(sig_events(spark, d), FRAME, 2)
    return rounded(framed.where(F.col("n") == FRAME).select(KEY, "frame_idx", "n", "mean", "rms"))


@query(f"""WITH {FR}, v AS (SELECT * FROM fr WHERE frame_idx < 8 AND rms >= 80)
SELECT signal_id, frame_idx, round(rms, 6) AS rms FROM v
UNION ALL
SELECT DISTINCT signal_id, CAST(-1 AS BIGINT), CAST(NULL AS DOUBLE) FROM fr WHERE signal_id NOT IN (SELECT signal_id FROM v)""")
def q_valid_frames(spark, d):
    all_frames = _frames(spark, d)
    kept = frames.valid_frames(all_frames, LOUD, 8).select(KEY, "frame_idx", "rms")
    none = frames.signals_without(read(spark, d, "events").select(F.col("user_id").alias(KEY)), kept)
    marked = none.select(KEY, F.lit(-1).cast("long").alias("frame_idx"), F.lit(None).cast("double").alias("rms"))
    return rounded(kept.unionByName(marked))


@query(f"""WITH {FR}
SELECT signal_id, round(max(rms), 6) AS max_rms FROM fr GROUP BY 1 HAVING max(rms) < 100""")
def q_too_quiet(spark, d):
    return rounded(frames.too_quiet(_frames(spark, d), QUIET))


@query(f"""WITH {FR}
SELECT signal_id, round(max(rms) / avg(rms), 6) AS crest_factor FROM fr WHERE rms >= 80 GROUP BY 1""")
def q_crest(spark, d):
    return rounded(frames.valid_frames(_frames(spark, d), LOUD).groupBy(KEY).agg(features.crest()))


@query(f"""WITH {FR}
SELECT signal_id, round(avg(log10(rms)), 6) AS log_rms_avg, round(stddev_pop(log10(rms)), 6) AS log_rms_std,
       round(min(log10(rms)), 6) AS log_rms_min, round(max(log10(rms)), 6) AS log_rms_max
FROM fr WHERE rms >= 80 GROUP BY 1""")
def q_log_rms(spark, d):
    ops = ("avg", "std", "min", "max")
    loud = frames.valid_frames(_frames(spark, d), LOUD)
    return rounded(loud.groupBy(KEY).agg(*summaries(log10_pos("rms"), "log_rms", ops)))


def gradient_sql(src: str, value: str, name: str, group: str = "signal_id", order: str = "frame_idx") -> str:
    """CTEs g1, g2 (gradient per row) of ``value`` over the rows of ``src``."""
    w = f"(PARTITION BY {group} ORDER BY {order})"
    return f"""g1 AS (
  SELECT {group}, {order} AS o, v, lag(v) OVER w AS b, lead(v) OVER w AS a,
         row_number() OVER w AS i, count(*) OVER (PARTITION BY {group}) AS n
  FROM (SELECT {group}, {order}, {value} AS v FROM {src}) WINDOW w AS {w}),
g2 AS (SELECT {group}, o, n, CASE WHEN n = 1 THEN NULL WHEN i = 1 THEN a - v WHEN i = n THEN v - b ELSE (a - b) / 2 END AS d FROM g1),
g3 AS (SELECT *, lag(d) OVER (PARTITION BY {group} ORDER BY o) AS p FROM g2),
{name} AS (
  SELECT {group}, avg(d) AS d_avg, max(d) AS d_max, min(d) AS d_min, stddev_pop(d) AS d_std,
         CASE WHEN max(n) > 1 THEN CAST(sum(CASE WHEN sign(d) <> sign(p) THEN 1 ELSE 0 END) AS DOUBLE) / count(*) END AS d_zcr
  FROM g3 GROUP BY 1)"""


@query(f"""WITH {FR}, {gradient_sql('(SELECT * FROM fr WHERE rms >= 80)', 'log10(rms)', 'g')}
SELECT signal_id, round(d_avg, 6) AS log_rms_d_avg, round(d_max, 6) AS log_rms_d_max, round(d_min, 6) AS log_rms_d_min,
       round(d_std, 6) AS log_rms_d_std, round(d_zcr, 6) AS log_rms_d_zcr FROM g""")
def q_gradient_stats(spark, d):
    loud = frames.ranked(frames.valid_frames(_frames(spark, d), LOUD), bounded=False)
    steps = frames.gradients(loud, {"log_rms": log10_pos("rms")})
    made = steps.groupBy(KEY).agg(*features.gradient_summaries("log_rms", ["avg", "max", "min", "std", "zcr"]))
    return rounded(features.gradient_zcr_guard(made, "log_rms"))


ZC = SIG + """, c AS (SELECT signal_id, pos, pos // 8 AS frame_idx, x, x - avg(x) OVER (PARTITION BY signal_id) AS y FROM sig),
s AS (SELECT *, lag(y) OVER (PARTITION BY signal_id, frame_idx ORDER BY pos) AS p FROM c),
z AS (SELECT signal_id, frame_idx, sqrt(avg(y * y)) AS rms,
             CAST(sum(CASE WHEN (y < 0) <> (p < 0) THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS zcr FROM s GROUP BY 1, 2)"""


@query(f"""WITH {ZC}
SELECT signal_id, round(avg(zcr), 6) AS zcr_avg, round(min(zcr), 6) AS zcr_min, round(max(zcr), 6) AS zcr_max,
       round(stddev_pop(zcr), 6) AS zcr_std, round(arg_min(zcr, {{'a': -rms, 'b': frame_idx}}), 6) AS zcr_loudest
FROM z GROUP BY 1""")
def q_zcr(spark, d):
    packed = frames.frame_arrays(sig_events(spark, d), FRAME)
    values = frames.describe_arrays(packed).select(KEY, "frame_idx", "zcr", F.col("rms_centred").alias("rms"))
    return rounded(values.groupBy(KEY).agg(*features.zcr_group()))


ENV = FR + """, pk AS (SELECT signal_id, max(rms) AS top, arg_min(frame_idx, {'a': -rms, 'b': frame_idx}) AS peak FROM fr GROUP BY 1),
sp AS (SELECT signal_id, min(frame_idx) AS f, max(frame_idx) AS l, any_value(peak) AS peak
       FROM fr JOIN pk USING (signal_id) WHERE rms >= 0.5 * top GROUP BY 1),
en AS (SELECT signal_id, any_value(peak) AS peak, any_value(f) AS f, any_value(l) AS l, sum(rms * rms) AS p,
              sum(rms * rms * CASE WHEN l = f THEN 0 ELSE CAST(frame_idx - f AS DOUBLE) / (l - f) END) AS pw
       FROM fr JOIN sp USING (signal_id) WHERE frame_idx BETWEEN f AND l GROUP BY 1),
ev AS (SELECT signal_id, log10(CASE WHEN peak > f THEN peak - f ELSE 0.5 END) AS log_attack_time,
              CASE WHEN p > 0 THEN pw / p END AS temporal_centroid,
              CAST(l - f + 1 AS DOUBLE) AS duration, CAST(l - peak AS DOUBLE) AS release FROM en)"""
ENV_COLUMNS = """round(log_attack_time, 6) AS log_attack_time, round(temporal_centroid, 6) AS temporal_centroid,
       round(CASE WHEN temporal_centroid > 0 THEN log_attack_time / temporal_centroid END, 6) AS lat_tc_ratio,
       duration, release"""


@query(f"WITH {ENV} SELECT signal_id, {ENV_COLUMNS} FROM ev")
def q_envelope(spark, d):
    return rounded(features.envelope(_frames(spark, d), 1.0, LOUD_SHARE))


@query(f"""WITH {ENV}, {ZC.removeprefix(SIG + ', ')},
v AS (SELECT * FROM fr WHERE rms >= 80),
{gradient_sql('v', 'log10(rms)', 'g')},
r AS (SELECT signal_id, max(rms) / avg(rms) AS crest_factor, avg(log10(rms)) AS a, stddev_pop(log10(rms)) AS s,
             min(log10(rms)) AS mi, max(log10(rms)) AS ma FROM v GROUP BY 1),
zz AS (SELECT v.signal_id, avg(zcr) AS za, min(zcr) AS zi, max(zcr) AS zm, stddev_pop(zcr) AS zs,
              arg_min(zcr, {{'a': -v.rms, 'b': v.frame_idx}}) AS zl
       FROM v JOIN z ON v.signal_id = z.signal_id AND v.frame_idx = z.frame_idx GROUP BY 1)
SELECT ev.signal_id, {ENV_COLUMNS}, round(crest_factor, 6) AS crest_factor,
  round(a, 6) AS log_rms_avg, round(s, 6) AS log_rms_std, round(mi, 6) AS log_rms_min, round(ma, 6) AS log_rms_max,
  round(d_avg, 6) AS log_rms_d_avg, round(d_max, 6) AS log_rms_d_max, round(d_min, 6) AS log_rms_d_min,
  round(d_std, 6) AS log_rms_d_std, round(d_zcr, 6) AS log_rms_d_zcr,
  round(za, 6) AS zcr_avg, round(zi, 6) AS zcr_min, round(zm, 6) AS zcr_max, round(zs, 6) AS zcr_std, round(zl, 6) AS zcr_loudest
FROM ev LEFT JOIN r USING (signal_id) LEFT JOIN g USING (signal_id) LEFT JOIN zz USING (signal_id)""")
def q_feature_vector(spark, d):
    # the frame table is what everything after reads: written once, a few numbers per frame
    table = stored(frames.describe_arrays(frames.frame_arrays(sig_events(spark, d), FRAME)).drop("rms_centred"), "frames")
    valid = frames.ranked(frames.valid_frames(table, LOUD), bounded=False)
    made = features.summary_features(valid, ("rms", "zcr"))
    return rounded(features.envelope(table, 1.0, LOUD_SHARE).join(made, KEY, "left"))


@query(f"""WITH {SIG}
SELECT signal_id, pos, x / max(abs(x)) OVER (PARTITION BY signal_id) AS y FROM sig""")
def q_peak_normalise(spark, d):
    # one division of stored values: equal to the last bit, so nothing is rounded
    return series.peak_normalise(sig_events(spark, d)).select(KEY, "pos", "y")


@query(f"""WITH {SIG}, k AS (SELECT *, count(*) OVER (PARTITION BY signal_id) AS n FROM sig)
SELECT signal_id, pos, x FROM k WHERE pos >= n // 4 AND pos < n // 2""")
def q_signal_slice(spark, d):
    points = sig_events(spark, d)
    n = F.col("n")
    bounds = series.lengths(points).select(KEY, "n", F.floor(n / 4).alias("start"), F.floor(n / 2).alias("end"))
    return series.slice_points(points, bounds).select(KEY, "pos", "x")


@query(f"""WITH {SIG}, k AS (SELECT signal_id, count(*) AS n FROM sig GROUP BY 1),
t AS (SELECT signal_id, unnest(range(0, CAST(floor((n - 1) / 1.5) AS BIGINT) + 1)) AS j FROM k)
SELECT t.signal_id, t.j, round(a.x + (j * 1.5 - a.pos) * coalesce(b.x - a.x, 0), 6) AS x
FROM t JOIN sig a ON a.signal_id = t.signal_id AND a.pos = CAST(floor(j * 1.5) AS BIGINT)
LEFT JOIN sig b ON b.signal_id = a.signal_id AND b.pos = a.pos + 1""")
def q_resample_linear(spark, d):
    return rounded(series.resample_linear(sig_events(spark, d), 1.5))


@query(f"""WITH {SIG}, k AS (SELECT signal_id, count(*) AS n FROM sig GROUP BY 1),
t AS (SELECT signal_id, unnest(range(0, CAST(ceil(n * 2 / 3.0) AS BIGINT))) AS j FROM k),
i AS (SELECT signal_id, j, j * 3 // 2 + i AS pos, i - (j * 3 % 2) / 2.0::DOUBLE AS u FROM t, range(-2, 4) r(i)),
w AS (SELECT *, CASE WHEN abs(u) >= 3 THEN 0 WHEN u = 0 THEN 1
        ELSE sin(pi() * u * 2 / 3) / (pi() * u * 2 / 3) * (0.5 + 0.5 * cos(pi() * u / 3)) END AS weight FROM i)
SELECT w.signal_id, w.j, round(sum(weight * coalesce(x, 0)) / sum(weight), 6) AS x
FROM w LEFT JOIN sig ON sig.signal_id = w.signal_id AND sig.pos = w.pos GROUP BY 1, 2""")
def q_resample(spark, d):
    """Two thirds of the rate, through a short filter."""
    return rounded(series.resample(sig_events(spark, d), 2, 3, zeros=2, size=64))


@query(f"WITH {SIG} SELECT signal_id, pos, CAST(x AS FLOAT) AS x, 8000 AS sample_rate FROM sig")
def q_wav_round_trip(spark, d):
    """Signals as float wav files of at most 4,096 samples, written by the sink and read by the source."""
    parts = sig_events(spark, d).withColumn("part", F.floor(F.col("pos") / 4096))
    clips = parts.groupBy(KEY, "part").agg(F.sort_array(F.collect_list(F.struct("pos", "x")))["x"].alias("x"))
    out = scratch_path(spark, "clips")
    wav.write_wav(clips.withColumn("name", F.concat_ws("_", KEY, "part", F.lit(".wav"))), out, 8000, "float")
    read_back = wav.read_wav(spark, out, ["path", "sample_rate", "x"])
    named = read_back.withColumn("name", F.split(F.element_at(F.split("path", "/"), -1), "_"))
    rows = named.select(F.col("name")[0].cast("long").alias(KEY), F.col("name")[1].cast("long").alias("part"), "sample_rate", F.posexplode("x").alias("at", "x"))
    return rows.select(KEY, (F.col("part") * 4096 + F.col("at")).alias("pos"), "x", "sample_rate")


SPAN = """t AS (SELECT user_id AS signal_id, min(epoch_us(ts)) AS t0, max(epoch_us(ts)) AS t1, count(*) AS n,
  min(CASE WHEN event_type = 'click' THEN epoch_us(ts) END) AS c,
  max(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) AS p FROM events GROUP BY 1),
du AS (SELECT signal_id, n, (t1 - t0) / 1e6 AS orig_duration, coalesce((c - t0) / 1e6, 0) AS start_time,
  CASE WHEN p > c THEN (p - t0) / 1e6 END AS end_time FROM t)"""


def _spans(spark, d):
    events = read(spark, d, "events")
    at = micros(events, "ts")
    click = F.min(F.when(F.col("event_type") == "click", at))
    bought = F.max(F.when(F.col("event_type") == "purchase", at))
    ends = events.groupBy(F.col("user_id").alias(KEY)).agg(
        F.min(at).alias("t0"), F.max(at).alias("t1"), click.alias("c"), bought.alias("p"), F.count(F.lit(1)).alias("n")
    )
    seconds = lambda c: (F.col(c) - F.col("t0")) / 1e6
    return catalog.durations(
        ends.select(
            KEY,
            "n",
            seconds("t1").alias("orig_duration"),
            F.coalesce(seconds("c"), F.lit(0.0)).alias("start_time"),
            F.when(F.col("p") > F.col("c"), seconds("p")).alias("end_time"),
        )
    )


@query(f"""WITH {SPAN}
SELECT signal_id, round(orig_duration, 6) AS orig_duration, round(start_time, 6) AS start_time,
       round(end_time, 6) AS end_time, round(coalesce(end_time, orig_duration) - start_time, 6) AS new_duration FROM du""")
def q_durations(spark, d):
    return rounded(_spans(spark, d).drop("n"))


def _routed(spark, d):
    first = F.min_by("event_type", F.struct("ts", "event_id"))
    starts = read(spark, d, "events").groupBy(F.col("user_id").alias(KEY)).agg(first.alias("kind"))
    loud = _frames(spark, d).groupBy(KEY).agg(F.max("rms").alias("max_rms"))
    facts = _spans(spark, d).join(starts, KEY).join(loud, KEY)
    kind = F.col("kind")
    return catalog.route(
        facts,
        [
            ("unreadable", F.col("n") < 55),
            ("blacklisted", kind == "error"),
            ("ignored", kind == "signup"),
            ("unlabelled", kind == "view"),
            ("too_long", catalog.too_long(2_400_000.0)),
            ("too_quiet", F.col("max_rms") < QUIET),
        ],
    )


@query(f"""WITH {SPAN}, {FR}, k AS (SELECT user_id AS signal_id, arg_min(event_type, {{'a': ts, 'b': event_id}}) AS kind FROM events GROUP BY 1),
m AS (SELECT signal_id, max(rms) AS max_rms FROM fr GROUP BY 1)
SELECT signal_id, CASE WHEN n < 55 THEN 'unreadable' WHEN kind = 'error' THEN 'blacklisted' WHEN kind = 'signup' THEN 'ignored'
  WHEN kind = 'view' THEN 'unlabelled' WHEN coalesce(end_time, orig_duration) - start_time >= 2400000 THEN 'too_long'
  WHEN max_rms < 100 THEN 'too_quiet' END AS reason
FROM du JOIN k USING (signal_id) JOIN m USING (signal_id)""")
def q_reject_routing(spark, d):
    return _routed(spark, d).select(KEY, "reason")


BAND_SUMS = ",\n".join(
    f"sum(CASE WHEN event_type = '{b}' THEN value ELSE 0 END) AS {b}" for b in BANDS
)
ONSET = f"""dy AS (SELECT user_id AS signal_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS day,
{BAND_SUMS} FROM events GROUP BY 1, 2),
gr AS (SELECT signal_id, f, unnest(range(f, l + 1)) AS day FROM (SELECT signal_id, min(day) AS f, max(day) AS l FROM dy GROUP BY 1)),
pw AS (SELECT gr.signal_id, gr.day - f AS frame_idx, unnest([{', '.join(f"coalesce({b}, 0)" for b in BANDS)}]) AS p,
       unnest([0, 1, 2, 3, 4]) AS band FROM gr LEFT JOIN dy ON dy.signal_id = gr.signal_id AND dy.day = gr.day),
db AS (SELECT signal_id, frame_idx, band, greatest(v, max(v) OVER (PARTITION BY signal_id) - 80) AS v
       FROM (SELECT *, 10 * log10(greatest(p, 1e-10)) AS v FROM pw)),
ri AS (SELECT signal_id, frame_idx, greatest(coalesce(v - lag(v) OVER (PARTITION BY signal_id, band ORDER BY frame_idx), 0), 0) AS r FROM db),
fl AS (SELECT signal_id, frame_idx, avg(r) AS flux FROM ri GROUP BY 1, 2),
st AS (SELECT signal_id, frame_idx, coalesce((flux - min(flux) OVER s) / nullif(max(flux) OVER s - min(flux) OVER s, 0), 0) AS strength
       FROM fl WINDOW s AS (PARTITION BY signal_id))"""


def _strength(spark, d):
    return onsets.onset_envelope(onsets.day_bands(read(spark, d, "events"), BANDS))


@query(f"WITH {ONSET} SELECT signal_id, frame_idx, round(strength, 6) AS strength FROM st")
def q_onset_envelope(spark, d):
    return rounded(_strength(spark, d))


@query(f"""WITH {ONSET}, mk AS (
  SELECT signal_id, frame_idx, strength, max(strength) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS top,
         avg(strength) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS mean
  FROM st WINDOW w AS (PARTITION BY signal_id ORDER BY frame_idx)),
pk AS (SELECT signal_id, CASE WHEN strength = top AND strength >= mean + 0.07 THEN frame_idx END AS spot FROM mk),
f1 AS (SELECT signal_id, min(spot) AS first FROM pk GROUP BY 1),
f2 AS (SELECT signal_id, any_value(first) AS first_onset, min(CASE WHEN spot > first + 2 THEN spot END) AS second_onset
       FROM pk JOIN f1 USING (signal_id) GROUP BY 1)
SELECT signal_id, first_onset, second_onset, round(coalesce(greatest(first_onset - 1.01e0, 0), 0), 6) AS start_time,
       round(second_onset - 1.01e0, 6) AS end_time FROM f2""".replace("any_value(first) AS first_onset", "min(first) AS first_onset"))
def q_onsets(spark, d):
    found = onsets.first_two_onsets(_strength(spark, d), 2, 3, 0.07, 2)
    return rounded(onsets.sound_span(found, 1.0, 1.0, 0.01))


@query(f"""WITH {ONSET}, mk AS (
  SELECT signal_id, frame_idx, strength, max(strength) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS top,
         avg(strength) OVER (w ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS mean
  FROM st WINDOW w AS (PARTITION BY signal_id ORDER BY frame_idx)),
pk AS (SELECT signal_id, list_transform(list(frame_idx ORDER BY frame_idx), lambda x: [x]) AS spots FROM mk
       WHERE strength = top AND strength >= mean + 0.07 GROUP BY 1)
SELECT signal_id, unnest(list_reduce(spots, lambda a, x: CASE WHEN x[1] > a[len(a)] + 5 THEN list_concat(a, x) ELSE a END)) AS frame_idx FROM pk""")
def q_onset_list(spark, d):
    """Every onset more than five days after the one before, from chunks of eight days."""
    days = onsets.day_bands(read(spark, d, "events"), BANDS)
    return onset_lists.onset_list(days, 2, 3, 0.07, 5, size=8, fan=4)


def _dft_sql() -> str:
    w = hann(FRAME)
    rows = ", ".join(
        f"({k}, {i}, {w[i] * math.cos(2 * math.pi * k * i / FRAME)!r}, {-w[i] * math.sin(2 * math.pi * k * i / FRAME)!r})"
        for k in range(FRAME // 2 + 1)
        for i in range(FRAME)
    )
    return f"""{SIG}, basis(bin, i, c, s) AS (VALUES {rows}),
full_frames AS (SELECT signal_id, pos // 8 AS frame_idx FROM sig GROUP BY 1, 2 HAVING count(*) = 8),
dft AS (SELECT sig.signal_id, pos // 8 AS frame_idx, bin, sqrt(pow(sum(x * c), 2) + pow(sum(x * s), 2)) AS mag
        FROM sig JOIN full_frames f ON f.signal_id = sig.signal_id AND f.frame_idx = pos // 8
        JOIN basis ON i = pos % 8 GROUP BY 1, 2, 3)"""


def _spectra(spark, d):
    packed = frames.frame_arrays(sig_events(spark, d), FRAME).where(F.col("n") == FRAME)
    return packed.select(KEY, "frame_idx", dft_magnitude(F.col("frame"), FRAME).alias("mag"))


@query(f"WITH {_dft_sql()} SELECT signal_id, frame_idx, CAST(bin AS INTEGER) AS bin, round(mag, 5) AS mag FROM dft")
def q_dft_small(spark, d):
    return rounded(_spectra(spark, d).select(KEY, "frame_idx", F.posexplode("mag").alias("bin", "mag")), 5)


@query(f"WITH {_dft_sql()} SELECT signal_id, frame_idx, CAST(bin AS INTEGER) AS bin, round(mag, 5) AS mag FROM dft")
def q_fft_small(spark, d):
    packed = frames.frame_arrays(sig_events(spark, d), FRAME).where(F.col("n") == FRAME)
    mags = packed.select(KEY, "frame_idx", F.posexplode(fft.magnitude(F.col("frame"), FRAME)).alias("bin", "mag"))
    return rounded(mags, 5)


@query(f"""WITH {SIG}, full_frames AS (SELECT signal_id, pos // 32 AS frame_idx FROM sig GROUP BY 1, 2 HAVING count(*) = 32),
w AS (SELECT signal_id, pos // 32 AS frame_idx, pos % 32 AS i, x * (0.5 - 0.5 * cos(2 * pi() * (pos % 32) / 32)) AS x
      FROM sig JOIN full_frames f USING (signal_id) WHERE f.frame_idx = pos // 32)
SELECT signal_id, frame_idx, CAST(k AS INTEGER) AS bin,
       round(sqrt(pow(sum(x * cos(2 * pi() * (k * i % 32) / 32)), 2) + pow(sum(x * sin(2 * pi() * (k * i % 32) / 32)), 2)), 5) AS mag
FROM w, range(0, 17) r(k) GROUP BY 1, 2, 3""")
def q_fft_frames(spark, d):
    packed = frames.frame_arrays(sig_events(spark, d), 32).where(F.col("n") == 32)
    mags = packed.select(KEY, "frame_idx", F.posexplode(fft.magnitude(F.col("frame"), 32)).alias("bin", "mag"))
    return rounded(mags, 5)


@query(f"""WITH {_dft_sql()}
SELECT signal_id, frame_idx, round(sqrt(2 * sum(mag * mag * CASE WHEN bin IN (0, 4) THEN 0.5 ELSE 1 END) / 64), 5) AS rms
FROM dft GROUP BY 1, 2""")
def q_frame_rms_spec(spark, d):
    spectra = _spectra(spark, d)
    return rounded(spectra.select(KEY, "frame_idx", rms_of_spectrum(F.col("mag"), FRAME).alias("rms")), 5)


@query(f"""WITH {FR}, m AS (SELECT signal_id, max(rms) AS max_rms FROM fr GROUP BY 1)
SELECT c_custkey AS "key", CASE WHEN max_rms IS NULL THEN 'Unreadable' WHEN max_rms < 100 THEN 'Too quiet'
  WHEN max_rms < 160 THEN 'mid' ELSE 'loud' END AS outcome
FROM customer LEFT JOIN m ON signal_id = c_custkey""")
def q_keyed_scoring(spark, d):
    requested = read(spark, d, "customer").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias(KEY))
    loud = _frames(spark, d).groupBy(KEY).agg(F.max("rms").alias("max_rms"))
    band = F.when(F.col("max_rms") < 160, "mid").otherwise("loud")
    scored = loud.where(F.col("max_rms") >= QUIET).select(KEY, band.alias("predicted"))
    rejects = loud.where(F.col("max_rms") < QUIET).select(KEY, F.lit("too_quiet").alias("reason"))
    return catalog.keyed_outcome(requested, scored, rejects).select("key", "outcome")
