"""Queries on spectra, paths, labels and feature rows made from the other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from sigspark.config import DEFAULT
from sigspark.functions import arrays as A
from sigspark.functions import scalars as S
from sigspark.functions.summaries import at_loudest, summaries
from sigspark.operators import augment, catalog, evaluate, frames, neighbours, prepare, ranking, spectral, wordjoin
from sigspark.operators.features import gradient_summaries, gradient_zcr_guard
from sigspark.plans.book import query, rounded
from sigspark.plans.signal_queries import gradient_sql
from sigspark.sources import adapters
from sigspark.sources.adapters import PART_BLACK, PART_CLASSES, PART_IGNORE, feat_embeddings, path_parts, read
from sigspark.sources.words import split_words

BINS = 64
RATE = DEFAULT.sample_rate
SEED = DEFAULT.seed

# ---- spectra --------------------------------------------------------------------

SP = """sp AS (SELECT vec_id, label AS signal_id, abs(CAST(unnest(embedding) AS DOUBLE)) AS m,
  unnest(range(0, len(embedding))) AS bin FROM embeddings),
fq AS (SELECT *, bin * 22050 / 126.0 AS f, sum(m) OVER (PARTITION BY vec_id) AS t FROM sp),
fs AS (SELECT vec_id, signal_id, sum(f * m) / sum(m) AS cent,
  sqrt(2 * sum(m * m * CASE WHEN bin IN (0, 63) THEN 0.5 ELSE 1 END) / (126 * 126)) AS rms,
  exp(avg(ln(greatest(m * m, 1e-10)))) / avg(greatest(m * m, 1e-10)) AS flat FROM fq GROUP BY 1, 2)"""
LOUDEST = "arg_min({}, {{'a': -rms, 'b': vec_id}})"


def _series(spark, d, *columns):
    """Narrow series first, frame numbers after: spectra never pass a shuffle."""
    series = spectral.spectrum_series(adapters.spec_embeddings(spark, d), BINS, RATE, ("rms", *columns))
    return adapters.number_frames(series.select("signal_id", "vec_id", "rms", *columns))


def _with_gradient(rows, name, value):
    return frames.gradients(rows.withColumn("place", F.col("frame_idx")), {name: value})


def _loud(value, name):
    return at_loudest(value, F.col("rms"), F.col("frame_idx"), name)


@query(f"""WITH {SP}, {gradient_sql('fs', 'log10(cent)', 'g', order='vec_id')},
a AS (SELECT signal_id, avg(log10(cent)) AS av, min(log10(cent)) AS mi, max(log10(cent)) AS ma, stddev_pop(log10(cent)) AS sd,
      {LOUDEST.format('log10(cent)')} AS lo FROM fs GROUP BY 1)
SELECT signal_id, round(av, 6) AS log_spec_cent_avg, round(mi, 6) AS log_spec_cent_min, round(ma, 6) AS log_spec_cent_max,
  round(sd, 6) AS log_spec_cent_std, round(lo, 6) AS log_spec_cent_loudest, round(d_avg, 6) AS log_spec_cent_d_avg,
  round(d_max, 6) AS log_spec_cent_d_max, round(d_min, 6) AS log_spec_cent_d_min, round(d_std, 6) AS log_spec_cent_d_std,
  round(d_zcr, 6) AS log_spec_cent_d_zcr FROM a JOIN g USING (signal_id)""")
def q_spec_centroid(spark, d):
    name, value = "log_spec_cent", S.log10_pos("centroid")
    rows = _with_gradient(_series(spark, d, "centroid"), name, value)
    made = rows.groupBy("signal_id").agg(
        *summaries(value, name),
        _loud(value, f"{name}_loudest"),
        *gradient_summaries(name, ["avg", "max", "min", "std", "zcr"]),
    )
    return rounded(gradient_zcr_guard(made, name))


@query(f"""WITH {SP}, bw AS (SELECT fq.signal_id, vec_id, sqrt(sum(m * pow(f - cent, 2)) / sum(m)) AS band
  FROM fq JOIN fs USING (vec_id) GROUP BY 1, 2), {gradient_sql('bw', 'log10(band)', 'g', order='vec_id')},
a AS (SELECT signal_id, avg(log10(band)) AS av, min(log10(band)) AS mi, max(log10(band)) AS ma, stddev_pop(log10(band)) AS sd
      FROM bw GROUP BY 1)
SELECT signal_id, round(av, 6) AS log_spec_band_avg, round(mi, 6) AS log_spec_band_min, round(ma, 6) AS log_spec_band_max,
  round(sd, 6) AS log_spec_band_std, round(d_avg, 6) AS log_spec_band_d_avg FROM a JOIN g USING (signal_id)""")
def q_spec_bandwidth(spark, d):
    name, value = "log_spec_band", S.log10_pos("bandwidth")
    rows = _with_gradient(_series(spark, d, "bandwidth"), name, value)
    return rounded(rows.groupBy("signal_id").agg(*summaries(value, name), *gradient_summaries(name, ["avg"])))


@query(f"""WITH {SP}, {gradient_sql('fs', 'flat', 'g', order='vec_id')},
a AS (SELECT signal_id, avg(flat) AS av, min(flat) AS mi, max(flat) AS ma, stddev_pop(flat) AS sd,
      {LOUDEST.format('flat')} AS lo FROM fs GROUP BY 1)
SELECT signal_id, round(av, 6) AS spec_flat_avg, round(mi, 6) AS spec_flat_min, round(ma, 6) AS spec_flat_max,
  round(sd, 6) AS spec_flat_std, round(lo, 6) AS spec_flat_loudest, round(d_avg, 6) AS spec_flat_d_avg
FROM a JOIN g USING (signal_id)""")
def q_spec_flatness(spark, d):
    name, value = "spec_flat", F.col("flatness")
    rows = _with_gradient(_series(spark, d, "flatness"), name, value)
    return rounded(
        rows.groupBy("signal_id").agg(
            *summaries(value, name), _loud(value, f"{name}_loudest"), *gradient_summaries(name, ["avg"])
        )
    )


def _rolloff_sql() -> str:
    columns, parts = [], []
    for s in (15, 85):
        parts.append(f"min(CASE WHEN cum >= 0.{s} * t THEN f END) AS r{s}")
        log = f"CASE WHEN r{s} > 0 THEN log10(r{s}) END"
        columns += [
            f"round(arg_min_null({log}, {{'a': -rms, 'b': vec_id}}), 6) AS log_spec_rolloff_{s}_loudest",
            f"round(max({log}), 6) AS log_spec_rolloff_{s}_max",
            f"round(min({log}), 6) AS log_spec_rolloff_{s}_min",
        ]
    return f"""WITH {SP}, cu AS (SELECT *, sum(m) OVER (PARTITION BY vec_id ORDER BY bin) AS cum FROM fq),
ro AS (SELECT vec_id, {', '.join(parts)} FROM cu GROUP BY 1)
SELECT signal_id, {', '.join(columns)} FROM fs JOIN ro USING (vec_id) GROUP BY 1"""


@query(_rolloff_sql())
def q_spec_rolloff(spark, d):
    rows = _series(spark, d, "rolloff_15", "rolloff_85")
    aggs = []
    for s in (15, 85):
        value, name = S.log10_pos(f"rolloff_{s}"), f"log_spec_rolloff_{s}"
        aggs += [_loud(value, f"{name}_loudest"), F.max(value).alias(f"{name}_max"), F.min(value).alias(f"{name}_min")]
    return rounded(rows.groupBy("signal_id").agg(*aggs))


@query(f"""WITH {SP}
SELECT vec_id, CAST(c AS INTEGER) AS coef, round(sum(m * sqrt(2 / 64.0) * cos(pi() * c * (2 * bin + 1) / 128.0)), 6) AS v
FROM sp, (SELECT unnest(range(1, 13)) AS c) GROUP BY 1, 2""")
def q_dct(spark, d):
    mag = adapters.vector_frames(spark, d)
    coefs = mag.select("vec_id", F.posexplode(A.cepstrum(F.col("mag"), BINS)).alias("place", "v"))
    return rounded(coefs.select("vec_id", (F.col("place") + 1).alias("coef"), "v"))


MEL = A.mel_weights(8, BINS, RATE)


@query(f"""WITH {SP}, w(band, bin, w) AS (VALUES {', '.join(f'({b}, {i}, {v!r})' for b, row in enumerate(MEL) for i, v in enumerate(row) if v)})
SELECT vec_id, CAST(band AS INTEGER) AS band, round(sum(m * w) * 1000, 6) AS energy FROM sp JOIN w USING (bin) GROUP BY 1, 2""")
def q_mel_bands(spark, d):
    mag = adapters.vector_frames(spark, d)
    bands = mag.select("vec_id", F.posexplode(A.mel_bands(F.col("mag"), MEL)).alias("band", "e"))
    return rounded(bands.select("vec_id", "band", (F.col("e") * 1000).alias("energy")))


@query(f"""WITH {SP}, st AS (SELECT avg(m) AS mean, stddev_pop(m) AS std FROM sp)
SELECT vec_id, CAST(bin AS INTEGER) AS bin, round((m - mean) / std, 6) AS z FROM sp, st""")
def q_tensor_norm(spark, d):
    mag = adapters.vector_frames(spark, d)
    stats = spectral.cell_statistics(mag, "mag")
    known = mag.withColumn("mean", stats.select("mean").scalar()).withColumn("std", stats.select("std").scalar())
    z = A.normalise(F.array("mag"), F.col("mean"), F.col("std"))
    return rounded(known.select("vec_id", F.posexplode(z[0]).alias("bin", "z")))


@query(f"""WITH {SP}, t AS (SELECT vec_id, list(m ORDER BY bin) AS a FROM sp GROUP BY 1),
x AS (SELECT vec_id, a, list_max(a) AS top, list_transform(a, lambda v: 20 * log10(greatest(v, 1e-5))) AS db,
      list_sum(list_transform(a, lambda v: exp(v - list_max(a)))) AS e FROM t)
SELECT vec_id, CAST(len(a) + 3 AS INTEGER) AS n_lead, round(list_sum(a[1:32]), 6) AS cut_sum, CAST(80 AS INTEGER) AS n_fit,
  round(list_sum(a), 6) AS fit_sum, round(list_max(db), 6) AS db_max,
  round(list_min(list_transform(db, lambda v: greatest(v, list_max(db) - 80))), 6) AS db_min,
  round(-ln(e), 6) AS best_log_softmax, CAST(list_position(a, top) - 1 AS INTEGER) AS best, round(a[8], 6) AS eighth,
  round(list_sum(list_transform(range(5), lambda i: i / 4.0)), 6) AS step_sum, CAST(1 AS INTEGER) AS channels
FROM x""")
def q_array_pack(spark, d):
    mag = F.col("mag")
    db = A.decibel_array(mag)
    made = adapters.vector_frames(spark, d).select(
        "vec_id",
        F.size(A.lead_silence(mag, 3)).alias("n_lead"),
        A.total(A.fit_width(mag, 32)).alias("cut_sum"),
        F.size(A.fit_width(mag, 80)).alias("n_fit"),
        A.total(A.fit_width(mag, 80)).alias("fit_sum"),
        F.array_max(db).alias("db_max"),
        F.array_min(db).alias("db_min"),
        F.array_max(A.log_softmax(mag)).alias("best_log_softmax"),
        A.first_argmax(mag).alias("best"),
        F.get(F.slice(mag, 8, 1), F.lit(0)).alias("eighth"),
        A.total(A.steps(5)).alias("step_sum"),
        F.size(A.with_channel(F.array(mag))).alias("channels"),
    )
    return rounded(made)


# ---- paths and catalog -------------------------------------------------------------


def _contains(words, text="lower(p_name)"):
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _first(text):
    return "CASE " + " ".join(f"WHEN contains({text}, '{c}') THEN '{c}'" for c in PART_CLASSES) + " END"


def _rules_sql(compat: bool) -> str:
    stripped = "replace(lower(p_name), 'large', '')"
    again = "CASE WHEN contains(lower(p_name), 'ring') THEN 'ring' END" if compat else _first(stripped)
    return f"""ru AS (SELECT p_partkey AS signal_id, p_name AS path, {_first('lower(p_name)')} AS plain,
  {_contains(PART_BLACK)} AS black, {_contains(PART_IGNORE)} AS has_ignored, {again} AS again FROM part),
la AS (SELECT signal_id, path, CASE WHEN plain IS NOT NULL AND NOT black THEN CASE WHEN has_ignored THEN again ELSE plain END END AS label,
  CASE WHEN plain IS NULL THEN 'unlabelled' WHEN black THEN 'blacklisted' WHEN has_ignored AND again IS NULL THEN 'ignored' END AS reason FROM ru)"""


def _labelled(spark, d, compat=False):
    label, reason = catalog.label_rules("path", PART_CLASSES, PART_BLACK, PART_IGNORE, compat=compat)
    return path_parts(spark, d).select("signal_id", "path", label.alias("label"), reason.alias("reason"))


@query(f"WITH {_rules_sql(False)} SELECT * FROM la")
def q_label_rules(spark, d):
    return _labelled(spark, d)


@query(f"WITH {_rules_sql(True)} SELECT * FROM la")
def q_label_rules_compat(spark, d):
    return _labelled(spark, d, compat=True)


@query(f"WITH {_rules_sql(False)} SELECT * FROM la")
def q_label_rules_joined(spark, d):
    """The rules with their lists as tables."""
    lists = [spark.createDataFrame(list(enumerate(words)), "place long, word string") for words in (PART_CLASSES, PART_BLACK, PART_IGNORE)]
    return wordjoin.long_label_rules(path_parts(spark, d), "signal_id", *lists)


@query("""WITH w AS (SELECT DISTINCT lower(unnest(regexp_split_to_array(text, '[^A-Za-z]+'))) AS word FROM documents)
SELECT p_partkey AS signal_id, word FROM part, w WHERE word <> '' AND contains(lower(p_name), word)""")
def q_substring_join(spark, d):
    """Which words of the documents are a part of which part names."""
    words = read(spark, d, "documents").select(F.explode(F.split("text", "[^A-Za-z]+")).alias("word")).select(F.lower("word").alias("word"))
    names = path_parts(spark, d).select("signal_id", F.lower("path").alias("text"))
    return wordjoin.substring_matches(names, words, "signal_id")


@query("""SELECT word, count(*) AS n FROM (
  SELECT trim(unnest(string_split(replace(text, chr(10), ','), ',')), ' ') AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def q_word_list(spark, d):
    words = split_words(read(spark, d, "documents").select("text"), "text")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_rules_sql(False)}
SELECT c AS label, count(signal_id) AS n FROM (VALUES ('ring'), ('bolt'), ('gear'), ('rod'), ('sprocket')) v(c)
LEFT JOIN la ON label = c GROUP BY 1""")
def q_class_balance(spark, d):
    return catalog.class_balance(_labelled(spark, d), (*PART_CLASSES, "sprocket"))


@query(f"""WITH {_rules_sql(False)}
SELECT o AS outcome, count(signal_id) AS n, (SELECT count(*) FROM la) AS n_all
FROM (VALUES ('ok'), ('unreadable'), ('blacklisted'), ('ignored'), ('unlabelled'), ('unreadable_trim'), ('too_long'), ('too_quiet')) v(o)
LEFT JOIN la ON coalesce(reason, 'ok') = o GROUP BY 1""")
def q_catalog_report(spark, d):
    return catalog.catalog_report(_labelled(spark, d))


@query(f"WITH {_rules_sql(False)} SELECT coalesce(reason, 'ok') AS outcome, path, signal_id FROM la")
def q_catalog_lists(spark, d):
    return catalog.catalog_lists(_labelled(spark, d))


@query("""WITH n AS (SELECT p_partkey, p_size || '_' || replace(p_brand || '/' || p_name, '/', '__') AS s FROM part)
SELECT p_partkey, s || repeat('_new', CAST(row_number() OVER (PARTITION BY s ORDER BY p_partkey) - 1 AS BIGINT)) || '.wav' AS new_name FROM n""")
def q_derived_names(spark, d):
    part = read(spark, d, "part")
    path = F.concat("p_brand", F.lit("/"), "p_name", F.lit(".wav"))
    named = part.select("p_partkey", augment.derived_name(F.col("p_size"), path).alias("name"))
    return augment.free_names(named, "name", "p_partkey").select("p_partkey", "new_name")


@query(r"""WITH u AS (SELECT page_id, url, string_split(rtrim(url, '/'), '/')[-1] AS base FROM pages),
v AS (SELECT *, regexp_extract(base, '[^.](\.[^.]*)$', 1) AS suffix FROM u)
SELECT page_id, lower(url) AS low, contains(lower(url), 'example.com') AS has_com, base, suffix,
  substr(base, 1, length(base) - length(suffix)) AS stem, replace(replace(url, 'http:/', ''), '/', '__') AS flat,
  string_split(base, '?')[1] AS before_query, string_split(url, ':')[1] AS family,
  round(log10(CASE WHEN page_id > 0 THEN page_id END), 6) AS log_id, sqrt(pow(page_id - 100, 2)) AS distance,
  CAST(sign(page_id - 100) AS DOUBLE) AS side, greatest(page_id, 10) AS at_least, least(page_id, 200) AS at_most,
  round(1.0 / nullif(page_id, 0), 6) AS weight, round(page_id / 3.0) AS third, TRY_CAST(string_split(base, '?')[1] AS BIGINT) AS number,
  round(20 * log10(greatest(page_id, 1e-5)), 6) AS db, CASE WHEN page_id % 7 = 0 THEN NULL ELSE page_id * 0.5e0 END AS half,
  page_id || ': ' || base AS line
FROM v""")
def q_scalar_pack(spark, d):
    pages = read(spark, d, "pages").select("page_id", "url")
    n = F.col("page_id")
    low, first = F.lower("url"), F.substring_index(S.base_name("url"), "?", 1)
    half = F.when(n % 7 == 0, F.lit(float("nan"))).otherwise(n * 0.5)
    made = pages.select(
        "page_id",
        low.alias("low"),
        low.contains("example.com").alias("has_com"),
        S.base_name("url").alias("base"),
        S.suffix("url").alias("suffix"),
        S.stem("url").alias("stem"),
        S.flat_name("url", "http:").alias("flat"),
        first.alias("before_query"),
        F.split("url", ":")[0].alias("family"),
        S.log10_pos(n).alias("log_id"),
        F.sqrt(F.pow(n - 100, F.lit(2.0))).alias("distance"),
        F.signum(n - 100).alias("side"),
        F.greatest(n, F.lit(10)).alias("at_least"),
        F.least(n, F.lit(200)).alias("at_most"),
        F.try_divide(F.lit(1.0), n).alias("weight"),
        F.round(n / 3).alias("third"),
        first.try_cast("long").alias("number"),
        S.decibel(n.cast("double")).alias("db"),
        S.finite(half).alias("half"),
        F.format_string("%d: %s", n, S.base_name("url")).alias("line"),
    )
    return rounded(made)


PROFILE = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query("""SELECT 'events' AS "table", c AS "column", n_rows, n_filled, CAST(NULL AS BIGINT) AS row_id FROM (
  SELECT count(*) AS n_rows, unnest([{}]) AS c, unnest([{}]) AS n_filled FROM events)
UNION ALL SELECT 'pages', 'page_id', NULL, NULL, page_id FROM (SELECT page_id FROM pages ORDER BY page_id LIMIT 1 OFFSET 4)""".format(
    ", ".join(f"'{c}'" for c in PROFILE), ", ".join(f"count({c})" for c in PROFILE)
))
def q_profile(spark, d):
    filled = catalog.profile(read(spark, d, "events")).select(
        F.lit("events").alias("table"), "column", "n_rows", "n_filled", F.lit(None).cast("long").alias("row_id")
    )
    fifth = catalog.nth_row(read(spark, d, "pages").select("page_id"), 4, "page_id")
    none = F.lit(None).cast("long")
    row = fifth.select(
        F.lit("pages").alias("table"), F.lit("page_id").alias("column"), none.alias("n_rows"), none.alias("n_filled"),
        F.col("page_id").alias("row_id"),
    )
    return filled.unionByName(row)


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d-%H%M%S') || '-' || replace(o_orderpriority, ' ', '_') AS run_id,
  'RF_' || strftime(o_orderdate, '%Y%m%d_%H%M%S') AS model_id, 'RF' AS family FROM orders""")
def q_run_id(spark, d):
    orders = read(spark, d, "orders")
    library = F.concat(F.lit("/data/"), F.col("o_orderpriority"), F.lit("/"))
    made = orders.select("o_orderkey", S.run_id(library, "o_orderdate").alias("run_id"), S.model_id("rf", "o_orderdate").alias("model_id"))
    return made.withColumn("family", S.family("model_id"))


@query("SELECT o_orderkey AS run_id, o_custkey FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def q_latest_run(spark, d):
    from sigspark.sources.registry import latest

    runs = read(spark, d, "orders").select(F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("modified"), "o_custkey")
    return latest(runs).drop("modified")


@query("""SELECT lang, count(*) AS n, count(CASE WHEN n_chars >= 500 THEN 1 END) AS n_long, min(n_chars) AS shortest, max(n_chars) AS longest
FROM documents GROUP BY 1""")
def q_length_by_class(spark, d):
    docs = read(spark, d, "documents")
    long = F.count(F.when(F.col("n_chars") >= 500, 1))
    return docs.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), long.alias("n_long"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest")
    )


@query("""WITH e AS (SELECT lang, min(n_chars) AS lo, max(n_chars) AS hi FROM documents GROUP BY 1)
SELECT lang, CAST(least(CASE WHEN hi = lo THEN 0 ELSE floor((n_chars - lo) / ((hi - lo) / 200.0)) END, 199) AS INTEGER) AS bin, count(*) AS n
FROM documents JOIN e USING (lang) GROUP BY 1, 2""")
def q_length_histogram(spark, d):
    return evaluate.histogram(read(spark, d, "documents").select("lang", "n_chars"), "lang", "n_chars", 200)


# ---- preparation -------------------------------------------------------------------

HASH = "CAST('0x' || substr(md5('7-' || vec_id), 1, 15) AS BIGINT)"
UNIT = "CAST('0x' || substr(md5({}), 1, 13) AS BIGINT) / 4503599627370496.0"


@query("""SELECT p_type AS label, CAST(row_number() OVER (ORDER BY min(p_partkey)) - 1 AS INTEGER) AS code FROM part GROUP BY 1""")
def q_label_codes(spark, d):
    return ranking.label_codes(read(spark, d, "part").select("p_partkey", "p_type"), "p_type", "p_partkey")


CAP = "cp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 40)"


@query(f"WITH {CAP} SELECT vec_id, label FROM cp")
def q_cap_per_class(spark, d):
    return ranking.cap_per_class(feat_embeddings(spark, d).select("vec_id", "label"), "label", "vec_id", 40)


SPLIT = f"""st AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY {HASH}, vec_id) <= ceil(0.25 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM embeddings)"""


@query(f"WITH {SPLIT} SELECT vec_id, split FROM st")
def q_random_split(spark, d):
    rows = feat_embeddings(spark, d).select("vec_id", "label")
    return ranking.random_split(rows, "vec_id", 0.25, SEED).select("vec_id", "split")


@query(f"""SELECT vec_id, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {HASH}, vec_id) <= round(0.1e0 * count(*) OVER (PARTITION BY label))
  THEN 'validation' ELSE 'train' END AS split FROM embeddings""")
def q_stratified_split(spark, d):
    rows = feat_embeddings(spark, d).select("vec_id", "label")
    return ranking.stratified_split(rows, "vec_id", "label", 0.1, SEED).select("vec_id", "split")


@query(f"""WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1),
t AS (SELECT CAST(sum(n) AS BIGINT) AS whole, CAST(ceil(sum(n) * 0.13e0) AS BIGINT) AS total FROM c),
q AS (SELECT label, total * n // whole AS base, row_number() OVER (ORDER BY total * n % whole DESC, label) AS r,
        total - sum(total * n // whole) OVER () AS spare FROM c, t)
SELECT vec_id, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY {HASH}, vec_id) <= base + CAST(r <= spare AS INTEGER)
  THEN 'validation' ELSE 'train' END AS split FROM embeddings JOIN q USING (label)""")
def q_apportioned_split(spark, d):
    rows = feat_embeddings(spark, d).select("vec_id", "label")
    return ranking.apportioned_split(rows, "vec_id", "label", 0.13, SEED).select("vec_id", "split")


@query(f"""WITH {CAP}, co AS (SELECT label, CAST(row_number() OVER (ORDER BY min(vec_id)) - 1 AS INTEGER) AS code FROM cp GROUP BY 1)
SELECT vec_id, code, CASE WHEN row_number() OVER (ORDER BY {HASH}, vec_id) <= ceil(0.25 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM cp JOIN co USING (label)""")
def q_prepare(spark, d):
    return prepare.prepare(feat_embeddings(spark, d), "vec_id", cap=40).select("vec_id", "code", "split")


CELLS = SPLIT + """, ce AS (SELECT vec_id, split, unnest(range(0, 64)) AS idx, CAST(unnest(embedding) AS DOUBLE) AS raw FROM st),
gp AS (SELECT vec_id, split, idx, CASE WHEN abs(raw) >= 0.01 THEN raw END AS v FROM ce),
cs AS (SELECT idx, avg(v) AS mean, stddev_pop(v) AS std FROM gp WHERE split = 'train' GROUP BY 1)"""


def _gappy(spark, d):
    return ranking.random_split(feat_embeddings(spark, d, gaps=True), "vec_id", 0.25, SEED)


def _cells(df):
    return df.select("vec_id", F.posexplode("features").alias("idx", "v"))


@query(f"WITH {CELLS} SELECT vec_id, CAST(idx AS INTEGER) AS idx, round(coalesce(v, mean), 6) AS v FROM gp JOIN cs USING (idx)")
def q_impute_mean(spark, d):
    rows = _gappy(spark, d)
    means = prepare.column_statistics(rows.where(F.col("split") == "train"))
    return rounded(_cells(prepare.impute_mean(rows, means)))


@query(f"""WITH {CELLS}
SELECT vec_id, CAST(idx AS INTEGER) AS idx, round((v - mean) / CASE WHEN std > 0 THEN std ELSE 1 END, 6) AS v FROM gp JOIN cs USING (idx)""")
def q_standard_scale(spark, d):
    rows = _gappy(spark, d)
    fitted = prepare.column_statistics(rows.where(F.col("split") == "train"))
    return rounded(_cells(prepare.standard_scale(rows, fitted)))


@query("SELECT vec_id, label, round(1.0 / count(*) OVER (PARTITION BY label), 8) AS weight FROM embeddings")
def q_class_weights(spark, d):
    rows = feat_embeddings(spark, d).select("vec_id", "label")
    return rounded(ranking.class_weights(rows), 8)


@query(f"""WITH k AS (SELECT label, count(*) AS n, row_number() OVER (ORDER BY label) - 1 AS c FROM embeddings GROUP BY 1),
r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r FROM embeddings),
w AS (SELECT vec_id AS draw_id, CAST(floor({UNIT.format("'7-class-' || vec_id")} * (SELECT count(*) FROM k)) AS BIGINT) AS c,
      {UNIT.format("'7-row-' || vec_id")} AS u FROM embeddings)
SELECT draw_id, label, r.vec_id FROM w JOIN k USING (c) JOIN r USING (label) WHERE r.r = CAST(floor(u * n) AS BIGINT)""")
def q_balanced_sample(spark, d):
    return ranking.balanced_sample(feat_embeddings(spark, d).select("vec_id", "label"), "vec_id", "label", SEED)


@query(f"""WITH c AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1), l AS (SELECT label, n, (SELECT max(n) + 10 FROM c) - n AS lack FROM c),
j AS (SELECT label, n, 'pitch' AS method, unnest(range(0, lack // 2)) AS i FROM l
      UNION ALL SELECT label, n, 'stretch', unnest(range(0, lack - lack // 2)) FROM l),
p AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY {HASH}, vec_id) - 1 AS place FROM embeddings)
SELECT j.label, method, i AS job, vec_id, CAST(CASE method WHEN 'pitch' THEN [-5, -4, -3, -2, -1, 1, 2, 3, 4][(i // n) % 9 + 1]
  ELSE [0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.1, 1.2, 1.3, 1.4][(i // n) % 10 + 1] END AS DOUBLE) AS factor
FROM j JOIN p ON p.label = j.label AND p.place = i % n""")
def q_augment_plan(spark, d):
    rows = feat_embeddings(spark, d).select("vec_id", "label")
    target = ranking.class_counts(rows).agg(F.max("n") + 10).scalar()
    return augment.augment_plan(rows, "vec_id", "label", target)


# ---- models and reports ------------------------------------------------------------

TRAIN = SPLIT + """, tr AS (SELECT * FROM st WHERE split = 'train'), te AS (SELECT * FROM st WHERE split = 'test')"""


def _split(spark, d):
    rows = ranking.random_split(feat_embeddings(spark, d), "vec_id", 0.25, SEED)
    return rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")


KNN = f"""WITH {TRAIN}, tc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM tr) WHERE r <= 750),
ds AS (SELECT te.vec_id, tc.vec_id AS row_id, tc.label, list_distance(CAST(te.embedding AS DOUBLE[]), CAST(tc.embedding AS DOUBLE[])) AS dist
       FROM te, tc),
nn AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, row_id) AS r FROM ds),
vo AS (SELECT vec_id, label, count(*) AS n FROM nn WHERE r <= 5 GROUP BY 1, 2)
SELECT vec_id, CAST(arg_min(label, {{'a': -n, 'b': label}}) AS INTEGER) AS predicted FROM vo GROUP BY 1"""


@query(KNN)
def q_knn(spark, d):
    train, test = _split(spark, d)
    capped = ranking.cap_per_class(train, "label", "vec_id", DEFAULT.cap_per_class)
    return neighbours.knn_predict(test, capped, "vec_id").select("vec_id", "predicted")


@query(KNN.replace(" WHERE r <= 750", ""))
def q_knn_blocks(spark, d):
    """All training rows, text ids, through the blocks that training sets beyond a broadcast are cut into."""
    train, test = (rows.withColumn("vec_id", F.lpad(F.col("vec_id").cast("string"), 20, "0")) for rows in _split(spark, d))
    found = neighbours.knn_predict(test, train, "vec_id", max_cells=0, block=500)
    return found.select(F.col("vec_id").cast("long").alias("vec_id"), "predicted")


MEANS = TRAIN + """, mc AS (SELECT label, unnest(range(0, 64)) AS idx, CAST(unnest(embedding) AS DOUBLE) AS v FROM tr),
mm AS (SELECT label, idx, avg(v) AS c FROM mc GROUP BY 1, 2),
tx AS (SELECT vec_id, label AS truth, unnest(range(0, 64)) AS idx, CAST(unnest(embedding) AS DOUBLE) AS v FROM te),
sc AS (SELECT vec_id, truth, mm.label, sum(pow(v - c, 2)) AS cost FROM tx JOIN mm USING (idx) GROUP BY 1, 2, 3),
pr AS (SELECT vec_id, truth AS label, arg_min(label, {'a': cost, 'b': label}) AS predicted FROM sc GROUP BY 1, 2)"""


def _predicted(spark, d):
    train, test = _split(spark, d)
    return neighbours.nearest_mean(test, neighbours.class_means(train), "vec_id").select("vec_id", "label", "predicted")


@query(f"WITH {MEANS} SELECT vec_id, label, predicted FROM pr")
def q_argmax_class(spark, d):
    return _predicted(spark, d)


@query(f"""WITH {MEANS}, cl AS (SELECT DISTINCT label AS c FROM pr UNION SELECT DISTINCT predicted FROM pr),
pe AS (SELECT c, sum(CASE WHEN label = c THEN 1 ELSE 0 END) AS s, sum(CASE WHEN predicted = c THEN 1 ELSE 0 END) AS k,
       sum(CASE WHEN label = c AND predicted = c THEN 1 ELSE 0 END) AS h FROM pr, cl GROUP BY 1),
pf AS (SELECT c, CAST(s AS BIGINT) AS s, coalesce(h / nullif(k, 0), 0) AS p, coalesce(h / nullif(s, 0), 0) AS r, h FROM pe),
pg AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM pf)
SELECT CAST(c AS VARCHAR) AS name, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM pg
UNION ALL SELECT 'accuracy', round(sum(h) / sum(s), 6), round(sum(h) / sum(s), 6), round(sum(h) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM pg
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM pg
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM pg""")
def q_class_report(spark, d):
    return rounded(evaluate.class_report(_predicted(spark, d)))


@query(f"""WITH {MEANS} SELECT label, {', '.join(f'round(avg(CASE WHEN predicted = {c} THEN 1.0 ELSE 0 END), 6) AS p_{c}' for c in range(10))}
FROM pr GROUP BY 1""")
def q_confusion(spark, d):
    return rounded(evaluate.confusion(_predicted(spark, d), list(range(10))))


@query(f"""WITH {MEANS}
SELECT label, CAST(sum(CASE WHEN label = predicted THEN 1 ELSE 0 END) AS BIGINT) AS correct, count(*) AS total,
  CASE WHEN grouping(label) = 1 THEN round(100 * avg(CASE WHEN label = predicted THEN 1.0 ELSE 0 END))
  ELSE round(100 * avg(CASE WHEN label = predicted THEN 1.0 ELSE 0 END), 6) END AS percent FROM pr GROUP BY ROLLUP (label)""")
def q_class_accuracy(spark, d):
    return rounded(evaluate.class_accuracy(_predicted(spark, d)))


EPOCHS = """ep AS (SELECT event_type AS run_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS epoch,
  CASE WHEN value < 100 THEN 'train' ELSE 'validation' END AS split, value FROM events)"""


def _metrics(spark, d):
    day = F.datediff(F.to_date("ts"), F.to_date(F.lit("2024-01-01")))
    split = F.when(F.col("value") < 100, "train").otherwise("validation")
    return read(spark, d, "events").select(
        F.col("event_type").alias("run_id"), day.alias("epoch"), split.alias("split"), "value"
    )


@query(f"WITH {EPOCHS} SELECT run_id, epoch, split, round(avg(value), 6) AS value FROM ep GROUP BY 1, 2, 3")
def q_epoch_means(spark, d):
    return rounded(evaluate.epoch_means(_metrics(spark, d)))


@query(f"""WITH {EPOCHS}, lo AS (SELECT run_id, epoch, avg(value) AS loss FROM ep GROUP BY 1, 2),
b AS (SELECT *, min(loss) OVER (PARTITION BY run_id ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM lo),
l AS (SELECT *, max(CASE WHEN m IS NULL OR loss < m THEN epoch END) OVER (PARTITION BY run_id ORDER BY epoch) AS last FROM b),
s AS (SELECT *, min(CASE WHEN epoch - last >= 3 THEN epoch END) OVER (PARTITION BY run_id) AS stop FROM l)
SELECT run_id, min(stop) AS stop_epoch, arg_min(epoch, {{'a': loss, 'b': epoch}}) AS best_epoch, round(min(loss), 6) AS best_loss
FROM s WHERE stop IS NULL OR epoch <= stop GROUP BY 1""")
def q_early_stop(spark, d):
    losses = _metrics(spark, d).groupBy("run_id", "epoch").agg(F.avg("value").alias("loss"))
    return rounded(evaluate.early_stop(losses, 3))


@query("""SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  count(*) AS n FROM lineitem""")
def q_ols_simple(spark, d):
    return rounded(
        read(spark, d, "lineitem").agg(
            F.regr_slope("l_extendedprice", "l_quantity").alias("slope"),
            F.regr_intercept("l_extendedprice", "l_quantity").alias("intercept"),
            F.count(F.lit(1)).alias("n"),
        ),
        4,
    )
