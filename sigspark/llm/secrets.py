"""Secrets in texts: fixed patterns, and character Markov models compared by log-likelihood ratio.

Base spans, leftmost and non-overlapping for each kind:

* ``assign``: a name such as password or token, ``:`` or ``=``, and a value of 8 or more characters;
* ``access``: ``AKIA`` and upper-case letters or digits, 16 or more characters in all;
* ``hex``: 32 or more lower-case hexadecimal digits.

The method adds spans of kind ``random``: runs of characters of ALPHABET, without the parts that base spans cover; what is left in
pieces of RUN or more characters, and whose log-likelihood under a first-order Markov
model of random strings exceeds that under one of ordinary identifiers by MARGIN.

The models are trained from labelled samples (``text``, ``label``: 1 random, 0
ordinary). ``corpus_samples`` labels values found by the base patterns and
digests of a range of numbers 1, and words of the corpus and identifiers made of NAME_WORDS
0; it reads about TRAIN_DOCS documents picked by a hash of doc_id. Nothing of it depends on the session or on Spark's version.
Everything else reads every row and the whole text. All of it is DataFrame
functions: the model reaches the tasks as a constant array of
len(ALPHABET)**2 numbers.

Defined cases: null text counts as empty; a text without spans has zero counts,
an empty ``spans`` and the digest of the empty string; repeated rows are
returned each; other columns are ignored by ``secrets`` and kept by ``masked``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigspark.llm.common import text_of

# The base patterns and the order of kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
RUN = 20
#: Log odds against a run being a secret, before its characters are seen.
MARGIN = 9.2
TRAIN_DOCS = 4000
#: How many identifiers are made, and how often each counts against the words of the corpus.
NAMES, NAME_WEIGHT = 8192, 10
# English words that names in programs are made of; the labelled ordinary samples.
NAME_WORDS = """
abstract action adapter after amount argument attribute average balance before boolean branch builder button cache callback change channel child class
client collection color command complete connection contact control convert count country create current date default delay describe detail device
disable display document download driver duration editor element email empty enable entry error event example execute expression extension failure
field file first folder format function generate group height helper history import index information insert instance interval iterator keyboard label
last layout length library limit list local location logger machine maximum member message method minimum month mouse network node number object
output package page parent path pattern percent person picture pointer policy position previous price primary private process product progress project
property provider public publish quantity query queue range reader record region register remote replace report response retry return revision route
rule schema search second select server service session size source space start state storage style summary switch target task template thread time
title transform tree trigger unit update upload user utility validate vector vendor version view visible warning width window worker write year zone
"""
MASK = "[SECRET]"
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def running_sums(values: Column) -> Column:
    """Sums of the elements before each element; in pieces of 256, as appending copies an array."""
    zero = F.lit(0).cast("long")

    def scan(part: Column, start: Column) -> Column:
        sums = F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        return F.slice(sums, F.lit(1), F.size(part))

    count = F.ceil(F.size(values) / 256).cast("int")
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * 256 + 1, F.lit(256)))
    starts = scan(F.transform(parts, lambda p: F.aggregate(p, zero, lambda acc, x: acc + x)), zero)
    return F.when(F.size(values) > 0, F.flatten(F.zip_with(parts, starts, scan))).otherwise(F.array().cast("array<bigint>"))


def with_matches(rows: DataFrame, text: Column, pattern: str, name: str) -> DataFrame:
    """Adds ``name``: (start, end, value) of the leftmost non-overlapping matches, in code points.

    Splitting at the pattern gives the gaps between the matches; the running
    sum of gap and match lengths gives the places.
    """
    some = text.rlike(pattern)
    found = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    gaps = F.when(some, F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("__found", found).withColumn("__gaps", F.slice(gaps, F.lit(1), F.size("__found")))
    rows = rows.withColumn("__steps", F.zip_with("__gaps", "__found", lambda g, m: g + F.length(m)))
    rows = rows.withColumn("__before", running_sums(F.col("__steps")))
    starts = F.zip_with("__before", "__gaps", lambda b, g: b + g)
    spans = F.zip_with(starts, "__found", lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("end"), m.alias("value")))
    return rows.withColumn(name, spans).drop("__found", "__gaps", "__steps", "__before")


def with_base(rows: DataFrame, text: Column) -> DataFrame:
    """Adds the columns __assign, __access and __hex."""
    rows = with_matches(rows, text, ASSIGN, "__assign")
    rows = rows.withColumn("__assign", F.filter("__assign", lambda m: F.length(F.regexp_extract(m["value"], ASSIGN_VALUE, 1)) >= 8))
    rows = with_matches(rows, text, ACCESS, "__access")
    return with_matches(rows, text, HEX, "__hex")


def made_names(spark: SparkSession, n: int = NAMES) -> DataFrame:
    """``n`` identifiers of two to seven words that a hash picks, in the usual spellings."""
    words = F.split(F.lit(" ".join(NAME_WORDS.split())), " ")
    places = F.sequence(F.lit(1), 2 + F.pmod(F.xxhash64("id"), F.lit(6)).cast("int"))
    picked = F.transform(places, lambda k: F.element_at(words, (F.pmod(F.xxhash64("id", k), F.size(words).cast("long")) + 1).cast("int")))
    rows = spark.range(n).withColumn("w", picked)
    joined = lambda sign: F.array_join("w", sign)
    camel = F.array_join(F.transform("w", lambda w: F.initcap(w)), "")
    spellings = [joined("_"), joined("-"), joined("/"), camel, F.concat(F.element_at("w", 1), F.array_join(F.transform(F.slice("w", F.lit(2), F.size("w")), lambda w: F.initcap(w)), "")), F.upper(joined("_"))]
    return rows.select(F.element_at(F.array(*spellings), (F.pmod("id", F.lit(len(spellings))) + 1).cast("int")).alias("text"))


def corpus_samples(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Labelled strings (text, label) from about ``train_docs`` documents and from rules."""
    spark = docs.sparkSession
    every = max(1, docs.count() // train_docs)
    part = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0).select(text_of().alias("__text"))
    found = with_base(part, F.col("__text"))
    values = F.concat(
        F.transform("__assign", lambda m: F.regexp_extract(m["value"], ASSIGN_VALUE, 1)),
        F.transform("__access", lambda m: m["value"]),
        F.transform("__hex", lambda m: m["value"]),
    )
    secrets_seen = found.select(F.explode(values).alias("text"), F.lit(1).alias("label"))
    plain = found.filter((F.size("__assign") == 0) & (F.size("__access") == 0) & (F.size("__hex") == 0))
    words = plain.select(F.explode(F.regexp_extract_all("__text", F.lit("[A-Za-z_-]{4,}"), F.lit(0))).alias("text"), F.lit(0).alias("label"))
    names = made_names(spark).select("text", F.lit(0).alias("label"), F.explode(F.sequence(F.lit(1), F.lit(NAME_WEIGHT)))).select("text", "label")
    digest = F.sha2(F.col("id").cast("string"), 256)
    made = spark.range(4096).select(
        F.explode(F.array(F.base64(F.unhex(digest)), F.substring(digest, 1, 40), F.upper(F.substring(digest, 1, 32)))).alias("text"), F.lit(1).alias("label")
    )
    return secrets_seen.unionByName(words).unionByName(names).unionByName(made)


def train(samples: DataFrame) -> list[float]:
    """Log ratio of every transition: P(next | char) among label 1 over label 0, add-one smoothed.

    Element i * len(ALPHABET) + j belongs to the transition from character i to j.
    """
    n = len(ALPHABET)
    place = lambda c: F.instr(F.lit(ALPHABET), c) - 1
    pairs = samples.filter(F.length("text") > 1).select(
        "label", F.explode(F.transform(F.sequence(F.lit(1), F.length("text") - 1), lambda i: F.substring("text", i, F.lit(2)))).alias("pair")
    )
    counts = pairs.groupBy("pair").agg(F.sum("label").alias("r"), F.sum(1 - F.col("label")).alias("o"))
    placed = counts.withColumn("i", place(F.substring("pair", 1, 1))).withColumn("j", place(F.substring("pair", 2, 1))).filter("i >= 0 AND j >= 0")
    grid = samples.sparkSession.range(n * n).select(F.floor(F.col("id") / n).cast("int").alias("i"), (F.col("id") % n).cast("int").alias("j"))
    row = Window.partitionBy("i")
    full = grid.join(placed.select("i", "j", "r", "o"), ["i", "j"], "left").fillna(0, ["r", "o"])
    ratio = F.log((F.col("r") + 1) / (F.sum("r").over(row) + n)) - F.log((F.col("o") + 1) / (F.sum("o").over(row) + n))
    table = full.select((F.col("i") * n + F.col("j")).alias("at"), F.round(ratio, 9).alias("ratio"))
    return table.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "ratio"))), lambda x: x["ratio"]).alias("model")).head()["model"]


def log_ratio(text: Column, model: Column) -> Column:
    """Log-likelihood of the text as a random string over that as an ordinary one; ALPHABET characters only."""
    n = len(ALPHABET)
    places = F.transform(F.split(text, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    first, second = F.slice(places, F.lit(1), F.length(text) - 1), F.slice(places, F.lit(2), F.length(text) - 1)
    return F.aggregate(F.zip_with(first, second, lambda i, j: F.element_at(model, i * n + j + 1)), F.lit(0.0), lambda acc, x: acc + x)


def uncovered(run: Column, base: Column) -> Column:
    """The pieces of a run, of RUN or more characters, that none of the sorted ``base`` spans covers."""
    over = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    piece = lambda start, end: F.struct(start.alias("start"), end.alias("end"))
    begin = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("done"), run["start"].alias("at"))
    step = lambda acc, b: F.struct(
        F.when(b["start"] >= acc["at"] + RUN, F.concat(acc["done"], F.array(piece(acc["at"], b["start"])))).otherwise(acc["done"]).alias("done"),
        F.greatest(acc["at"], b["end"]).alias("at"),
    )
    rest = lambda acc: F.when(
        run["end"] >= acc["at"] + RUN, F.concat(acc["done"], F.array(piece(acc["at"], run["end"])))
    ).otherwise(acc["done"])
    value = lambda p: F.substring(run["value"], (p["start"] - run["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))
    cut = F.transform(F.aggregate(over, begin, step, rest), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), value(p).alias("value")))
    # most runs meet no base span and are one piece
    return F.when(F.size(over) > 0, cut).otherwise(F.array(F.struct(run["start"].alias("start"), run["end"].alias("end"), run["value"].alias("value"))))


def with_spans(rows: DataFrame, text: Column, model: list[float]) -> DataFrame:
    """Adds __base and __spans: sorted (start, kind, end) of the base kinds, and of all."""
    rows = with_base(rows, text)
    tag = lambda name, kind: F.transform(name, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    base = F.array_sort(F.concat(tag("__assign", 0), tag("__access", 1), tag("__hex", 2)).cast(SPAN))
    rows = rows.withColumn("__base", base)
    runs = "[A-Za-z0-9+/_=-]{" + str(RUN) + ",}"
    rows = with_matches(rows, text, runs, "__runs")
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    rows = rows.withColumn("__free", F.flatten(F.transform("__runs", lambda m: uncovered(m, F.col("__base")))))
    rows = rows.withColumn("__random", F.filter("__free", lambda m: log_ratio(m["value"], table) > MARGIN)).drop("__free")
    return rows.withColumn("__spans", F.array_sort(F.concat("__base", tag("__random", 3).cast(SPAN))))


def listed(spans: Column | str) -> Column:
    """kind:start:end of the spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random; a row per document."""
    model = model or train(corpus_samples(docs))
    rows = with_spans(docs.select("doc_id", text_of().alias("__text")), F.col("__text"), model)
    count = lambda c: F.size(c).cast("long")
    return rows.select(
        "doc_id",
        count("__assign").alias("n_assign"),
        count("__access").alias("n_access"),
        count("__hex").alias("n_hex"),
        F.sha2(listed("__base"), 256).alias("base_sha256"),
        listed("__spans").alias("spans"),
        count("__random").alias("n_random"),
    )


def masked(docs: DataFrame, model: list[float] | None = None) -> DataFrame:
    """``docs`` with MASK in place of every span; spans that touch are one.

    Texts without spans stay as they are, null too; n_chars follows the text.
    """
    model = model or train(corpus_samples(docs))
    rows = with_spans(docs.withColumn("__text", text_of()), F.col("__text"), model)
    pair = lambda s, e: F.struct(s.alias("start"), e.alias("end"))
    joined = F.aggregate(
        "__spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(pair(F.element_at(acc, -1)["start"], F.greatest(F.element_at(acc, -1)["end"], s["end"]))),
            ),
        ).otherwise(F.concat(acc, F.array(pair(s["start"], s["end"])))),
    )
    rows = rows.withColumn("__whole", joined)
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("__whole", lambda s: s["end"]))
    ends = F.concat(F.transform("__whole", lambda s: s["start"]), F.array(F.length("__text").cast("long")))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(F.col("__text"), (a + 1).cast("int"), (b - a).cast("int")))
    rows = rows.withColumn("text", F.when(F.size("__whole") > 0, F.array_join(kept, MASK)).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.when(F.size("__whole") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
