"""Words of long lists inside texts, as joins: no list on the driver, no pattern that grows with it.

``substring_matches`` finds every (text, word) pair in which the word is a part of the text. A word of GRAM or more characters can
only be in texts that hold all of its parts of GRAM characters, so it is looked for by the one that the fewest texts hold; shorter words are
such a part themselves. An equi-join on that part gives the candidates, a plain test confirms them. Only
(id, part) pairs are shuffled, each text's parts once; texts meet their candidates afterwards.

``long_label_rules`` are the label rules of ``catalog.label_rules`` for lists given as tables.

Tables with a row per text are joined by sorting on both sides, whatever the optimiser guesses of their size from compressed files:
a broadcast would bring all texts to the driver. Per-word tables are counted first (``join_small``).

Defined cases: null texts and words, and empty words, match nothing; repeated words count once; an empty list matches nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.operators.segments import join_small
from sigspark.session import stored

GRAM = 4


def parts_of(text: str, size: int) -> Column:
    """The distinct parts of ``size`` characters, in one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(F.col(text), F.lit("(?s)(?=(.{%d}))" % size), F.lit(1)))


def substring_matches(texts: DataFrame, words: DataFrame, key: str, text: str = "text", gram: int = GRAM) -> DataFrame:
    """(key, word) for every word of ``words`` (column word) that is a part of a text; ``key`` is unique in ``texts``."""
    texts = texts.select(key, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    words = words.select("word").where(F.length("word") > 0).distinct().withColumn("_size", F.least(F.length("word"), F.lit(gram)))
    sizes = [r["_size"] for r in words.select("_size").distinct().collect()]  # at most ``gram`` numbers
    if not sizes:
        return texts.select(key, F.lit("").alias("word")).limit(0)
    every = F.array_distinct(F.flatten(F.array(*[parts_of("_text", n) for n in sorted(sizes)])))
    held = texts.select(key, F.explode(every).alias("_part"))
    counts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one look-up size per word; a part of another size is another text
    own = F.coalesce(*[F.when(F.col("_size") == n, parts_of("word", n)) for n in sizes])
    asked = words.select("word", F.explode(own).alias("_part"), F.size(own).alias("_parts"))
    found = asked.join(counts.hint("merge"), "_part").groupBy("word").agg(F.min_by("_part", F.struct("_n", "_part")).alias("_part"), F.count(F.lit(1)).alias("_met"), F.max("_parts").alias("_parts"))
    # a word with a part that no text holds is in no text
    rarest = found.where(F.col("_met") == F.col("_parts")).select("_part", "word")
    candidates = join_small(held, rarest, ["_part"], "inner").select(key, "word")
    return candidates.join(texts.hint("merge"), key).where(F.col("_text").contains(F.col("word"))).select(key, "word")


def first_words(texts: DataFrame, lists: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(key, word, place) of the word with the smallest ``place`` that is a part of each text; texts without one are left out."""
    found = join_small(substring_matches(texts, lists, key, text), lists.groupBy("word").agg(F.min("place").alias("place")), ["word"], "inner")
    return found.groupBy(key).agg(F.min_by("word", "place").alias("word"), F.min("place").alias("place"))


def without_words(texts: DataFrame, lists: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``texts`` (key, text) with all words of ``lists`` (word, place) cut out, one after the other by place, and how many were.

    A round cuts the first word a text still holds, after the one cut before; texts without one are done. There are as many rounds
    as the most words any text holds.
    """
    now = texts.select(key, F.col(text).alias("text"), F.lit(None).cast("long").alias("place"), F.lit(0).alias("cut"))
    done = []
    ranked = lists.groupBy("word").agg(F.min("place").cast("long").alias("place"))
    while True:
        found = join_small(substring_matches(now, ranked, key), ranked, ["word"], "inner")
        found = found.join(now.select(key, F.col("place").alias("_last")).hint("merge"), key)
        later = found.where(F.col("_last").isNull() | (F.col("place") > F.col("_last")))
        first = later.groupBy(key).agg(F.min_by("word", "place").alias("word"), F.min("place").alias("next"))
        step = stored(now.join(first.hint("merge"), key, "left"), "words-cut")
        done.append(step.where(F.col("word").isNull()).select(key, "text", "cut"))
        more = step.where(F.col("word").isNotNull())
        if more.isEmpty():
            break
        now = more.select(key, F.replace("text", F.col("word"), F.lit("")).alias("text"), F.col("next").alias("place"), (F.col("cut") + 1).alias("cut"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def long_label_rules(paths: DataFrame, key: str, classes: DataFrame, black: DataFrame, ignore: DataFrame, path: str = "path") -> DataFrame:
    """``paths`` with label and reason, by lists of any length: tables (word, place), in the order of ``place``.

    The rules of ``catalog.label_rules`` with ``match="path"``.
    """
    low = stored(paths.select(key, F.lower(path).alias("text")), "words-paths")
    plain = first_words(low, classes, key).select(key, F.col("word").alias("_plain"))
    barred = substring_matches(low, black, key).select(key).distinct().withColumn("_black", F.lit(True))
    # only what has a class and no black word is looked at again
    open_ = low.join(plain.hint("merge"), key, "left_semi").join(barred.hint("merge"), key, "left_anti")
    stripped = without_words(open_, ignore, key).where("cut > 0")
    again = first_words(stripped, classes, key).select(key, F.col("word").alias("_again"))
    state = plain
    for part in (barred, stripped.select(key, "cut"), again):
        state = state.join(part.hint("merge"), key, "left")
    ruled = paths.join(state.hint("merge"), key, "left")
    is_black, ignored = F.col("_black").isNotNull(), F.col("cut").isNotNull()
    label = F.when(F.col("_plain").isNotNull() & ~is_black, F.when(ignored, F.col("_again")).otherwise(F.col("_plain")))
    reason = (
        F.when(F.col("_plain").isNull(), F.lit("unlabelled"))
        .when(is_black, F.lit("blacklisted"))
        .when(ignored & F.col("_again").isNull(), F.lit("ignored"))
    )
    return ruled.select(*paths.columns, label.alias("label"), reason.alias("reason"))
