"""Chat formatting: every assistant turn becomes an example of its own.

A conversation's turns, in order, are rendered as

    <|im_start|>role\\ntext<|im_end|>\\n

``examples`` has a row per assistant turn (prefix-target expansion): its text is all turns before it, as context, and the turn
itself, of which only the reply's own text is trainable: the characters from mask_start to mask_end. Turns after the last
reply form one more example without a trainable part, so that nothing of a conversation is lost; so
do conversations without a reply. The texts of a conversation with n turns hold its first turn up to n times, so they grow with the square of
its length; they are made row by row from the conversation's rendered text and are never collected.

``read_back`` reads such rows: the texts under the masks, the turns of each conversation's longest example, and the size of all texts.

Control strings in a text are escaped reversibly: ``<``, k backslashes and ``|``
become ``<``, k + 1 backslashes and ``|``, so no text holds ``<|``. In a role, %
and line feed become %25 and %0A.

Everything is DataFrame functions. A conversation's turns meet in one row,
as every example's context needs them; a conversation must fit a row.

Defined cases: null text and role count as empty; turns are ordered by turn,
then role and text, null turns first; repeated rows are turns each; rows
without a conv_id form one conversation; only the role ``assistant``, exactly, is
trainable; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sigspark.llm.secrets import running_sums

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def head_of(role: Column) -> Column:
    return F.concat(F.lit(START), escaped(escaped_role(role)), F.lit("\n"))


def rendered(turn: Column) -> Column:
    return F.concat(turn["head"], turn["body"], F.lit(END + "\n"))


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turns: array of (head, body, trained, start); a turn's rendered form is
    head, body, END and a line feed, ``start`` characters into the conversation."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    said = conversations.select("conv_id", F.struct("turn", empty("role").alias("role"), empty("text").alias("text")).alias("said"))
    rows = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("said"))
    drawn = F.transform(
        "said", lambda s: F.struct(head_of(s["role"]).alias("head"), escaped(s["text"]).alias("body"), (s["role"] == TRAINED).alias("trained"))
    )
    rows = rows.select("conv_id", drawn.alias("drawn"))
    sizes = F.transform("drawn", lambda t: (F.length(t["head"]) + F.length(t["body"]) + len(END) + 1).cast("long"))
    rows = rows.withColumn("sizes", sizes).withColumn("starts", running_sums(F.col("sizes")))
    turns = F.zip_with("drawn", "starts", lambda t, s: F.struct(t["head"].alias("head"), t["body"].alias("body"), t["trained"].alias("trained"), s.alias("start")))
    return rows.select("conv_id", turns.alias("turns"))


def examples(conversations: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, mask_start, mask_end; the mask is null if nothing is trainable."""
    rows = turns_of(conversations)
    numbers = F.sequence(F.lit(0), F.size("turns") - 1)
    rows = rows.withColumn("ends", F.filter(numbers, lambda i: F.get(F.col("turns"), i)["trained"]))
    done = F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)) == F.size("turns") - 1
    rows = rows.withColumn("ends", F.when(done, F.col("ends")).otherwise(F.concat("ends", F.array(F.size("turns") - 1))))

    def example(end: Column, i: Column) -> Column:
        last = F.get(F.col("turns"), end)
        body = last["start"] + F.length(last["head"])
        stop = body + F.length(last["body"])
        return F.struct(
            i.alias("example"),
            (stop + len(END) + 1).cast("int").alias("chars"),
            F.when(last["trained"], body).alias("mask_start"),
            F.when(last["trained"], stop).alias("mask_end"),
        )

    # an example's text is the conversation's up to its reply
    rows = rows.withColumn("whole", F.array_join(F.transform("turns", rendered), "")).withColumn("each", F.transform("ends", example))
    # never empty; a plain explode would test that first, on all of the expression above
    rows = rows.select("conv_id", "whole", F.explode_outer("each").alias("e"))
    return rows.select("conv_id", "e.example", F.substring(F.col("whole"), F.lit(1), F.col("e.chars")).alias("text"), "e.mask_start", "e.mask_end")


def read_back(found: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, from the texts and masks of examples alone.

    formatted_chars is the length of all texts of the conversation. The longest example holds every turn; it is the
    only whole text that a conversation's rows are combined to.
    """
    masked = F.substring(F.col("text"), (F.col("mask_start") + 1).cast("int"), (F.col("mask_end") - F.col("mask_start")).cast("int"))
    read = found.select("conv_id", "example", "text", F.coalesce(unescaped(masked), F.lit("")).alias("loss"))
    rows = read.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("text"),
        F.array_sort(F.collect_list(F.struct("example", "loss"))).alias("parts"),
        F.sum(F.length("text").cast("long")).alias("formatted_chars"),
    )
    form = r"(?s)^<\|im_start\|>([^\n]*)\n(.*)$"
    pieces = F.split("text", r"<\|im_end\|>\n", -1)
    turns = F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.concat(unescaped_role(unescaped(F.regexp_extract(p, form, 1))), F.lit("\n"), unescaped(F.regexp_extract(p, form, 2)), F.lit("\n")),
    )
    loss = F.array_join(F.transform("parts", lambda x: x["loss"]), "")
    rows = rows.select("conv_id", turns.alias("turns"), loss.alias("loss"), "formatted_chars")
    return rows.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
