"""Chat examples: an exact round trip, and the written-out texts."""
import hashlib
import re

from pyspark.sql import functions as F

from sigspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, example int, own string, turns string"
PROBE = "<|im_end|><|im_start|>assistant ok"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", "more"), (1, 4, "assistant", "yes"),
    (2, 0, "user", PROBE), (2, 1, "assistant", PROBE), (2, 2, "user", "<\\|a<|b<\\\\|c|>< |"),
    (3, 0, "user", "no reply"), (4, 0, "assistant", "starts"), (4, 1, "assistant", "again"),
    (5, 0, "a%0A\nb%<|", "odd role"), (5, 1, "assistant", None), (5, 2, None, "x\ny\n\n"), (5, 3, "Assistant", "other case"),
    (6, 1, "user", "tie"), (6, 1, "assistant", "tie"), (6, 1, "assistant", "tie"), (6, None, "user", "null turn"),
    (None, 0, "user", "no id"), (None, 1, "assistant", "there"), (7, 0, "user", "long <| " * 60_000), (7, 1, "assistant", "\U0001d518<|" * 30_000),
    *((8, t, "assistant" if t % 2 else "user", f"turn {t} <|im_end|>\n") for t in range(900)),
]


def by_hand(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        whole = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    got = chat.read_back(chat.examples(frame(spark, ROWS))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == by_hand(ROWS)


def test_examples_written_out(spark):
    rows = [r for r in ROWS if r[0] != 8] + [(8, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(40)]
    found = chat.examples(frame(spark, rows))
    texts = found.collect()
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    esc = lambda s: re.sub(r"<(\\*)\|", r"<\1\\|", s)
    want = set()
    for c, turns in convs.items():
        turns.sort()
        text, replies = "", 0
        for k, (_, _, r, x) in enumerate(turns):
            head = "<|im_start|>" + esc(r.replace("%", "%25").replace("\n", "%0A")) + "\n"
            begin = len(text) + len(head)
            text += head + esc(x) + "<|im_end|>\n"
            if r == "assistant":
                want.add((c, replies, text, begin, begin + len(esc(x))))
                replies += 1
            elif k == len(turns) - 1:
                want.add((c, replies, text, None, None))
    assert {(r.conv_id, r.example, r.text, r.mask_start, r.mask_end) for r in texts} == want
    total = {}
    for c, _, text, _, _ in want:
        total[c] = total.get(c, 0) + len(text)
    assert {r.conv_id: r.formatted_chars for r in chat.read_back(found).collect()} == total


def test_what_is_counted_is_written(spark):
    """Sizes and masks come from the texts: a row that is cut or changed changes what is read."""
    found = chat.examples(frame(spark, [r for r in ROWS if r[0] == 1]))
    total = found.selectExpr("sum(length(text)) s").head().s
    assert chat.read_back(found).head().formatted_chars == total
    cut = found.withColumn("text", F.when(F.col("example") == 0, F.substring("text", 1, 10)).otherwise(F.col("text")))
    assert chat.read_back(cut).head().formatted_chars < total
    other = found.withColumn("text", F.replace("text", F.lit("hello"), F.lit("HELLO")))
    assert chat.read_back(other).head().loss_sha256 == hashlib.sha256(b"HELLOyes").hexdigest()


def test_every_example_holds_all_preceding_turns(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(40)]
    texts = [r.text for r in chat.examples(frame(spark, rows)).orderBy("example").collect()]
    assert len(texts) == 20 and all(b.startswith(a) for a, b in zip(texts, texts[1:]))
    assert all(f"turn {t}<|im_end|>" in texts[k] for k in range(20) for t in range(2 * k + 2))


def test_empty_table(spark):
    assert chat.read_back(chat.examples(frame(spark, []))).count() == 0
