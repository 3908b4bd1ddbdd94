"""Spans of secrets against a plain version; the Markov models on held-out strings."""
import hashlib
import math
import random
import re
import string

import pytest

from sigspark.llm import secrets

SCHEMA = "doc_id long, text string, start int, `end` int, value string, n_chars long"
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_by_hand(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(spans)


def random_by_hand(text, model, base):
    n, out = len(secrets.ALPHABET), []
    text = text or ""
    covered = [False] * len(text)
    for s, _, e in base:
        covered[s:e] = [True] * (e - s)
    hidden = "".join(" " if c else x for c, x in zip(covered, text))
    for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", hidden):
        at = [secrets.ALPHABET.index(c) for c in m[0]]
        if math.fsum(model[i * n + j] for i, j in zip(at, at[1:])) > secrets.MARGIN:
            out.append((m.start(), 3, m.end()))
    return out


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in spans)


def texts():
    rnd = random.Random(4)
    key = lambda n, a=string.ascii_letters + string.digits: "".join(rnd.choice(a) for _ in range(n))
    plain = ["the internationalization_of_configuration settings", "getElementsByClassNameAndAttribute", "a-long-hyphenated-name-of-something"]
    out = [
        None, "", "no secrets here", 'token = "abc"', 'token="abcdefgh"', "PassWord:  'hunter22x'", "token=secret: abcdefghijkl", "api_key==abcdefgh apikey:abcdefgh",
        "AKIA" + "A" * 11, "AKIA" + "B" * 12, "xxAKIAAKIAAKIAAKIA9z", "0" * 31, "0" * 32 + "g" + "f" * 40, f"é\U0001d518 token = {key(20)} \U0001d518 AKIA{'Z' * 16} é",
        "secret: " + "a1" * 40, f"AKIA{'Q' * 16}/{key(40)}", f"{'0a' * 16}_{key(40)}", f"{key(30)}+{'0a' * 16}-{key(25)}={'1b' * 20}/{key(10)}", f"token={key(20)}.{key(30)}",
        f"{key(40)}_AKIA{'0' * 40}", "x" * 200_000 + " token=abcdefgh " + "y" * 200_000, "token=abcdefgh\n" * 700, "token = 'a.b/c+d=e-f_g'", key(40), f"see {key(44)}== and {key(64)}",
        *plain, *(f"{rnd.choice(plain)} password={key(12)} {key(33)} {key(32, '0123456789abcdef')} {rnd.choice(plain)}" for _ in range(40)),
    ]
    return list(enumerate(out))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "v", len(t) if t else None) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secrets.train(secrets.corpus_samples(docs))


def test_spans(spark, model):
    rows = texts()
    got = {r.doc_id: r for r in secrets.secrets(frame(spark, rows), model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        base = base_by_hand(t)
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for _, k, _ in base) for kind in range(3)), t
        assert r.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert r.spans == listed(sorted(base + random_by_hand(t, model, base)))


def test_masks(spark, model):
    rows = texts()
    docs = frame(spark, rows)
    got = secrets.masked(docs, model)
    assert got.dtypes == docs.dtypes
    for r in got.collect():
        text = rows[r.doc_id][1]
        spans = sorted((s, e) for s, _, e in base_by_hand(text) + random_by_hand(text, model, base_by_hand(text)))
        merged = []
        for s, e in spans:
            if merged and merged[-1][1] >= s:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        want = text
        for s, e in reversed(merged):
            want = want[:s] + secrets.MASK + want[e:]
        assert r.text == want
        assert r.n_chars == (len(want) if want else None)


def test_models_tell_random_from_ordinary(spark, model):
    """Held-out strings: none of them took part in the training."""
    rnd = random.Random(11)
    random_ones = ["".join(rnd.choice(string.ascii_letters + string.digits + "+/") for _ in range(rnd.randint(24, 60))) for _ in range(200)]
    stems = "user account order status config manager request handler index buffer stream parser value column table window partition engine model token".split()
    ordinary = [
        rnd.choice(["_", "-"]).join(rnd.sample(stems, 5)) if i % 2 else "".join(w.title() for w in rnd.sample(stems, 5)) for i in range(200)
    ]
    rows = [(i, t) for i, t in enumerate(random_ones + ordinary)]
    got = {r.doc_id: r.n_random for r in secrets.secrets(frame(spark, rows), model).collect()}
    assert sum(got[i] for i in range(200)) >= 196
    assert sum(got[i] for i in range(200, 400)) <= 2


def test_what_is_left_beside_a_base_span_is_scanned(spark, model):
    key = "q7Xw2ZpLk9VtRb4NsJ1yHd8GcF3mTa6QeU5oIiPx"
    rows = [(0, f"AKIA{'A' * 16}/{key}"), (1, f"{'0123456789abcdef' * 2}_{key}"), (2, key)]
    got = {r.doc_id: r.spans for r in secrets.secrets(frame(spark, rows), model).collect()}
    assert got == {0: "access:0:20,random:20:61", 1: "hex:0:32,random:32:73", 2: "random:0:40"}
    assert all(key not in r.text for r in secrets.masked(frame(spark, rows), model).collect())


def test_samples_do_not_depend_on_the_session(spark):
    names = lambda: sorted(r.text for r in secrets.made_names(spark, 500).collect())
    before = names()
    spark.udf.register("some_registered_function", lambda x: x)
    spark.conf.set("spark.some.setting.of.the.session", "x")
    try:
        assert names() == before and len(set(before)) > 450
        assert all(set(t) <= set(secrets.ALPHABET) for t in before)
    finally:
        spark.conf.unset("spark.some.setting.of.the.session")


def test_whole_table_and_empty_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for r, d in zip(secrets.secrets(docs, model).orderBy("doc_id").collect(), docs.orderBy("doc_id").collect()):
        base = base_by_hand(d.text)
        assert r.spans == listed(sorted(base + random_by_hand(d.text, model, base)))
    assert secrets.secrets(frame(spark, [])).count() == 0
    assert secrets.masked(frame(spark, [])).count() == 0


def test_training_is_by_labels(spark):
    samples = spark.createDataFrame([("abab", 0), ("abab", 0), ("zqzq", 1), ("x", 1), (None, 0), ("", 1)], "text string, label int")
    model = secrets.train(samples)
    n, at = len(secrets.ALPHABET), secrets.ALPHABET.index
    assert len(model) == n * n
    # a -> b: seen 4 times of 4 among ordinary, never among random
    assert model[at("a") * n + at("b")] == pytest.approx(math.log(1 / n) - math.log(5 / (4 + n)), abs=1e-8)
    assert model[at("z") * n + at("q")] == pytest.approx(math.log(3 / (2 + n)) - math.log(1 / n), abs=1e-8)
