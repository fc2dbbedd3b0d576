"""Randomised checks of text semantics against plain-Python oracles.

Many random cases go into one DataFrame so each property costs one job.
"""

import random
import re

from tessera.operators import text

ALPHABET = ["a", "b", "I", "z", ".", ",", "'", "-", "é", " ", " ", "\t", "\n", "\r", "\f", "\x0b", "f"]


def python_tokens(s):
    return [t for t in re.split("[ \t\n\r\f]+", s) if t]


def test_tokeniser_matches_python_split(spark):
    rng = random.Random(17)
    docs = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 40))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, value string")
    got = {}
    for r in text.tokenize(df, keep=("id",)).collect():
        got.setdefault(r.id, []).append(r.word)
    # explode keeps array order within a row
    for i, d in enumerate(docs):
        assert got.get(i, []) == python_tokens(d), repr(d)


def test_word_count_matches_python(spark):
    rng = random.Random(23)
    docs = [" ".join(rng.choice(["x", "y", "Z", "z.", "xx"]) for _ in range(rng.randrange(0, 15)))
            for _ in range(200)]
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    want = {}
    for d in docs:
        for t in python_tokens(d):
            want[t] = want.get(t, 0) + 1
    assert {r.word: r["count"] for r in text.word_count(df).collect()} == want


def test_top_k_matches_python_sort(spark):
    rng = random.Random(29)
    rows = [("w%03d" % i + rng.choice(["", "A", "b"]), rng.randrange(1, 6)) for i in range(150)]
    rows = list(dict(rows).items())
    df = spark.createDataFrame(rows, "word string, count long")
    for k in (1, 7, 20, 149, 500):
        want = sorted(rows, key=lambda r: (r[1], r[0].encode()), reverse=True)[:k]
        got = [(r.word, r["count"]) for r in text.top_k(df, k).collect()]
        assert got == want


def test_common_words_matches_python(spark):
    rng = random.Random(31)
    vocab = ["the", "The", "cat", "dog", "a", "fix", "it.", "It"]
    a = [" ".join(rng.choice(vocab) for _ in range(8)) for _ in range(40)]
    b = [" ".join(rng.choice(vocab[2:]) for _ in range(5)) for _ in range(30)]
    stop = ["the", "a"]
    lines = spark.createDataFrame([(x, "a") for x in a] + [(x, "b") for x in b],
                                  "value string, side string")
    stop_df = spark.createDataFrame([(w,) for w in stop], "word string")
    got = {(r.word, r["count"]) for r in text.topk_common_words_by(
        lines, "side", ("a", "b"), stop_df, k=100).collect()}

    def counts(docs):
        c = {}
        for d in docs:
            for t in python_tokens(d):
                if t not in stop:
                    c[t] = c.get(t, 0) + 1
        return c
    ca, cb = counts(a), counts(b)
    assert got == {(w, max(ca[w], cb[w])) for w in ca.keys() & cb.keys()}
