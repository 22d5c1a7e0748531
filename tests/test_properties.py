"""Randomised properties, each checked in one Spark job over many generated inputs."""

import random

from revisa.functions import text as T
from revisa.operators import tokens as tk
from tests_support import py_int_like, sequential_claims

ALPHABET = [" ", "\t", "\n", "\x0b", "\x1c", "\x85", "\xa0", "\u2002", "\u200b", "\u3000", "\ufeff", "a", "Z", "7", ".", "-", "+", "e", "x", ":", ";"]


def test_norm_and_int_like_random(spark):
    rnd = random.Random(11)
    vals = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 6))) for _ in range(3000)]
    vals += [str(rnd.randint(-10**6, 10**6)) + rnd.choice(["", ".0", ".5", "e2", " "]) for _ in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = {r.i: (r.n, r.k) for r in df.select("i", T.norm("s").alias("n"), T.int_like("s").alias("k")).collect()}
    for i, v in enumerate(vals):
        assert got[i][0] == (v.strip() or None), repr(v)
        assert got[i][1] == py_int_like(v), repr(v)


def test_greedy_with_hot_token(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        toks = {f"T{rnd.randint(0, 500)}"}
        if i % 3 == 0:
            toks.add("HOT")
        rows.append((i + 1, sorted(toks)))
    cands = spark.createDataFrame([(o,) for o, _ in rows], "ord bigint")
    pairs = spark.createDataFrame([(o, t) for o, ts in rows for t in ts], "ord bigint, token string")
    got = {r["ord"]: r["accepted"] for r in tk.greedy_claims(cands, pairs).collect()}
    assert got == sequential_claims(rows)
