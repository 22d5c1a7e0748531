"""Greedy token claims: the round algorithm equals the sequential rule (brute force)."""

import random

from revisa.operators import tokens as tk


def sequential(rows):
    seen, out = {}, {}
    for ordn, toks in sorted(rows):
        if any(t in seen for t in toks):
            out[ordn] = False
            continue
        out[ordn] = True
        for t in toks:
            seen.setdefault(t, ordn)
    return out


def test_greedy_matches_sequential(spark):
    rnd = random.Random(7)
    for trial in range(3):
        rows = []
        for i in range(60):
            k = rnd.randint(0, 3)
            rows.append((i * 3 + 1, sorted({f"T{rnd.randint(0, 40)}" for _ in range(k)})))
        # a chain: row i shares a token with row i + 1
        rows += [(1000 + i, [f"C{i}", f"C{i + 1}"]) for i in range(8)]
        cands = spark.createDataFrame([(o,) for o, _ in rows], "ord bigint")
        pairs = spark.createDataFrame([(o, t) for o, ts in rows for t in ts], "ord bigint, token string")
        got = {r["ord"]: r["accepted"] for r in tk.greedy_claims(cands, pairs).collect()}
        assert got == sequential(rows)
