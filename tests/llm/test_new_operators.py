"""Spelling variants, Merkle manifest and language-model scoring against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from revisa.llm import gru, lm, merkle, variants

BASE = "the quick wombat jumped over another wombats wombat and a wombat combat wombat combat wombat wombat wombt wombt wombt wombt wombt "
TEXTS = [
    (1, BASE * 3),
    (2, "Wombat WOMBAT wömbat wömbat wömbat wömbat wömbat\ncombat combat combat combat"),
    (2, "Wombat WOMBAT wömbat wömbat wömbat wömbat wömbat\ncombat combat combat combat"),
    (3, None),
    (4, ""),
    (5, "abcdefgh " * 40 + "abcdefgx " * 7 + "abcdefgxy " * 6 + "aabcdefgh " * 5 + "abcdefh " * 6),
    (6, "Word" + "x" * 5000 + " " + "lorem ipsumé dolores " * 3000),
    (None, "lorem ipsumé dolores\x00a dolores b Dolorés"),
    (7, " \t\n\x0b\x0c\r"),
    (8, "×÷×÷×÷ ×÷×÷×÷ ×÷×÷×÷ ×÷×÷×÷ ×÷×÷×÷ ×÷×÷××"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(d, t, "en", None if i % 3 == 0 else f"s{i % 2}", i, "x", "y") for i, (d, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, word string, tree string").repartition(3)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(texts, cut_every=199):
    n = Counter()
    for d, t in texts:
        for run in re.findall("[a-zÀ-ÿ]+", lowered(t)):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % cut_every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = {w: sorted((o for o in n if one_edit(w, o)), key=lambda o: (-n[o], o)) for w in n}
    form = {w: x[0] if x and n[x[0]] >= 5 * n[w] else None for w, x in near.items()}
    out = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def test_spelling_variants(docs):
    got = variants.spelling_variants(docs).collect()
    assert len(got) == len({r.word for r in got})
    assert {tuple(r) for r in got} == brute_variants(TEXTS)
    assert any(r.form for r in got)
    assert variants.spelling_variants(docs.where("doc_id = -1")).count() == 0


def test_spelling_variants_cut_runs_and_flushes(docs, monkeypatch):
    monkeypatch.setattr(variants, "CUT_EVERY", 3)
    monkeypatch.setattr(variants, "TASK_WORDS", 2)
    assert {tuple(r) for r in variants.spelling_variants(docs.coalesce(1)).collect()} == brute_variants(TEXTS, 3)


def test_near_pairs_find_every_single_edit(spark):
    rng = np.random.default_rng(3)
    words = {"".join(rng.choice(list("abé"), rng.integers(6, 10))) for _ in range(400)}
    frame = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    got = [tuple(sorted((r.word, r.other))) for r in variants.near_pairs(frame).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}


def test_roots_follow_long_paths(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    got = {r.word: r.root for r in variants.roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {f"w{i}": "w37" for i in range(37)}


# ---------------------------------------------------------------- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return sha(*[field(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(leaves, fan):
    paths, own, now = [[] for _ in leaves], [[i] for i in range(len(leaves))], list(leaves)
    while len(now) > 1:
        up, holds = [], []
        for a in range(0, len(now), fan):
            run = now[a : a + fan]
            for j in range(len(run)):
                for i in own[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha(*run))
            holds.append(sum(own[a : a + fan], []))
        now, own = up, holds
    return now[0], paths


def brute_manifest(rows, fan=16):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    if not by:
        return []
    trees = []
    for source in sorted(by, key=lambda s: (s is not None, (s or "").encode())):
        mine = sorted(by[source], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees.append((mine, *tree([leaf_of(r, r["text"]) for r in mine], fan)))
    root, top = tree([t[1] for t in trees], fan)
    out = []
    for (mine, subroot, paths), above in zip(trees, top):
        for r, path in zip(mine, paths):
            leaf, path = leaf_of(r, r["text"]), path + above
            now = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                now = leaf_of(r, lowered(r["text"]))
            for before, behind in path:
                now = sha(before, now, behind)
            out.append((r["doc_id"], leaf, subroot, root, sha(*[a + b for a, b in path]), now, now == root))
    return out


def manifest_rows(docs, **more):
    return Counter(tuple(r) for r in merkle.manifest(docs, **more).collect())


@pytest.mark.parametrize("fan", [16, 2, 3])
def test_merkle_manifest(docs, fan):
    want = Counter(brute_manifest(docs.collect(), fan))
    assert manifest_rows(docs, fan=fan) == want
    assert any(not x[-1] for x in want) and any(x[-1] for x in want)


@pytest.mark.parametrize("sizes", [[], [1], [1, 1], [16], [17, 1, 256], [3] * 20, [1] * 17])
def test_merkle_manifest_shapes(spark, sizes):
    rows = [(10_000 * s + i, f"Text {i}", None, f"é{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert manifest_rows(docs) == Counter(brute_manifest(docs.collect()))


def test_merkle_manifest_equal_rows_and_null_ids(spark):
    rows = [(None, "Same", "en", "s", 1)] * 40 + [(5, "Same", "en", "s", 1)] * 3 + [(5, "Other", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    assert manifest_rows(docs) == Counter(brute_manifest(docs.collect()))


# ---------------------------------------------------------------- language-model scoring


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text)) + [""]


def test_lm_base_counts(docs):
    counts = Counter()
    held = {d for d, _ in TEXTS if d is not None and zlib.crc32(str(d).encode()) % 5 == 1}
    for d, t in TEXTS:
        if d not in held:
            counts.update(tokens(t))
    total, types = sum(counts.values()), len(counts)
    want = Counter()
    for d, t in TEXTS:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (types + 1))) for x in w)
        want[d, d in held, len(w), sum(counts[x] > 0 for x in w), total, round(base, 5)] += 1
    for hot in (lm.HOT_WORDS, 20):  # with few broadcast words most are joined, with the same result
        got = lm.score_documents(docs, hot).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(r.score <= 0 and math.isfinite(r.score) for r in got)
    assert lm.score_documents(docs.where("doc_id = -1")).count() == 0


def test_lm_words():
    texts = [" \t a\x0bB\x0c\r\nÉc ", None, "", "x" * 65 + "\u00a0y z\u2003z\x1c", "\x00 0"]
    found, text = lm.words(pa.array(texts))
    want = [(i, w if len(w.encode()) <= lm.LONGEST else " " + hashlib.sha256(w.encode()).hexdigest()) for i, t in enumerate(texts) for w in tokens(t)[:-1]]
    assert list(zip(text.tolist(), found.to_pylist())) == want


def small_net(hidden=5):
    rng = np.random.default_rng(1)
    net = gru.Net.started(rng.integers(1, 9, 2 * gru.PER_CLASS).astype(float), rng.integers(1, 9, 3).astype(float), hidden)
    net.flat += rng.normal(0, 0.3, net.flat.size).astype(np.float32)
    return net, rng


def brute_score(net, text, end):
    """One text, one step and one token at a time, in double precision."""
    h, hidden, total = np.zeros(net.hidden), net.hidden, 0.0
    one = lambda x: 1 / (1 + np.exp(-x))
    for before, now in zip([end, *text[:-1]], text):
        x, g = net.into[before].astype(float), h @ net.loop.astype(float)
        z, r = one(x[:hidden] + g[:hidden]), one(x[hidden : 2 * hidden] + g[hidden : 2 * hidden])
        new = np.tanh(x[2 * hidden :] + r * g[2 * hidden :])
        h = (1 - z) * new + z * h
        logits = h @ net.to_class.astype(float) + net.class_bias
        k = now // gru.PER_CLASS if now < net.listed else net.closed + now - net.listed
        total += logits[k] - np.log(np.exp(logits).sum())
        if now < net.listed:
            part = slice(k * gru.PER_CLASS, (k + 1) * gru.PER_CLASS)
            logits = net.to_word[part].astype(float) @ h + net.word_bias[part]
            total += logits[now % gru.PER_CLASS] - np.log(np.exp(logits).sum())
    return total


@pytest.mark.parametrize("lanes", [1, 3, 256])
def test_gru_scores_whole_texts(lanes):
    net, rng = small_net()
    lengths = np.array([1, 70, 2, 200, 33, 32, 1, 64])
    ids = rng.integers(0, net.listed + net.open, lengths.sum()).astype(np.int32)
    got = gru.score(net, ids, lengths, 4, lanes=lanes)
    ends = np.cumsum(lengths)
    want = [brute_score(net, ids[b - n : b].tolist(), 4) for n, b in zip(lengths, ends)]
    assert np.allclose(got, want, rtol=1e-4)


def test_gru_probabilities_sum_to_one():
    net, rng = small_net()
    state = rng.normal(size=(1, net.hidden)).astype(np.float32)
    every = np.arange(net.listed + net.open)
    p = np.exp(net.log_probability(np.repeat(state, len(every), axis=0), every))
    assert abs(p.sum() - 1) < 1e-4


def test_gru_gradients():
    net, rng = small_net()
    shape = (6, 4)
    inputs, targets = (rng.integers(0, net.listed + net.open, shape).astype(np.int32) for _ in range(2))
    fresh, state = rng.random(shape) < 0.2, rng.normal(size=(4, net.hidden)).astype(np.float32)

    def loss():
        return -net.log_probability(net.states(inputs, fresh, state).reshape(-1, net.hidden), targets.ravel()).astype(float).mean()

    keep, grad = {}, {}
    net.log_probability(net.states(inputs, fresh, state, keep).reshape(-1, net.hidden), targets.ravel(), grad)
    net.backward(inputs, keep, grad)
    for name in ("into", "loop", "to_class", "class_bias", "to_word", "word_bias"):
        p = getattr(net, name)
        for _ in range(20):
            at = tuple(int(rng.integers(0, n)) for n in p.shape)
            old = p[at]
            p[at] = old + 1e-2
            up = loss()
            p[at] = old - 1e-2
            down = loss()
            p[at] = old
            assert abs((up - down) / 2e-2 - grad[name][at]) < 1e-3


def test_gru_learns_order():
    """A fixed cycle of words is learnt: its likelihood rises far above that of the counts."""
    cycle = np.tile(np.array([3, 17, 9, 30, 5, 0], np.int32), 2000)
    net = gru.Net.started(np.bincount(cycle, minlength=32).astype(float), np.ones(2), 8)
    lengths = np.full(500, 24)
    before = gru.score(net, cycle, lengths, 0).sum() / len(cycle)
    trainer = gru.Trainer(net)
    for _ in range(60):  # three updates each, as a pass is spread over many lanes
        trainer.learn(cycle, np.arange(0, len(cycle), 24), 0)
    after = gru.score(net, cycle, lengths, 0).sum() / len(cycle)
    assert after > before / 2


def test_lm_network_beats_the_base_on_held_out_texts(spark):
    rng = np.random.default_rng(0)
    talk = [["alpha", "bravo", "charlie", "delta"], ["one", "two", "three", "four"]]
    rows = []
    for d in range(400):
        words = talk[d % 2]
        rows.append((d, " ".join(words[(k + d) % 4] if rng.random() < 0.9 else "noise" for k in range(60)), " ".join(f"w{k}" for k in range(20))))
    docs = spark.createDataFrame([(d, f"{a} {b}") for d, a, b in rows], "doc_id long, text string")
    got = [r for r in lm.score_documents(docs).collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got) * 0.9
