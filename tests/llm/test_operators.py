"""Each operator against a brute-force version on awkward small tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from revisa.llm import chat, decontam, langid, license_scan, line_dedup, mixing, quality, simhash, toxicity, warc

LONG = "Word" + "x" * 5000 + " " + "lorem ipsum dolor " * 3000
TEXTS = [
    (1, "Alpha beta gamma delta epsilon zeta\nThis line is shared by some\n\nfoo"),
    (2, "  this LINE is shared by some \nown text of two here\nown text of two here"),
    (2, "  this LINE is shared by some \nown text of two here\nown text of two here"),
    (3, None),
    (4, ""),
    (5, LONG),
    (6, LONG + " tail"),
    (None, "this line is shared by some\nÉté *** <b> CC BY, all rights  reserved; General Public License"),
    (7, " \t\n\x0b\x0c\r"),
    (8, "own text of two here\na b c d e f g h a b c d e f g h"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "en", "s", 1, "x") for d, t in TEXTS], "doc_id long, text string, lang string, h1 string, pos int, _text string")


def empty(docs):
    return docs.where("doc_id = -1")


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def space(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_line_dedup(docs):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    rank = lambda d: (d is None, d or 0)
    first = {}
    for d, t in TEXTS:
        for line in (t or "").split("\n"):
            first[key(line)] = min(first.get(key(line), rank(d)), rank(d))
    want = Counter()
    for d, t in TEXTS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or first[key(x)] == rank(d)]
        want[(d, "\n".join(kept), len(lines), len(lines) - len(kept), "s")] += 1
    got = line_dedup.dedup_lines(docs, keep=["h1"])
    assert Counter(tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped", "h1").collect()) == want
    assert line_dedup.dedup_lines(empty(docs)).count() == 0


def test_line_dedup_hot_keys_settle_alike(docs, monkeypatch):
    want = sorted(map(str, line_dedup.dropped_lines(docs).collect()))
    monkeypatch.setattr(line_dedup, "MIN_HOT_LINES", 1)
    monkeypatch.setattr(line_dedup, "MAX_HOT_KEYS", 10**9)
    assert sorted(map(str, line_dedup.dropped_lines(docs).collect())) == want


def brute_fingerprint(text):
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in space(text)]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash_groups(docs):
    fps = [(d, brute_fingerprint(t)) for d, t in TEXTS]
    group = list(range(len(fps)))
    for _ in fps:
        for i, (_, a) in enumerate(fps):
            for j, (_, b) in enumerate(fps):
                if (a ^ b).bit_count() <= 4:
                    group[i] = group[j] = min(group[i], group[j])
    least = {g: min((d for (d, _), k in zip(fps, group) if k == g and d is not None), default=None) for g in group}
    want = Counter((d, f, least[g]) for (d, f), g in zip(fps, group))
    got = simhash.near_groups(docs).collect()
    assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == want
    assert simhash.near_groups(empty(docs)).count() == 0
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} >= {1, 3, None}


@pytest.mark.parametrize("max_bucket", [4096, 2])
def test_simhash_links_connect_all_close_pairs(spark, max_bucket):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 5)
    fps = {int(b) ^ sum(1 << int(x) for x in rng.choice(63, rng.integers(0, 4), replace=False)) for b in base for _ in range(12)}
    fps = sorted(fps | {int(x) for x in rng.integers(0, 1 << 63, 40)})
    root = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), 4, 7, max_bucket)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert {f: got.get(f, f) for f in fps} == root


def counted(monkeypatch):
    """The names of the tables that simhash writes from now on."""
    names, real = [], simhash.written
    monkeypatch.setattr(simhash, "written", lambda df, name, *rest: names.append(name) or real(df, name, *rest))
    return names


def test_simhash_components_of_links_that_fit_a_task_need_no_rounds(spark, monkeypatch):
    order = np.random.default_rng(5).permutation(300).tolist()
    path = list(zip(order, order[1:]))
    edges = spark.createDataFrame([*path, *path, (7, 7), (900, 1000), (1000, 950)], "a long, b long").coalesce(1)
    names = counted(monkeypatch)
    got = simhash.components(edges).collect()
    assert sorted((r.node, r.root) for r in got) == [*((n, 0) for n in range(300)), (900, 900), (950, 900), (1000, 900)]
    assert len(names) == 1


@pytest.mark.parametrize("held_nodes", [1, 1000])
def test_simhash_components_across_tasks(spark, held_nodes):
    order = np.random.default_rng(6).permutation(100).tolist()
    path = [(a, b) for a, b in zip(order, order[1:]) if a != 50 and b != 50]
    hub = [(200, n) for n in range(201, 260)]
    edges = spark.createDataFrame([*path, *path[::3], *hub, (-5, 300), (300, 301), (301, -5)], "a long, b long").repartition(7)
    root = {n: n for e in [*path, *hub, (-5, 300), (300, 301)] for n in e}
    for _ in root:
        for a, b in [*path, *hub, (-5, 300), (300, 301)]:
            root[a] = root[b] = min(root[a], root[b])
    got = simhash.components(edges, held_nodes=held_nodes).collect()
    assert sorted((r.node, r.root) for r in got) == sorted(root.items())
    assert simhash.components(edges.limit(0)).count() == 0


def test_toxicity_model_sends_only_what_it_reads():
    level = toxicity.Level(np.array([9 << 8, 3 << 8], np.uint64), np.array([9, 3], np.uint64), np.ones((2, 2)), np.zeros((2, 2)))
    assert set(vars(level)) == {"gram", "probability", "history", "weight"} and level.gram.tolist() == [3 << 8, 9 << 8]


def test_decontamination(spark, docs):
    items = [(1, "this line IS shared by some, own text of two here a b"), (2, "cc by"), (10, "!!"), (None, "foo"), (4, None), (5, "lorem ipsum dolor " * 5), (6, "alpha beta gamma delta epsilon zeta this line wrong shared")]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, first int")
    got = decontam.decontaminate(docs, bench).collect()
    want = Counter()
    for d, t in TEXTS:
        w, hit, found = alnum(t), set(), set()
        for i, text in items:
            q = alnum(text) if i is not None else []
            for s in range(max(len(q) - 9, 1) if q else 0):
                g = q[s : s + 10]
                for at in range(len(w) - len(g) + 1):
                    if w[at : at + len(g)] == g:
                        hit |= set(range(at, at + len(g)))
                        found.add(str(i))
        want[(d, len(w), len(hit), tuple(sorted(found)), bool(hit))] += 1
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in got) == want
    assert any("6" in r.near_items and r.doc_id == 1 for r in got)  # one word of ten differs
    assert decontam.decontaminate(empty(docs), bench).count() == 0
    assert {r.n_hit for r in decontam.decontaminate(docs, bench.where("item_id < 0")).collect()} == {0}


def test_license_scan(docs):
    got = {(r.doc_id, r.n_words): r for r in license_scan.scan(docs).collect()}
    assert license_scan.scan(docs).count() == len(TEXTS)
    for d, t in TEXTS:
        w = alnum(t)
        at = [i for p in license_scan.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        r = got[(d, len(w))]
        assert (r.n_base, r.first_word, r.last_word) == (len(at), min(at, default=None), max(at, default=None))
    r = got[(None, len(alnum(TEXTS[7][1])))]
    assert (r.base_labels, r.labels, r.score) == ("cc-by,gpl,reserved", "cc-by,gpl,reserved", 1.0)
    assert license_scan.scan(empty(docs)).count() == 0


def test_license_scan_of_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "a cc by b all rights reserved cc by")] * 3, "doc_id long, text string")
    assert [(r.n_base, r.first_word, r.last_word, r.labels) for r in license_scan.scan(rows).collect()] == [(3, 1, 7, "cc-by,reserved")] * 3


def test_license_notice_with_inserted_words(spark):
    text = "x y permission is hereby granted free of any charge to any person obtaining a copy of this nice software and associated documentation files z"
    r = license_scan.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert r.labels == "mit" and r.base_labels == "" and r.score == 1.0


def test_quality_base_counts(spark, docs):
    labels = spark.createDataFrame([(1, 1), (1, None), (2, 1), (8, 0), (None, 1)], "doc_id long, quality int")
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality.quality_rules(docs, labels).collect())
    want = Counter()
    for d, t in TEXTS:
        w = space(t)
        grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        rep = {j for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (t or "").split("\n") if space(x)]
        row = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(rep))
        want[(d, *row, row[0] < 20 or 100 * row[4] > 30 * row[0])] += 1
    assert got == want
    assert quality.quality_rules(empty(docs), labels).count() == 0
    assert quality.quality_rules(docs, labels.where("doc_id < 0")).where("kept <> (not base_failed)").count() == 0


def test_quality_counts_every_label(spark, monkeypatch):
    rng = np.random.default_rng(6)
    scores = np.round(rng.normal(size=997), 9).tolist() + [-3.5, -3.5, 2.0]
    frame = spark.createDataFrame([(x,) for x in scores], "llr double")
    for share in (0.0, 0.002, 0.3, 1.0):
        assert quality.quantile(frame, share) == pytest.approx(np.quantile(scores, share), abs=1e-12)
    assert quality.quantile(frame.where("llr > 99"), 0.5) is None

    from revisa.llm import common

    monkeypatch.setattr(common.label_sample, "__defaults__", (10,))  # the bound of a sample has no say
    words = "the of and to in is that for it as was with be by on not he his but at".split()
    rows = [(i, " ".join(rng.choice(words, 30)) + f" own{i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(quality, "log_ratios", lambda counts, bins: (seen.append(counts.agg({"target": "sum", "raw": "sum"}).first()), np.zeros(bins))[1])
    quality.quality_rules(docs, spark.createDataFrame([(i, 1) for i in range(60)], "doc_id long, quality int"))
    n_target = sum(zlib.crc32(str(i).encode()) % 5 != 4 for i in range(60))
    assert (seen[0]["sum(target)"], seen[0]["sum(raw)"]) == (61 * n_target, 61 * 60)


def test_mixing(spark):
    rows = [(i, "w " * (i % 7), None if i % 5 == 0 else "abc"[i % 3], 3) for i in range(60)] + [(None, None, "z", 1), (3, "w w w", "a", 2), (3, "w w w", "a", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows) and sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs).collect()))
    size = Counter()
    for _, t, s, _ in rows:
        size[s] += len(space(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, clamped, total = {}, set(), 1.5 * sum(size.values())
    while True:
        left = total - sum(2 * size[s] for s in clamped)
        target = {s: 2 * size[s] if s in clamped else left * weight[s] / sum(weight[x] for x in names if x not in clamped) for s in names}
        over = {s for s in names if target[s] > 2 * size[s]}
        if not over:
            break
        clamped |= over
    for s in names:
        mine = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(target[s]) and r.source_size == size[s] and 0 <= r.taken <= 2 * r.size for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= 0.5
    assert mixing.mix_sources(docs.where("doc_id = -1")).count() == 0


def test_toxicity_learns_forms_it_never_saw(spark):
    rng = np.random.default_rng(3)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(list("abdegiklmnoprstu"), 5)) for _ in range(30)]
        if i % 4 == 0:
            words[:4] = ["zqvx" + "".join(rng.choice(list("aeiou"), 3)) for _ in range(4)]
        rows.append((i, " ".join(words), "x", 0.5))
        labels.append((i, int(i % 4 == 0)))
    rows += [(None, None, "x", 0.5), (700, "", "x", 0.5), (3, "", "x", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, c1 string, score double")
    labs = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [r for r in got if r.held_out and r.doc_id < 600 and r.doc_id != 3]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in held)
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.95
    kept = toxicity.drop_toxic(docs, labs)
    assert kept.columns == docs.columns and kept.where("doc_id is null").count() == 1
    none = toxicity.toxicity(docs, labs.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0} and toxicity.toxicity(docs.where("doc_id = -1"), labs).count() == 0


def test_toxic_rows_are_dropped_without_a_shuffle_of_texts(spark):
    rng = np.random.default_rng(5)
    rows = [(i % 290, " ".join("".join(rng.choice(list("abcdefgh" if i % 3 else "ijklmnop"), 4)) for _ in range(20)), i) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, None, -1)], "doc_id long, text string, n int").repartition(7)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(290)], "doc_id long, toxic int")
    want = sorted(r.n for r in toxicity.drop_toxic(docs, labels).collect())
    assert 150 < len(want) < 250
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # less than the texts and their scores
        kept = toxicity.drop_toxic(docs, labels, hot_grams=0)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        assert kept.columns == docs.columns and sorted(r.n for r in kept.collect()) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_toxicity_keeps_every_counted_ngram(spark):
    rng = np.random.default_rng(4)
    texts = [(" ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(20)), int(i % 5 == 0)) for i in range(100)] + [("once zyxwv once", 1), ("a lone qjkvp", 0)]
    counts = toxicity.count_grams(spark.createDataFrame(texts, "text string, label int")).cache()
    whole = toxicity.fit_counts(counts)
    kept = {int(g) for g in whole.levels[-1].gram}
    assert kept == {r.g for r in counts.collect()}  # also what was met once, in either class
    probe = spark.createDataFrame([(i, t + x) for i, (t, _) in enumerate(texts) for x in ("", " zyxwv Ünseen abcd")] + [(None, None), (5, "")], "doc_id long, text string")
    for model in (whole, *(toxicity.fit_counts(counts, hot_grams=n) for n in (0, 600))):
        assert (model.cold is None) == (model is whole)
        model.slope, model.cut = 2.0, 0.1
        got = sorted((r.text or "", r.evidence, r.score) for r in toxicity.measure(probe, model, ["text"]).collect())
        want = got if model is whole else want
        assert [x[0] for x in got] == [x[0] for x in want] and np.abs(np.array([x[1:] for x in got]) - np.array([x[1:] for x in want])).max() < 1e-6


def brute_word(word, vocab, p):
    alpha = [1.0] + [0.0] * len(word)
    for e in range(1, len(word) + 1):
        for s in range(e):
            k = vocab.get(word[s:e])
            if k is not None:
                alpha[e] += alpha[s] * p[k]
    return alpha[-1]


def test_langid_forward_sums_all_segmentations():
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b"bc", b" abc", "é".encode(), b"cab"})
    vocabulary = langid.Vocabulary(pieces)
    p = np.random.default_rng(0).random((len(pieces), 2)) + 0.01
    text = "ABC cab é abcabc zz".encode()
    lattice = langid.Lattice.of_texts(np.frombuffer(text + b"ab", np.uint8), np.array([0, len(text), len(text), len(text) + 2]), vocabulary)
    got = lattice.word_logs(p)
    ids = {x: i for i, x in enumerate(pieces)}
    for t, words in enumerate([[b" abc", b" cab", " é".encode(), b" abcabc", b" zz"], [], [b" ab"]]):
        mine = lattice.word[lattice.text == t]
        for k in range(2):
            assert got[mine, k].tolist() == pytest.approx([np.log(brute_word(w, ids, p[:, k])) for w in words])
    posterior = lattice.expected(p[:, 0])
    per_word = np.bincount(lattice.edge_word, weights=posterior * np.array([len(pieces[i]) for i in lattice.piece]))
    assert per_word.tolist() == pytest.approx((lattice.stop - lattice.start).tolist())  # expected pieces cover each word once


def brute_expected(word, vocab, p):
    """Expected pieces of a word from all its segmentations, written out."""

    def cuts(rest):
        if not rest:
            yield (), 1.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in vocab:
                for tail, q in cuts(rest[n:]):
                    yield (vocab[rest[:n]], *tail), q * p[vocab[rest[:n]]]

    every = list(cuts(word))
    out, total = Counter(), sum(q for _, q in every)
    for found, q in every:
        for k in found:
            out[k] += q / total
    return out


def test_langid_long_words_are_not_cut(monkeypatch):
    rng = np.random.default_rng(2)
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b"abc", b"bc", " é".encode(), "é".encode(), "éa".encode(), b"a" * 40})
    vocabulary, ids = langid.Vocabulary(pieces), {}
    ids.update({x: i for i, x in enumerate(pieces)})
    p = rng.random((len(pieces), 2)) * 1e-3 + 1e-9
    words = ["".join(rng.choice(list("abcé"), n)) for n in (3, 31, 32, 33, 40, 200)] + ["a" * 90]
    data = " ".join(words).encode()
    lattice = langid.Lattice.of_texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]), vocabulary)
    got = lattice.word_logs(p)[lattice.word]

    def brute_log(word, q):  # in exact-enough arithmetic: scaled by a power of ten a byte
        alpha = [1.0] + [0.0] * len(word)
        for e in range(1, len(word) + 1):
            alpha[e] = sum(alpha[s] * q[ids[word[s:e]]] * 3e3 ** (e - s) for s in range(max(0, e - 41), e) if word[s:e] in ids)
            if alpha[e] > 1e200:
                return None
        return np.log(alpha[-1]) - len(word) * np.log(3e3)

    for w, row in zip(words, got):
        for k in range(2):
            want = brute_log(b" " + w.encode(), p[:, k])
            assert want is None or row[k] == pytest.approx(want, rel=1e-9)
    # with every word taken for a long one, nothing changes
    posterior = lattice.expected(p[:, 0])
    monkeypatch.setattr(langid, "SHORT", 0)
    logs = langid.Lattice.of_texts(np.frombuffer(data, np.uint8), np.array([0, len(data)]), vocabulary)
    assert np.allclose(logs.word_logs(p)[logs.word], got)
    for one in (lattice, logs):
        edge = one.expected(p[:, 0]) if one is logs else posterior
        size = np.bincount(one.edge_word, weights=edge * np.array([len(pieces[i]) for i in one.piece]))
        assert size.tolist() == pytest.approx((one.stop - one.start).tolist())


def test_langid_counts_and_predictions_by_hand(spark, monkeypatch):
    pieces = sorted({bytes([b]) for b in range(256)} | {b" a", b"ab", b" ab", b"ba", b"b a", "é".encode()})
    vocabulary, ids = langid.Vocabulary([x for x in pieces if b" " not in x[1:]]), {}
    ids.update({x: i for i, x in enumerate(x for x in pieces if b" " not in x[1:])})
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("ab aab", "x"), ("ba ba éb", "y"), ("ab", "x"), ("b a b", "y"), (None, "x"), ("ab ba", None), ("abab ab", "y"), ("aé", "x")] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2)
    even = np.full(vocabulary.size, 1.0 / vocabulary.size)
    want = {"x": Counter(), "y": Counter()}
    for i, t, lang in rows:
        if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            for w in t.split():
                for k, v in brute_expected(b" " + w.encode(), ids, even).items():
                    want[lang][k] += v
    learnt = {}
    for kept in (400_000, 1):  # also when findings are forgotten after every piece
        monkeypatch.setattr(langid, "KEPT_WORDS", kept)
        names, p = langid.learn(docs, vocabulary)
        assert names == ["x", "y"]
        for k, name in enumerate(names):
            total = sum(want[name].values())
            by_hand = np.array([(1 - langid.FLOOR) * want[name][i] / total + langid.FLOOR / vocabulary.size for i in range(vocabulary.size)])
            assert np.allclose(p[:, k], by_hand, atol=1e-4)
        got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, names, p, vocabulary).collect()}
        assert learnt.setdefault("got", got) == got
    for i, t, _ in rows:
        if t is None:
            assert got[i] == ("und", 0.0)
            continue
        logs = [sum(np.log(brute_word(b" " + w.encode(), ids, p[:, k])) for w in t.split()) for k in range(2)]
        share = np.exp(np.array(logs) - max(logs))
        assert got[i] == (names[int(np.argmax(logs))], pytest.approx(1 / share.sum(), abs=2e-6))


def test_langid(spark):
    rows = [(i, ("the house and the garden of that man" if i % 2 else "der garten und das haus von dem mann"), "en" if i % 2 else "de", 1) for i in range(40)]
    rows += [(100, None, "en", 1), (101, "123 !!", "en", 1), (None, "the man", None, 1), (103, "z" * 3000, "en", 1), (104, "", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r for r in langid.language_id(docs).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(40)) and got[None].lang_pred == "en"
    assert [got[i].lang_pred for i in (100, 101, 104)] == ["und"] * 3 and all(0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.language_id(docs.withColumn("lang", docs.lang.substr(9, 1)).where("doc_id < 0")).collect()} == set()


def test_chat_round_trip(spark):
    rows = [(1, 1, "user", "a <| b <\\| c <\\\\|end|> |<"), (1, 0, "system", None), (1, 2, "assistant", "<|end|><|turn|>assistant<|text|>né"), (1, 2, "assistant", "<"),
            (2, 0, None, ""), (None, 0, "assistant", "|" * 9), (None, None, "us<|er\n", "x"), (3, 0, "assistant", LONG)]
    table = spark.createDataFrame([(*r, "y") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.format_chats(table).collect()}
    assert set(got) == {1, 2, 3, None}
    for c, r in got.items():
        mine = sorted([(t is not None, t or 0, ro or "", tx or "") for i, t, ro, tx in rows if i == c])
        data = r.formatted.encode()
        assert [(a.decode(), b.decode()) for a, b in chat.read_turns(data)] == [m[2:] for m in mine]
        loss = [chat.unescape(data[a:b]).decode() for a, b in zip(r.loss_start, r.loss_end)]
        assert loss == [m[3] for m in mine if m[2] == "assistant"]
    assert chat.format_chats(table.where("turn = 99")).count() == 0


def test_chat_parts_of_a_long_conversation(spark):
    from revisa.llm.queries import chat_digest

    rows = [(None, i, ("user", "assistant")[i % 2], f"<| né {i} " * 20) for i in range(3000)] + [(1, 0, "assistant", "x"), (2, None, None, None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = chat.format_parts(table, 10_000).collect()
    whole = {r.conv_id: r for r in chat.format_chats(table).collect()}
    for c, r in whole.items():
        mine = sorted((p for p in parts if p.conv_id == c), key=lambda p: p.part)
        assert "".join(p.formatted for p in mine) == r.formatted
        assert max(len(p.formatted) for p in mine) < 50_000 and (c is not None or len(mine) > 30)
    got = {r.conv_id: r for r in chat_digest(chat.format_parts(table, 10_000)).collect()}
    assert set(got) == {None, 1, 2} and got[None].n_turns == 3000
    texts = [t for _, i, r, t in rows[:3000] if r == "assistant"]
    assert got[None].loss_sha256 == hashlib.sha256("".join(texts).encode()).hexdigest()
    assert got[None].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:3000]).encode()).hexdigest()
    assert got[None].formatted_chars == len(whole[None].formatted)


def test_loser_tree_merges():
    rng = np.random.default_rng(5)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted(rng.integers(0, 9, rng.integers(0, 6)).tolist()) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_warc_round_trip(spark):
    pages = [(1, "http://www.B.org:80/x?y#f", "same"), (5, "http://a.b.org/", "same"), (5, "http://a.b.org/2", "same"), (2, None, None), (3, "u\r\nv", ""), (4, "http://b.org/x", "p\r\n\r\nWARC/1.1\r\nq é"), (None, "http://b.org/", "only"), (9, "http://b.org/x", LONG)]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, payload_bytes int")
    got = warc.captures(frame).collect()
    want = Counter()
    top = {h or "": max((p for p, _, x in pages if (x or "") == (h or "") and p is not None), default=None) for _, _, h in pages}
    for p, _, h in pages:
        data = (h or "").encode()
        own = p == top[h or ""]
        want[(p, len(data), warc.base32(hashlib.sha1(data).digest()), "response" if own else "revisit", None if own else top[h or ""])] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    ordered = sorted(got, key=lambda r: (r.range_no, r.range_pos))
    keys = [(r.url_key.encode(), r.ts, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert warc.captures(frame.where("page_id = -1")).count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as pipeline

    sf = "/root/testdata/sf0.001"
    before = spark.read.parquet(f"{sf}/documents.parquet")
    docs = before
    for name, stage in pipeline.STAGES[:-1]:
        after = pipeline.written(stage(spark, docs, sf), "test-stage")
        assert after.columns == before.columns
        kept = {r.doc_id: r.text for r in after.collect()}
        was = {r.doc_id: r.text for r in docs.collect()}
        if name == "simhash_dedup":
            groups = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
            assert set(kept) == {d for d in was if groups[d] == d}
        elif name == "decontamination":
            bench = [alnum(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
            windows = {tuple(q[i : i + 10]) for q in bench for i in range(max(len(q) - 9, 1))}
            bad = {d for d, t in was.items() if any(tuple(alnum(t)[i : i + 10]) in windows for i in range(len(alnum(t))))}
            assert set(kept) == set(was) - bad
        elif name == "line_dedup":
            assert set(kept) == set(was)
        docs = after
    assert {r.doc_id for r in pipeline.run(spark, sf).collect()} == {r.doc_id for r in docs.collect()}
