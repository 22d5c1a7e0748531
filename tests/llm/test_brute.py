"""Learnt figures, labels and pipeline stages against plain versions of their definitions, and texts beyond the piece sizes."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from revisa.llm import decontam, license_scan, quality, toxicity
from revisa.llm.words import find_words


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def remainder(doc_id, n):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % n


def bins_of(text, bins):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return quality.bins_of(find_words(data, np.array([0, len(data)]), quality.TABLE), bins)[0].tolist()


def test_quality_ratios_threshold_and_verdicts(spark):
    rng = np.random.default_rng(6)
    good, bad = [f"good{i}" for i in range(40)], [f"bad{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad, rng.integers(15, 40)))) for i in range(150)]
    rows += [(None, " ".join(good)), (3, " ".join(bad)), (900, None), (901, ""), (902, "one two " * 30)]
    labels = [(i, int(i % 3 > 0)) for i in range(0, 150, 2)] + [(3, 0), (None, 1), (4, None), (902, 0)]
    bins = 1 << 12
    trusted = {i for i, q in labels if q == 1 and i is not None}
    target, raw = Counter(), Counter()
    for i, t in rows:
        raw.update(bins_of(t, bins))
        if i in trusted and remainder(i, 5) != quality.HELD_FOLD:
            target.update(bins_of(t, bins))
    nt, nr = sum(target.values()) + bins, sum(raw.values()) + bins

    def llr(text):
        found = bins_of(text, bins)
        return sum(math.log((target[b] + 1) / nt) - math.log((raw[b] + 1) / nr) for b in found) / max(len(found), 1)

    held = sorted(llr(t) for i, t in rows if i in trusted and remainder(i, 5) == quality.HELD_FOLD and len(words(t)) >= quality.MIN_WORDS)
    at = (len(held) - 1) * quality.QUANTILE
    low = held[int(at)] + (at - int(at)) * (held[min(int(at) + 1, len(held) - 1)] - held[int(at)])
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), bins)
    assert got.columns[-4:] == ["base_failed", "kept", "llr", "threshold"]
    got = got.collect()
    assert [r.threshold for r in got] == pytest.approx([low - quality.MARGIN] * len(got), abs=1e-5)
    want = Counter((i, len(words(t)), round(llr(t), 4)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, round(r.llr, 4)) for r in got) == want
    assert all(r.kept == (not r.base_failed and r.llr >= r.threshold) for r in got)
    assert any(r.kept for r in got) and any(not r.base_failed and not r.kept for r in got)


def brute_labels(text, known):
    """Votes of every word pair by diagonal, merged and verified, for one text."""
    w = license_scan.words_of((text or "").encode())
    labels, best = set(), 0.0
    for t in known:
        votes = Counter(i - j for i in range(len(w) - 1) for j in range(len(t.words) - 1) if w[i : i + 2] == t.words[j : j + 2])
        total = len(t.words) - 1
        need = total if t.exact else max(1, math.ceil(total * license_scan.MIN_VOTES))
        runs = []
        for d in sorted(d for d, n in votes.items() if n >= need):
            if runs and not t.exact and d - runs[-1][1] <= license_scan.GAP:
                runs[-1][1] = d
            else:
                runs.append([d, d])
        for low, high in runs:
            found = sum(any(0 <= a < len(w) and w[a] == x for a in range(low + j, high + j + 1)) for j, x in enumerate(t.words))
            share = found / len(t.words)
            if share == 1.0 if t.exact else share >= license_scan.MIN_COVER:
                labels.add(t.label)
                best = max(best, share)
    return ",".join(sorted(labels)), best


def test_license_labels_and_scores(spark):
    rng = np.random.default_rng(8)
    notices = list(license_scan.NOTICES)
    texts = [None, "", "cc by", "CC-BY all rights reserved. general public license", "cc cc by by"]
    for n in notices:
        w = n.split()
        texts += [n, n.lower() + " and more", " ".join(w[3:]), " ".join(w[: len(w) // 2]), " ".join(x for x in w if rng.random() > 0.15), " ".join(x + " oops" * (i == 4) for i, x in enumerate(w))]
        texts.append(" ".join(rng.permutation(w)))
    texts.append(" filler ".join(notices) * 2)
    known = license_scan.templates()
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        labels, best = brute_labels(t, known)
        assert (got[i].labels, got[i].score) == (labels, pytest.approx(best)), t
    assert sum(bool(r.labels) for r in got.values()) > 20


class PlainModel:
    """Both classes' probabilities from counted n-grams in dictionaries, straight from the definition."""

    def __init__(self, texts):
        n = toxicity.ORDER
        self.count = [defaultdict(Counter) for _ in range(2)]  # class -> order -> n-gram
        pairs = set()
        for text, label in texts:
            run = b"\0" * (n - 1) + toxicity.normal(text.encode())
            for i in range(n - 1, len(run)):
                for k in range(1, n + 1):
                    self.count[label][k][run[i - k + 1 : i + 1]] += 1
                pairs.add(run[i - 1 : i + 1])
        self.shared = Counter(p[1:] for p in pairs)

    def p(self, gram, label):
        size = sum(self.shared.values())
        d = toxicity.SHARED_DISCOUNT
        left = sum(max(c - d, 0) for c in self.shared.values())
        out = max(self.shared[gram[-1:]] - d, 0) / size + (1 - left / size) / 256
        for k in range(2, toxicity.ORDER + 1):
            table, g = self.count[label][k], gram[-k:]
            other = self.count[1 - label][k]
            met = {x for x in {*table, *other} if x[:-1] == g[:-1]}
            kept = {x: max(table[x] - toxicity.DISCOUNT, 0) for x in met}
            if not any(kept.values()) and not any(max(other[x] - toxicity.DISCOUNT, 0) for x in met):
                continue
            size = max(sum(table[x] for x in met), 1)
            out = kept.get(g, 0) / size + (1 - sum(kept.values()) / size) * out
        return out

    def evidence(self, text):
        n = toxicity.ORDER
        run = b"\0" * (n - 1) + toxicity.normal((text or "").encode())
        grams = [run[i - n + 1 : i + 1] for i in range(n - 1, len(run))]
        return sum(math.log(self.p(g, 1)) - math.log(self.p(g, 0)) for g in grams) / math.sqrt(max(len(grams), 1))


def test_toxicity_probabilities_and_evidence(spark):
    texts = [("a bad bad dog", 1), ("you bad cat", 1), ("a good dog", 0), ("the good cat sat", 0), ("good good", 0), ("é bad", 1)]
    model = toxicity.fit_counts(toxicity.count_grams(spark.createDataFrame(texts, "text string, label int")))
    model.slope, model.cut = 1.0, 0.0
    plain = PlainModel(texts)
    probe = [t for t, _ in texts] + ["bad", "Bad, GOOD!", "never seen zq", "", None, "é"]
    got = {r.doc_id: r.evidence for r in toxicity.measure(spark.createDataFrame(list(enumerate(probe)), "doc_id long, text string"), model, []).collect()}
    for i, t in enumerate(probe):
        assert got[i] == pytest.approx(plain.evidence(t), abs=1e-6), t


def test_pipeline_keeps_clean_rows_with_null_or_repeated_ids(spark, tmp_path):
    import corpus_pipeline as pipeline

    item = "one two three four five six seven eight nine ten eleven"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "x " + item), (None, "a clean text"), (None, None), (7, item + " y"), (7, "another clean text"), (8, "a clean text"), (8, "a clean text")]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(r for r in rows if item not in (r[1] or ""))


def test_mixing_stage_sizes(spark):
    import corpus_pipeline as pipeline

    rows = [(i, "w " * (i % 7), f"s{i % 3}") for i in range(60)] + [(None, None, None)]
    docs = spark.createDataFrame([(*r, "en", 1) for r in rows], "doc_id long, text string, source string, lang string, n_chars long")
    got = pipeline.mix(spark, docs, None).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len(words(t))
    total = sum(size.values())
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s or "")))}
    target, open_ = {}, set(size)
    room = 1.5 * total
    while True:  # clamp what is above its cap, share the rest by weight
        share = {s: room * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2 * size[s]
            room -= 2 * size[s]
        open_ -= over
        if not open_:
            break
    taken = Counter()
    for r in got:
        taken[r.source_size] += r.taken
        assert r.taken <= 2 * r.size
    for _, t, s in rows:
        assert any(r.target == pytest.approx(target[s]) for r in got if r.source_size == size[s])
    assert sum(taken.values()) == pytest.approx(sum(target.values()), abs=4)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    """One text beyond the piece size is a piece by itself, with the same result."""
    long = " ".join(f"w{i % 997}" for i in range(4000))
    rows = [(1, "short one"), (2, long), (3, None), (4, long[:9000] + " cc by " + long[9000:]), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, " ".join(long.split()[2000:2020])), (2, "short one")], "item_id long, text string")
    labels = spark.createDataFrame([(2, 1), (1, 0)], "doc_id long, quality int")

    def results():
        return (
            sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in decontam.decontaminate(docs, bench).collect()),
            sorted((r.doc_id, r.n_words, r.n_base, r.first_word) for r in license_scan.scan(docs).collect()),
            sorted((r.doc_id, r.n_words, r.n_repeat_words, round(r.llr, 6)) for r in quality.quality_rules(docs, labels).collect()),
        )

    whole = results()
    small = lambda batches, column, most=0, f=quality.pieces: f(batches, column, 1000)
    for module in (decontam, license_scan, quality):
        monkeypatch.setattr(module, "pieces", small)
    assert results() == whole
    assert whole[0][1][2] > 0 and whole[1][3][2] == 1
