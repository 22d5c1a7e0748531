"""Toxicity by two class-conditional Kneser-Ney models over letters.

Texts are lower-cased (A-Z), cut into words and read as bytes with single spaces, so an
expression the training rows never held still shares most of its n-grams with known
ones.  For each class, n-grams of the upper
orders have interpolated absolute discounting on the class's own counts; below them both
classes share one backoff distribution whose counts are Kneser-Ney continuation counts
(distinct predecessors) pooled over both classes.  The discount is fixed and below one, so
every counted n-gram is kept however large the input.  A text's evidence is the difference
of its log-likelihoods over the square root of its length, which has the same spread for
short and long ordinary texts; a logistic curve fitted on labelled rows kept out of the
counts turns it into a score.

Counts are gathered from every training row, in bounded pieces, and summed by Spark.  The
models stay a table of histories.  Those met most often, with about ``HOT_GRAMS`` n-grams at
most, are broadcast, with a bitmap of the other histories; an n-gram of a text whose longest
history may be one of these is scored by a join with the table, and its share added to the
text's sum.  The result does not depend on how many are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import MAX_LABELS, crc32_mod, flat, label_sample, pieces, release, written
from revisa.llm.words import mix

ORDER, SHARED = 6, 1
DISCOUNT, SHARED_DISCOUNT = 0.75, 0.75
#: Most n-grams that are broadcast; the others are joined.  Log2 of the bits that mark the others' histories.
HOT_GRAMS, SEEN_BITS = 1 << 20, 27
#: Joined log ratios are summed in whole units of this, so that the order does not matter.
UNIT = 1.0 / (1 << 24)
#: Remainder of crc32(doc_id) mod 5: 0 is never learnt from, 4 calibrates, the others are counted.
FOLDS, HELD_OUT, CALIBRATE = 5, 0, 4
#: Text bytes worked on at once: n-grams take some sixty times as much for a moment.
TASK_BYTES = 1 << 20
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def normal(text: bytes) -> bytes:
    """Words in lower case between single spaces; no words: nothing."""
    words = text.translate(_BYTES).split()
    return b" " + b" ".join(words) + b" " if words else b""


def grams(column, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-gram ending at every byte of every text (NUL before the start), its text number, bytes per text."""
    data, off = flat(column)
    buf = data.tobytes()
    texts = [normal(buf[a:b]) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
    length = np.array([len(t) for t in texts], np.int64)
    pad = b"\0" * (order - 1)
    run = np.frombuffer(pad + pad.join(texts), np.uint8).astype(np.uint64)
    out = run.copy()
    for j in range(1, order):
        out[j:] |= run[:-j] << np.uint64(8 * j)
    return out[run != 0], np.repeat(np.arange(len(texts)), length), length


def count_grams(docs: DataFrame) -> DataFrame:
    """(g, c0, c1): n-grams of the highest order in texts with ``label`` 0 and 1."""

    def run(batches):
        for batch in pieces(batches, "text", TASK_BYTES):
            g, text, _ = grams(batch.column(0))
            toxic = batch.column(1).to_numpy(zero_copy_only=False)[text] == 1
            keys, which = np.unique(g, return_inverse=True)
            c1 = np.bincount(which[toxic], minlength=len(keys))
            c0 = np.bincount(which[~toxic], minlength=len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(c0), pa.array(c1)], names=["g", "c0", "c1"])

    rows = docs.select(F.col("text").cast("string").alias("text"), "label").mapInArrow(run, "g long, c0 long, c1 long")
    return rows.groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))


class Level:
    """One order's discounted probabilities and backoff weights, by packed n-gram and history."""

    def __init__(self, gram, history, probability, weight):
        order = np.argsort(gram)
        self.gram, self.probability = gram[order], probability[order]
        self.history, first = np.unique(history, return_index=True)
        self.weight = weight[first]

    @staticmethod
    def _find(keys, wanted, values, other):
        if not len(keys):
            return np.full((len(wanted), values.shape[1]), other)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted)[:, None], values[at], other)

    def knows(self, history):
        at = np.minimum(np.searchsorted(self.history, history), len(self.history) - 1)
        return self.history[at] == history

    def step(self, gram, lower):
        return self._find(self.gram, gram, self.probability, 0.0) + self._find(self.history, gram >> np.uint64(8), self.weight, 1.0) * lower


class Model:
    """Levels from the lowest order up, and the calibration of the evidence.

    ``cold`` is the table of the histories that the levels leave out, and ``seen`` a bitmap
    of their hashes; None where the levels have all.
    """

    def __init__(self, levels: list[Level | None], shared: int = SHARED, cold: DataFrame | None = None, seen: np.ndarray | None = None):
        self.levels, self.shared, self.cold, self.seen = levels, shared, cold, seen
        self.slope, self.cut = 0.0, 0.0
        self._sent = None

    def __getstate__(self):
        return self.__dict__ | {"cold": None, "_sent": None}  # executors get the levels alone

    def sent(self, spark):
        """The levels on the executors, sent once; slope and cut, which are found later, go with each use."""
        if self._sent is None:
            self._sent = spark.sparkContext.broadcast(self)
        return self._sent

    def log_ratio(self, g: np.ndarray, cold: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """log p(byte | history, toxic) - log p(byte | history, ordinary) for packed n-grams.

        ``cold`` has by order the probabilities and backoff weights found in the table.
        """
        p = np.full((len(g), 2), 1 / 256)
        for n, level in enumerate(self.levels, 1):
            if level is not None:
                p = level.step(g & np.uint64((1 << 8 * n) - 1), p)
            if cold and n in cold:
                p = cold[n][0] + cold[n][1] * p
        return np.log(p[:, 1]) - np.log(p[:, 0])

    def unsure(self, g: np.ndarray) -> np.ndarray:
        """Whether the table may hold a history of the n-gram.

        A history is met at least as often as any that ends with it, so above the first
        order that the levels lack, they lack all, and so does the table if it lacks that one.
        """
        out, open_ = np.zeros(len(g), bool), np.arange(len(g))
        for n in range(self.shared + 1, ORDER + 1):
            level, history = self.levels[n - 1], (g[open_] & np.uint64((1 << 8 * n) - 1)) >> np.uint64(8)
            known = level.knows(history) if level is not None else np.zeros(len(open_), bool)
            word, bit = places(n, history[~known])
            out[open_[~known]] = self.seen[word] & bit != 0
            open_ = open_[known]
        return out

    def partial(self, column) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
        """Per text: sum of the log ratios the levels decide, bytes, and lists of the other n-grams and their numbers."""
        g, text, length = grams(column)
        keys, which = np.unique(g, return_inverse=True)
        ratio, unsure = self.log_ratio(keys), self.unsure(keys)
        total = np.bincount(text, weights=np.where(unsure, 0.0, ratio)[which], minlength=len(length))
        left = unsure[which]
        pair, n = np.unique(text[left] * max(len(keys), 1) + which[left], return_counts=True)
        ends = np.searchsorted(pair, np.arange(len(length) + 1) * max(len(keys), 1)).astype(np.int32)
        values = (keys[pair % max(len(keys), 1)].view(np.int64), n.astype(np.int64))
        return total, length, [pa.ListArray.from_arrays(pa.array(ends), pa.array(v)) for v in values]

    def evidence(self, column) -> np.ndarray:
        g, text, length = grams(column)
        keys, which = np.unique(g, return_inverse=True)
        total = np.bincount(text, weights=self.log_ratio(keys)[which], minlength=len(length))
        return total / np.sqrt(np.maximum(length, 1))



def scores(evidence: np.ndarray, slope: float, cut: float) -> np.ndarray:
    if slope == 0:
        return np.zeros(len(evidence))
    return np.round(1 / (1 + np.exp(-np.clip(slope * (evidence - cut), -30, 30))), 9)


def places(n: int, history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of histories of order ``n`` in the bitmap."""
    at = mix(history ^ np.uint64(n << 56)) >> np.uint64(64 - SEEN_BITS)
    return (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))


def _over(size):
    return lambda x: x / size


def _level(rows: DataFrame, n: int, discount: float) -> DataFrame:
    """A row for each history of order ``n`` from (g, c0, c1): times met, backoff weights, and its n-grams (at most 256) by last byte with both probabilities."""
    kept = [F.greatest(F.col(f"c{k}") - F.lit(discount), F.lit(0.0)).alias(f"k{k}") for k in range(2)]
    stats = rows.select(F.shiftrightunsigned("g", 8).alias("h"), F.col("g").bitwiseAND(F.lit(255)).cast("int").alias("b"), "c0", "c1", *kept)
    one = F.when((F.col("k0") > 0) | (F.col("k1") > 0), F.struct("b", "k0", "k1"))
    by = stats.groupBy("h").agg(*[F.sum(c).alias(f"s{c}") for c in ("c0", "c1", "k0", "k1")], F.collect_list(one).alias("x")).where("sk0 > 0 or sk1 > 0")
    size = [F.greatest(F.col(f"sc{k}"), F.lit(1)) for k in range(2)]
    probability = [F.transform(f"x.k{k}", _over(size[k])).alias(f"p{k}") for k in range(2)]
    weight = [(1 - F.col(f"sk{k}") / size[k]).alias(f"w{k}") for k in range(2)]
    return by.select(F.lit(n).alias("n"), "h", (F.col("sc0") + F.col("sc1")).alias("met"), F.col("x.b").alias("b"), *probability, *weight)


def _levels(rows: DataFrame) -> list[Level | None]:
    """The levels of histories that fit in memory."""
    got = rows.toArrow().combine_chunks()
    out: list[Level | None] = []
    for n in range(1, ORDER + 1):
        mine = got.filter(pa.array(got.column("n").to_numpy() == n))
        if not mine.num_rows:
            out.append(None)
            continue
        lists = {c: mine.column(c).combine_chunks() for c in ("b", "p0", "p1")}
        each = lists["b"].value_lengths().to_numpy(zero_copy_only=False)
        history = mine.column("h").to_numpy().view(np.uint64)
        gram = np.repeat(history, each) << np.uint64(8) | lists["b"].flatten().to_numpy().astype(np.uint64)
        weight = np.repeat(np.stack([mine.column(f"w{k}").to_numpy() for k in range(2)], axis=1), each, axis=0)
        out.append(Level(gram, np.repeat(history, each), np.stack([lists[f"p{k}"].flatten().to_numpy() for k in range(2)], axis=1), weight))
    return out


def _seen(cold: DataFrame) -> np.ndarray:
    """Bitmap of the histories of the table; at most 2^SEEN_BITS / 64 rows reach the driver."""

    def run(batches):
        for batch in batches:
            n, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            found = [places(int(k), h[n == k]) for k in np.unique(n)]
            if found:
                words, which = np.unique(np.concatenate([w for w, _ in found]), return_inverse=True)
                bits = np.zeros(len(words), np.uint64)
                np.bitwise_or.at(bits, which, np.concatenate([b for _, b in found]))
                yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.view(np.int64))], names=["word", "bits"])

    got = cold.select("n", "h").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << SEEN_BITS - 6, np.uint64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy().view(np.uint64)
    return out


def fit_counts(counts: DataFrame, discount: float = DISCOUNT, shared: int = SHARED, hot_grams: int = HOT_GRAMS) -> Model | None:
    """The two models from (g, c0, c1); None unless both classes have text."""
    sizes = counts.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1")).first()
    if not sizes["n0"] or not sizes["n1"]:
        return None
    levels = []
    for n in range(1, ORDER + 1):
        low = F.col("g").bitwiseAND(F.lit((1 << 8 * n) - 1)).alias("g")
        if n > shared:
            rows = counts.select(low, "c0", "c1").groupBy("g").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
            levels.append(_level(rows, n, discount))
        else:  # distinct predecessors in either class, pooled
            higher = counts.select(F.col("g").bitwiseAND(F.lit((1 << 8 * (n + 1)) - 1)).alias("up")).distinct()
            rows = higher.select(F.col("up").bitwiseAND(F.lit((1 << 8 * n) - 1)).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("c0"))
            levels.append(_level(rows.withColumn("c1", F.col("c0")), n, SHARED_DISCOUNT))
    table = levels[0]
    for level in levels[1:]:
        table = table.unionByName(level)
    table = written(table, "toxicity-model")

    power = F.floor(F.log2("met")).cast("int").alias("power")
    least, room = 64, hot_grams
    for r in table.where(F.col("n") > shared).groupBy(power).agg(F.sum(F.size("b")).alias("grams")).orderBy(F.desc("power")).collect():
        if r["grams"] > room:
            break
        least, room = r["power"], room - r["grams"]
    else:
        return Model(_levels(table), shared)
    is_hot = (F.col("n") <= shared) | (power >= least)
    cold = table.where(~is_hot)
    hot = _levels(table.where(is_hot))
    release()
    return Model(hot, shared, cold, _seen(cold))


def joined(pairs: DataFrame, model: Model) -> DataFrame:
    """(rid, more): sums in ``UNIT`` of the log ratios of the n-grams (rid, g, n) by the broadcast levels and the table."""
    orders = range(model.shared + 1, ORDER + 1)
    history = [F.struct(F.lit(n).alias("n"), F.shiftrightunsigned(F.col("g").bitwiseAND(F.lit((1 << 8 * n) - 1)), 8).alias("h")) for n in orders]
    wanted = pairs.select("g").distinct().select("g", F.explode(F.array(*history)).alias("x")).select("g", "x.n", "x.h")
    found = wanted.join(model.cold, ["n", "h"], "left")
    at = F.array_position("b", F.col("g").bitwiseAND(F.lit(255)).cast("int"))
    value = {f"p{k}": F.when(at > 0, F.get(f"p{k}", (at - 1).cast("int"))).otherwise(0.0) for k in range(2)} | {f"w{k}": F.coalesce(f"w{k}", F.lit(1.0)) for k in range(2)}
    names = [f"{c}_{n}" for n in orders for c in value]
    found = found.select("g", "n", *[v.alias(c) for c, v in value.items()])
    wide = found.groupBy("g").agg(*[F.max(F.when(F.col("n") == n, F.col(c))).alias(f"{c}_{n}") for n in orders for c in value])
    sent = model.sent(pairs.sparkSession)

    def run(batches):
        for batch in batches:
            column = dict(zip(names, (batch.column(i + 1).to_numpy() for i in range(len(names)))))
            cold = {n: tuple(np.stack([column[f"{c}{k}_{n}"] for k in range(2)], axis=1) for c in "pw") for n in orders}
            ratio = sent.value.log_ratio(batch.column(0).to_numpy().view(np.uint64), cold)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.rint(ratio / UNIT).astype(np.int64))], names=["g", "ratio"])

    ratios = wide.select("g", *names).mapInArrow(run, "g long, ratio long")
    return pairs.join(ratios, "g").groupBy("rid").agg(F.sum(F.col("n") * F.col("ratio")).alias("more"))


def measure(docs: DataFrame, model: Model, extra: list[str], text: str = "text") -> DataFrame:
    """doc_id, the extra columns, the evidence and the score of every row; ``text`` may be one of the extra columns."""
    names = ["doc_id", *extra]
    rows = docs.select(*names, *([] if text in extra else [text]))
    return _measured(rows, model, names, text) if model.seen is None else _settled(_partly(rows, model, names, text), model, names)


def _types(rows: DataFrame, names: list[str]) -> str:
    return ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)


def _measured(rows: DataFrame, model: Model, names: list[str], text: str) -> DataFrame:
    """The named columns, evidence and score by a model that is broadcast whole."""
    sent, slope, cut = model.sent(rows.sparkSession), model.slope, model.cut

    def run(batches):
        for batch in pieces(batches, text, TASK_BYTES):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            evidence = sent.value.evidence(batch.column(batch.schema.get_field_index(text)))
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(evidence), pa.array(scores(evidence, slope, cut))], names=[*names, "evidence", "score"])

    return rows.mapInArrow(run, f"{_types(rows, names)}, evidence double, score double")


def _partly(rows: DataFrame, model: Model, names: list[str], text: str) -> DataFrame:
    """The named columns, a row number, what the broadcast levels give, and the n-grams left to the table; written once, so that a row keeps its number."""
    sent = model.sent(rows.sparkSession)

    def run(batches):
        rid = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, text, TASK_BYTES):
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in names]
            total, length, lists = sent.value.partial(batch.column(batch.schema.get_field_index(text)))
            own = pa.array(np.arange(rid, rid + len(length)))
            rid += len(length)
            yield pa.RecordBatch.from_arrays([*arrays, own, pa.array(total), pa.array(length), *lists], names=[*names, "_rid", "_total", "_length", "_g", "_n"])

    kinds = f"{_types(rows, names)}, _rid long, _total double, _length long, _g array<long>, _n array<long>"
    return written(rows.mapInArrow(run, kinds), "toxicity-first", "zstd")


def _settled(first: DataFrame, model: Model, names: list[str]) -> DataFrame:
    """The named columns of ``_partly``, evidence and score, with the share of the table's n-grams."""
    pairs = first.select(F.col("_rid").alias("rid"), F.explode(F.arrays_zip("_g", "_n")).alias("x")).select("rid", F.col("x._g").alias("g"), F.col("x._n").alias("n"))
    kept = first.select(*dict.fromkeys([*names, "_rid", "_total", "_length"]))
    out = kept.join(joined(pairs, model).withColumnRenamed("rid", "_rid"), "_rid", "left")
    evidence = (F.col("_total") + F.coalesce("more", F.lit(0)) * F.lit(UNIT)) / F.sqrt(F.greatest("_length", F.lit(1)))
    out = out.select(*names, evidence.alias("evidence"))
    x = F.greatest(F.least(F.lit(model.slope) * (F.col("evidence") - F.lit(model.cut)), F.lit(30.0)), F.lit(-30.0))
    return out.withColumn("score", F.round(1 / (1 + F.exp(-x)), 9) if model.slope else F.lit(0.0))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope of a logistic curve by Newton steps, and the cut with the best F1 on the calibration rows."""
    if not len(x) or y.min() == y.max():
        return 1.0, float(x.max()) + 1.0 if len(x) else 0.0
    spread = x.std() or 1.0
    z = np.stack([(x - x.mean()) / spread, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        grad = z.T @ (p - y) / len(y) + 1e-3 * np.array([beta[0], 0.0])
        hess = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z / len(y) + np.diag([1e-3, 1e-9])
        beta = beta - np.linalg.solve(hess, grad)
    order = np.argsort(-x, kind="stable")
    hit = np.cumsum(y[order])
    ends = np.flatnonzero(np.diff(x[order], append=-np.inf) < 0)  # equal values lie on one side of the cut
    best = ends[np.argmax(2 * hit[ends] / (ends + 1 + hit[-1]))]
    above = x[order[best]]
    below = x[order[best + 1]] if best + 1 < len(x) else above - 1.0
    return max(float(beta[0]), 1e-6) / spread, float(above + below) / 2


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS, discount: float = DISCOUNT, shared: int = SHARED, hot_grams: int = HOT_GRAMS) -> Model:
    """Model and calibration from the labelled rows outside the held-out fold."""
    fold = crc32_mod(F.col("doc_id"), FOLDS)
    known = F.broadcast(label_sample(labels, "toxic", fold != HELD_OUT, max_labels).select(F.col("doc_id").alias("_id"), "label"))
    rows = docs.select("doc_id", "text").join(known, F.col("doc_id") == F.col("_id")).drop("_id")
    counts = written(count_grams(rows.where(fold != CALIBRATE)), "toxicity-counts")
    model = fit_counts(counts, discount, shared, hot_grams)
    if model is None:
        return Model([])
    got = measure(rows.where(fold == CALIBRATE), model, ["label"]).select("evidence", "label").toArrow()
    model.slope, model.cut = calibrate(got.column("evidence").to_numpy(), got.column("label").to_numpy())
    del got
    release()
    return model


def toxicity(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (score of 0.5 or more) and evidence.

    Labels come from at most about ``max_labels`` rows (a hash sample beyond it), never
    from the held-out fold; several labels of one id count as the largest, null ones not
    at all.  A null or wordless text has evidence 0.  Without rows of both classes every
    score is 0.  A null doc_id is not held out.
    """
    model = fit(docs, labels, max_labels)
    held = F.coalesce(crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return measure(docs, model, []).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """The documents whose text the model does not reject, with all their columns.

    Where a part of the model is joined, only row numbers meet the scores: the rejected ones
    become bits, 64 rows to a word, and the documents look their bit up.  Spark broadcasts the
    words under its threshold, which they reach at some tens of millions of documents; beyond it
    the documents are shuffled.
    """
    model = fit(docs, labels, hot_grams=hot_grams)
    names = docs.columns
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    own, text = inner.columns, f"c{names.index('text')}"
    passed = F.coalesce(F.col("score") < 0.5, F.lit(False))
    if model.seen is None:
        kept = _measured(inner, model, own, text).where(passed)
    else:
        first = _partly(inner, model, own, text)
        word, bit = F.shiftright("_rid", 6), F.col("_rid").bitwiseAND(F.lit(63)).cast("int")
        gone = _settled(first, model, ["_rid"]).where(~passed).select(word.alias("_word"), F.expr("shiftleft(1L, cast(_rid & 63 as int))").alias("_bit"))
        gone = written(gone.groupBy("_word").agg(F.bit_or("_bit").alias("_bits")), "toxicity-rejected")
        kept = first.drop("_g", "_n").join(gone, word == F.col("_word"), "left").where(F.coalesce(F.getbit("_bits", bit), F.lit(0)) == 0)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
