"""Scoring documents with a gated recurrent language model and a unigram base, both learnt from the corpus.

Counts of every word come from every training text and stay a table; the commonest
``HOT_WORDS`` words of all texts are broadcast with their counts, all others are looked up by
a join.  As those are the commonest, no word that is joined makes up more than one in
``HOT_WORDS`` of the tokens.

The network (``gru``) knows the ``LISTED`` commonest training words; every other word is one of
``OPEN`` classes by its length, inside which its probability is its smoothed share of the
training tokens of that class.  It is trained on every training text in two passes: a
sixteenth of the texts, then all others.  In a pass each task goes once through its texts from
the common weights, by truncated backpropagation, and the tasks' weights are averaged, weighted
by tokens, block by block.  A text is then scored as a whole, its state carried from window
to window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.llm import gru
from revisa.llm.common import crc32_mod, pieces, shared_folder, written

FOLDS, HELD_OUT = 5, 1
HOT_WORDS = 1 << 17
LISTED, HIDDEN = 256, 16
#: Bytes from which on a word is in the next open class; as many classes and one.
OPEN_FROM = (3, 5, 7, 9, 11, 14, 20)
OPEN = len(OPEN_FROM) + 1
#: The end of a text, which is no word; a word over so many bytes is known by its digest.
END, LONGEST = "", 64
#: Half an occurrence is added to every count, and one word more to their number.
ADDED = 0.5
#: The first pass takes one text in so many.
FIRST_PASS = 16
#: Tokens a task trains on or scores at once, and weights in a block.
TASK_TOKENS, BLOCK = 1 << 22, 4096


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a batch's texts, A-Z lower-cased, and the text number of each.

    Arrow splits at the six ASCII white-space characters alone.  A word over ``LONGEST``
    bytes becomes a space and its digest, which no word can be.
    """
    texts = pc.fill_null(column, "").cast(pa.large_string())
    texts = pa.concat_arrays([texts, texts.slice(0, 0)])  # a copy: ascii_lower misreads slices of large strings
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    found = split.flatten()
    text = np.repeat(np.arange(len(split)), pc.list_value_length(split).to_numpy(zero_copy_only=False))
    size = pc.binary_length(found).to_numpy(zero_copy_only=False)
    if len(size) and not size.all():
        found, text, size = found.filter(pa.array(size > 0)), text[size > 0], size[size > 0]
    if len(size) and size.max() > LONGEST:
        long = pa.array(size > LONGEST)
        short = [" " + hashlib.sha256(w.encode()).hexdigest() for w in found.filter(long).to_pylist()]
        found = pc.replace_with_mask(found, long, pa.array(short, pa.large_string()))
    return found, text


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c, a) of rows (text, learnt): occurrences in training texts and in all; the end of a text is one."""

    def run(batches):
        for batch in pieces(batches, "text"):
            found, text = words(batch.column(0))
            learnt = batch.column(1).to_numpy(zero_copy_only=False)
            for kind in (True, False):
                mine = pc.value_counts(found.filter(pa.array((learnt == kind)[text])))
                word = pa.concat_arrays([mine.field("values").cast(pa.string()), pa.array([END])])
                n = np.append(mine.field("counts").to_numpy(zero_copy_only=False), (learnt == kind).sum())
                yield pa.RecordBatch.from_arrays([word, pa.array(n if kind else np.zeros_like(n)), pa.array(n)], names=["word", "c", "a"])

    sums = docs.mapInArrow(run, "word string, c long, a long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("a").alias("a"))
    return sums.where("a > 0")


def open_class(word: Column) -> Column:
    size = F.octet_length(word)
    out = F.lit(0)
    for bound in OPEN_FROM:
        out = out + F.when(size >= bound, 1).otherwise(0)
    return out


class Vocabulary:
    """The broadcast words, listed ones first, with what a task needs of each; bounded by ``HOT_WORDS`` words of ``LONGEST`` bytes or so."""

    def __init__(self, hot: list, sums: dict, listed: int):
        hot = sorted(hot, key=lambda r: (-r["c"], r["word"]))
        self.words = pa.array([r["word"] for r in hot], pa.large_string())
        self.count = np.array([r["c"] for r in hot], np.int64)
        # whole classes only, of words that training texts hold
        known = int((self.count > 0).sum())
        self.listed = min(listed, known // gru.PER_CLASS * gru.PER_CLASS)
        self.tokens, self.types = sums["tokens"] or 0, sums["types"] or 0
        kind = self.kinds(self.words)
        here = kind[: self.listed]
        self.open_tokens = np.array([sums[f"t{k}"] or 0 for k in range(OPEN)]) - np.bincount(here, weights=self.count[: self.listed], minlength=OPEN).astype(np.int64)
        self.open_types = np.array([sums[f"v{k}"] or 0 for k in range(OPEN)]) - np.bincount(here, minlength=OPEN)
        own = np.arange(len(hot))
        self.ids = np.where(own < self.listed, own, self.listed + kind).astype(np.int16)
        self.base = np.log10(self.count + ADDED)
        self.inside = np.where(own < self.listed, 0.0, self.base - self.open_size[kind])
        self.end = self.words.index(END).as_py()

    @staticmethod
    def kinds(found: pa.Array) -> np.ndarray:
        """Open class by length."""
        return np.searchsorted(OPEN_FROM, pc.binary_length(found).to_numpy(zero_copy_only=False), side="right")

    @property
    def base_size(self) -> float:
        return float(np.log10(self.tokens + ADDED * (self.types + 1)))

    @property
    def open_size(self) -> np.ndarray:
        """Of each open class, log10 of its smoothed tokens."""
        return np.log10(self.open_tokens + ADDED * (self.open_types + 1))

    def numbers(self, found: pa.Array) -> np.ndarray:
        """Number of each word in the broadcast list, or -1."""
        return pc.fill_null(pc.index_in(found, value_set=self.words), -1).to_numpy(zero_copy_only=False)


def vocabulary(counts: DataFrame, hot_words: int = HOT_WORDS, listed: int = LISTED) -> Vocabulary:
    """The commonest words, down to the least power of a sixteenth of two at which they still are ``hot_words`` at most."""
    kind, c = open_class(F.col("word")), F.col("c")
    per = [x for k in range(OPEN) for x in (F.sum(F.when(kind == k, c)).alias(f"t{k}"), F.count(F.when((kind == k) & (c > 0), 1)).alias(f"v{k}"))]
    sums = counts.agg(F.sum("c").alias("tokens"), F.count(F.when(c > 0, 1)).alias("types"), *per).first().asDict()
    power = F.floor(F.log2("a") * 16)
    least, room = 1 << 20, hot_words
    for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("power")).collect():
        if r["n"] > room:
            break
        least, room = r["power"], room - r["n"]
    return Vocabulary(counts.where((power >= least) | (F.col("word") == END)).collect(), sums, listed)


def tokenized(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """The rows (doc_id, held_out, text) as tokens, written once so that a row keeps its number ``rid``.

    ``ids`` are the network's token ids of the text and its end, two bytes each; ``base``,
    ``known`` and ``inside`` sum up what the broadcast words say, ``cold`` has the others.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, known long, base double, inside double, cold array<string>, ids binary, rid long"

    def run(batches):
        vocab = sent.value
        rid = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "text"):
            n = batch.num_rows
            found, text = words(batch.column(2))
            at = vocab.numbers(found)
            cold = at < 0
            ids = vocab.ids[at]
            ids[cold] = vocab.listed + vocab.kinds(found.filter(pa.array(cold)))
            size = np.bincount(text, minlength=n)
            ends = np.cumsum(size)
            ids = np.insert(ids, ends, vocab.ids[vocab.end])
            hot, whose = at[~cold], text[~cold]
            sums = [np.bincount(whose, weights=values[hot], minlength=n) + values[vocab.end] for values in (vocab.count > 0, vocab.base, vocab.inside)]
            colds = np.concatenate([[0], np.cumsum(np.bincount(text[cold], minlength=n))])
            blob = pa.py_buffer(ids.astype("<i2").tobytes())
            offsets = pa.py_buffer(np.concatenate([[0], 2 * (ends + np.arange(1, n + 1))]).astype(np.int32).tobytes())
            arrays = [
                batch.column(0),
                batch.column(1),
                pa.array(size + 1),
                pa.array(sums[0].astype(np.int64)),
                pa.array(sums[1]),
                pa.array(sums[2]),
                pa.ListArray.from_arrays(pa.array(colds, pa.int32()), found.filter(pa.array(cold)).cast(pa.string())),
                pa.Array.from_buffers(pa.binary(), n, [None, offsets, blob]),
                pa.array(np.arange(rid, rid + n)),
            ]
            rid += n
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "known", "base", "inside", "cold", "ids", "rid"])

    rows = docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)
    path = shared_folder(docs.sparkSession, "lm-tokens")
    rows.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _portions(batches, column: int):
    """Batches joined to portions of about ``TASK_TOKENS`` tokens: their rows, ids and lengths."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column(column))).as_py() // 2
        if size >= TASK_TOKENS:
            yield _portion(held, column)
            held, size = [], 0
    if held:
        yield _portion(held, column)


def _portion(held, column: int):
    rows = pa.Table.from_batches(held).combine_chunks()
    blobs = rows.column(column).combine_chunks()
    if isinstance(blobs, pa.ChunkedArray):
        blobs = blobs.chunk(0)
    lengths = pc.binary_length(blobs).to_numpy(zero_copy_only=False) // 2
    begin = np.frombuffer(blobs.buffers()[1], np.int32)[blobs.offset]
    ids = np.frombuffer(blobs.buffers()[2], "<i2", count=int(lengths.sum()), offset=int(begin)).astype(np.int32)
    return rows, ids, lengths.astype(np.int64)


def trained(net: gru.Net, end: int, tokens: DataFrame) -> gru.Net:
    """The average of the nets that the tasks train on their rows (ids), from ``net``."""
    sent = tokens.sparkSession.sparkContext.broadcast(net.flat)
    shape = (net.listed, net.open, net.hidden)

    def learn(batches):
        start = sent.value
        own = gru.Trainer(gru.Net(*shape, start.copy()))
        for _, ids, lengths in _portions(batches, 0):
            own.learn(ids, np.cumsum(lengths) - lengths, end)
        if own.tokens:
            for b in range(0, len(start), BLOCK):
                weights = own.net.flat[b : b + BLOCK].astype(np.float64) * own.tokens
                yield pa.RecordBatch.from_arrays([pa.array([b // BLOCK]), pa.array([TaskContext.get().partitionId()]), pa.array([own.tokens]), pa.array([weights])], names=["block", "task", "tokens", "weights"])

    def add(batches):
        block, tokens, total = None, 0, None
        for batch in batches:
            for b, n, w in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                w = w.values.to_numpy()
                if b != block:
                    if block is not None:
                        yield row(block, total / tokens)
                    block, tokens, total = b, 0, np.zeros(len(w))
                tokens, total = tokens + n, total + w
        if block is not None:
            yield row(block, total / tokens)

    def row(block, weights):
        return pa.RecordBatch.from_arrays([pa.array([block]), pa.array([weights])], names=["block", "weights"])

    parts = tokens.select("ids").mapInArrow(learn, "block long, task long, tokens long, weights array<double>")
    blocks = parts.repartition("block").sortWithinPartitions("block", "task").mapInArrow(add, "block long, weights array<double>")
    got = blocks.orderBy("block").collect()  # one model
    if not got:
        return net
    return gru.Net(*shape, np.concatenate([np.array(r["weights"]) for r in got]).astype(np.float32))


def fit(tokens: DataFrame, vocab: Vocabulary) -> gru.Net | None:
    """The network after both passes over the training rows; None where they hold too few words for one class."""
    if not vocab.listed:
        return None
    net = gru.Net.started(vocab.count[: vocab.listed].astype(np.float64), vocab.open_tokens.astype(np.float64), HIDDEN)
    early = F.pmod(F.xxhash64("doc_id", "rid"), F.lit(FIRST_PASS)) == 0
    for rows in tokens.where(early), tokens.where(~early):
        net = trained(net, int(vocab.ids[vocab.end]), rows)
    return net


def scored(tokens: DataFrame, net: gru.Net, end: int) -> DataFrame:
    """The tokenized rows without ids and cold words, with ``log``, the network's log10 probability of the whole text."""
    sent = tokens.sparkSession.sparkContext.broadcast(net.flat)
    shape = (net.listed, net.open, net.hidden)
    names = [c for c in tokens.columns if c not in ("ids", "cold")]

    def run(batches):
        model = gru.Net(*shape, sent.value)
        for rows, ids, lengths in _portions(batches, len(names)):
            logs = gru.score(model, ids, lengths, end) / np.log(10)
            out = rows.drop_columns(["ids"]).append_column("log", pa.array(logs))
            yield from out.to_batches()

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in tokens.select(*names).schema.fields) + ", log double"
    return tokens.select(*names, "ids").mapInArrow(run, schema)


def score_documents(docs: DataFrame, hot_words: int = HOT_WORDS) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities, the end token's included).

    Learns from the texts whose crc32(doc_id) mod 5 is not 1; a null doc_id is not held out
    and so learnt from.  A null or empty text is its end token alone; repeated rows are learnt
    from and scored each.  Where no text is learnt from, the base gives every token
    probability 1; where training texts have fewer than ``gru.PER_CLASS`` different words,
    there is no network and the score is the base score.  A text is cut into words whole, in
    some ten times its bytes, and its recurrence is sequential.  Other columns are not read,
    whatever their names.  An empty table gives no rows.
    """
    held = F.coalesce(crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), held.alias("held_out"))
    counts = written(count_words(rows.select("text", (~F.col("held_out")).alias("learnt"))), "lm-counts")
    vocab = vocabulary(counts, hot_words)
    if vocab.end is None or vocab.end < 0:  # no rows
        return rows.select("doc_id", "held_out", *[F.lit(0).cast("long").alias(c) for c in ("n_tokens", "n_known", "train_tokens")], *[F.lit(0.0).alias(c) for c in ("base_score", "score")]).limit(0)
    tokens = tokenized(rows, vocab)
    net = fit(tokens.where("not held_out").select("doc_id", "rid", "ids"), vocab)
    first = scored(tokens, net, int(vocab.ids[vocab.end])) if net else tokens.drop("ids", "cold")
    cold = tokens.select("rid", F.explode("cold").alias("word"))
    known = cold.join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    size = F.get(F.array(*[F.lit(float(x)) for x in vocab.open_size]), open_class(F.col("word")))
    log = F.log10(c + F.lit(ADDED))
    more = known.groupBy("rid").agg(F.count(F.when(c > 0, 1)).alias("more_known"), F.sum(log).alias("more_base"), F.sum(log - size).alias("more_score"))
    out = first.join(more, "rid", "left")
    base = F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * F.lit(vocab.base_size)
    score = F.col("log") + F.col("inside") + F.coalesce("more_score", F.lit(0.0)) if net else base
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score.alias("score"),
    )
