"""Language ID by segmentation-marginalised unigrams over a fixed public vocabulary.

A word (A-Z lower-cased, with a leading space) may be cut into vocabulary pieces in many
ways.  For each language pieces have probabilities; the probability of a word is the sum
over all its segmentations, found by a forward pass over its bytes, and a text's
log-likelihood is the sum over its words.  The piece probabilities of a language are
expected piece counts: one forward-backward pass under a uniform piece distribution over
every training text, gathered by Spark.

A task builds the lattice of the distinct words it has not met yet and walks it in numpy,
byte position by byte position, for all languages at once; what it found for a word is kept,
up to ``KEPT_WORDS`` words.  Words are never cut: long ones are walked in logarithms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import crc32_mod, flat, pieces
from revisa.llm.words import byte_table, find_words, per_text_sum, prefix_sums, span_hashes

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Remainder of crc32(doc_id) mod 4 that is never learnt from.
FOLDS, HELD_OUT = 4, 2
#: Bytes of the longest word whose probabilities cannot underflow; longer ones are summed up in logarithms.
SHORT = 32
#: Words a task keeps its findings of.
KEPT_WORDS = 400_000
#: Share of every language's probability spread evenly over the vocabulary.
FLOOR = 1e-3
TABLE = byte_table("alnum", lower=True)
_CODES = np.arange(256)
IS_LETTER = ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122))
FIXED_POINT = 1 << 16


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The pieces as bytes (word mark: a space), without controls and without inner spaces; every single byte is one."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
            found.add(model.id_to_piece(i).replace("▁", " ").encode())
    return sorted(p for p in found if b" " not in p[1:])


class Vocabulary:
    """Pieces by hash, for looking up every span of a buffer."""

    def __init__(self, found: list[bytes]):
        length = np.array([len(p) for p in found])
        end = np.cumsum(length)
        hashes = span_hashes(prefix_sums(np.frombuffer(b"".join(found), np.uint8)), end - length, end)
        self.size = len(found)
        self.ids = np.argsort(hashes)
        self.hashes = hashes[self.ids]
        self.lengths = [int(x) for x in np.unique(length)]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(hashes >> np.uint64(42)).astype(np.int64)] = True

    def edges(self, buf: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) of every vocabulary piece inside the words; ``stop`` is each byte's word end."""
        sums = prefix_sums(buf)
        at = np.arange(len(buf))
        out = []
        for n in self.lengths:
            start = at[at + n <= stop]
            if not len(start):
                break
            h = span_hashes(sums, start, start + n)
            some = self.seen[(h >> np.uint64(42)).astype(np.int64)]
            start, h = start[some], h[some]
            where = np.minimum(np.searchsorted(self.hashes, h), self.size - 1)
            hit = self.hashes[where] == h
            out.append((start[hit], start[hit] + n, self.ids[where[hit]]))
        return tuple(np.concatenate(x) for x in zip(*out))


def distinct_words(data: np.ndarray, off: np.ndarray):
    """The words of a piece of texts: text and distinct word of each, and of the distinct ones hash, bytes' buffer, start and end."""
    words = find_words(data, off, TABLE)
    hashes, first, word = np.unique(words.hash, return_index=True, return_inverse=True)
    return words.text, word, hashes, words.norm, words.start[first], words.end[first]


class Lattice:
    """All segmentations of distinct words, given as spans of a buffer."""

    def __init__(self, norm: np.ndarray, start: np.ndarray, end: np.ndarray, vocabulary: Vocabulary):
        self.n_words = len(start)
        length = end - start + 1
        self.stop = np.cumsum(length)
        self.start = self.stop - length
        owner = np.repeat(np.arange(self.n_words), length)
        inside = np.arange(len(owner)) - self.start[owner]
        buf = np.full(len(owner), 32, np.uint8)
        body = inside > 0
        buf[body] = norm[start[owner[body]] + inside[body] - 1]
        self.n_bytes = len(buf)
        if not self.n_bytes:
            return
        s, e, self.piece = vocabulary.edges(buf, self.stop[owner])
        # nodes: a word of n bytes has n + 1; node = byte + number of words before
        self.source, self.target = s + owner[s], e + owner[s]
        self.edge_word = owner[s]
        self.begin, self.final = self.start + np.arange(self.n_words), self.stop + np.arange(self.n_words)
        self.long = length > SHORT + 1
        depth = e - self.start[owner[s]]
        order = np.lexsort((self.target, depth, self.long[self.edge_word]))  # short words first
        self.source, self.target, self.piece, self.edge_word = (x[order] for x in (self.source, self.target, self.piece, self.edge_word))
        depth, n_short = depth[order], int((~self.long[self.edge_word]).sum())
        self.steps = _steps(depth[:n_short], 0)
        self.long_steps = _steps(depth[n_short:], n_short)

    @classmethod
    def of_texts(cls, data: np.ndarray, off: np.ndarray, vocabulary: Vocabulary) -> Lattice:
        text, word, _, *spans = distinct_words(data, off)
        out = cls(*spans, vocabulary)
        out.text, out.word = text, word
        return out

    def forward(self, p: np.ndarray) -> np.ndarray:
        """Sum over all segmentations up to every node of the short words, one column per language; ``p`` is pieces by languages."""
        alpha = np.zeros((self.n_bytes + self.n_words, p.shape[1]))
        alpha[self.begin] = 1.0
        for a, b in zip(self.steps[:-1], self.steps[1:]):
            target = self.target[a:b]
            heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            alpha[target[heads]] = np.add.reduceat(alpha[self.source[a:b]] * p[self.piece[a:b]], heads, axis=0)
        return alpha

    def forward_logs(self, logp: np.ndarray, alpha: np.ndarray) -> None:
        """The same for the long words, in logarithms, into ``alpha``."""
        alpha[self.begin[self.long]] = 0.0
        for a, b in zip(self.long_steps[:-1], self.long_steps[1:]):
            target = self.target[a:b]
            heads = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]]))
            terms = alpha[self.source[a:b]] + logp[self.piece[a:b]]
            top = np.maximum.reduceat(terms, heads, axis=0)
            terms = np.exp(terms - np.repeat(top, np.diff(np.append(heads, b - a)), axis=0))
            alpha[target[heads]] = top + np.log(np.add.reduceat(terms, heads, axis=0))

    def word_logs(self, p: np.ndarray) -> np.ndarray:
        """Log-probability of every word, summed over its segmentations, one column per language."""
        if not self.n_bytes:
            return np.zeros((self.n_words, p.shape[1]))
        alpha = self.forward(p)
        out = np.zeros((self.n_words, p.shape[1]))
        out[~self.long] = np.log(alpha[self.final[~self.long]])
        if self.long.any():
            self.forward_logs(np.log(p), alpha)
            out[self.long] = alpha[self.final[self.long]]
        return out

    def expected(self, p: np.ndarray) -> np.ndarray:
        """Posterior probability of every edge under one column of piece probabilities."""
        alpha = self.forward(p[:, None])[:, 0]
        beta = np.zeros(len(alpha))
        beta[self.final] = 1.0
        for a, b in zip(self.steps[-2::-1], self.steps[:0:-1]):  # an edge's target is complete before the edge is used
            np.add.at(beta, self.source[a:b], beta[self.target[a:b]] * p[self.piece[a:b]])
        n = self.steps[-1]
        source, target, piece, word = self.source, self.target, self.piece, self.edge_word
        out = np.zeros(len(piece))
        out[:n] = alpha[source[:n]] * p[piece[:n]] * beta[target[:n]] / alpha[self.final[word[:n]]]
        if self.long.any():
            logp, logs = np.log(p), alpha[:, None]
            self.forward_logs(logp[:, None], logs)
            logs, back = logs[:, 0], np.full(len(alpha), -np.inf)
            back[self.final[self.long]] = 0.0
            for a, b in zip(self.long_steps[-2::-1], self.long_steps[:0:-1]):
                np.logaddexp.at(back, source[a:b], back[target[a:b]] + logp[piece[a:b]])
            out[n:] = np.exp(logs[source[n:]] + logp[piece[n:]] + back[target[n:]] - logs[self.final[word[n:]]])
        return out


def _steps(depth: np.ndarray, base: int) -> np.ndarray:
    """Bounds of the runs of equal depth, from ``base``."""
    return base + np.concatenate([[0], np.flatnonzero(depth[1:] != depth[:-1]) + 1, [len(depth)]]) if len(depth) else np.array([base])


class Met:
    """Numbers of the words met so far, by hash."""

    def __init__(self):
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def numbered(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each of these distinct words, and which of them are new (numbered on from the known ones)."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self) - 1, 0))
        new = self.hashes[at] != hashes if len(self) else np.ones(len(hashes), bool)
        out = np.zeros(len(hashes), np.int64)
        out[~new] = self.numbers[at[~new]]
        out[new] = len(self) + np.arange(new.sum())
        both = np.concatenate([self.hashes, hashes[new]])
        order = np.argsort(both, kind="stable")
        self.hashes, self.numbers = both[order], np.concatenate([self.numbers, out[new]])[order]
        return out, new


class Counted:
    """Edges and posteriors of the words met, and their occurrences in every language."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.even = vocabulary, np.full(vocabulary.size, 1.0 / vocabulary.size)
        self.total: dict[str, np.ndarray] = {}
        self.reset()

    def reset(self) -> None:
        self.met, self.edges, self.weights = Met(), [], {}

    def add(self, data: np.ndarray, off: np.ndarray, langs: list[str], codes: np.ndarray) -> None:
        text, word, hashes, norm, start, end = distinct_words(data, off)
        known = len(self.met)
        number, new = self.met.numbered(hashes)
        if new.any():
            lattice = Lattice(norm, start[new], end[new], self.vocabulary)
            self.edges.append((lattice.edge_word + known, lattice.piece, lattice.expected(self.even)))
        for k, name in enumerate(langs):
            mine = np.bincount(number[word[codes[text] == k]], minlength=len(self.met))
            held = self.weights.get(name, np.zeros(0, np.int64))
            mine[: len(held)] += held
            self.weights[name] = mine
        if len(self.met) > KEPT_WORDS:
            self.settle()

    def settle(self) -> None:
        """Sum up the expected counts of the words met, and forget them."""
        for name, weight in self.weights.items():
            weight = np.append(weight, np.zeros(len(self.met) - len(weight), np.int64))
            got = self.total.setdefault(name, np.zeros(self.vocabulary.size))
            for word, piece, posterior in self.edges:
                got += np.bincount(piece, weights=posterior * weight[word], minlength=self.vocabulary.size)
        self.reset()


def count_pieces(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(lang, piece, n): expected piece counts of every language, in fixed point."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        counted = Counted(sent.value)
        for batch in pieces(batches, "text"):
            langs = batch.column(1).dictionary_encode()
            counted.add(*flat(batch.column(0)), langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False))
        counted.settle()
        for name, counts in counted.total.items():
            fixed = np.rint(counts * FIXED_POINT).astype(np.int64)
            some = np.flatnonzero(fixed)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(fixed[some])], names=["lang", "piece", "n"])

    rows = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return rows.mapInArrow(run, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, vocabulary: Vocabulary) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their piece probabilities (pieces by languages).

    What reaches the driver is at most the vocabulary for each language.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc32_mod(F.col("doc_id"), FOLDS) != HELD_OUT))
    got = count_pieces(rows, vocabulary).toArrow()
    names = sorted(set(got.column("lang").to_pylist()), key=lambda x: x.encode())
    code = {n: i for i, n in enumerate(names)}
    counts = np.zeros((vocabulary.size, len(names)))
    counts[got.column("piece").to_numpy(), [code[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy() / FIXED_POINT
    return names, (1 - FLOOR) * counts / counts.sum(axis=0, keepdims=True) + FLOOR / vocabulary.size if names else counts


def has_letter(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    some = per_text_sum(IS_LETTER[data], off) > 0
    buf = None
    for i in np.flatnonzero(~some & (per_text_sum(data >= 128, off) > 0)):
        buf = data.tobytes() if buf is None else buf
        some[i] = any(c.isalpha() for c in buf[off[i] : off[i + 1]].decode("utf-8", "ignore"))
    return some


def predict(docs: DataFrame, names: list[str], probabilities: np.ndarray, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, lang_pred and score (posterior of the predicted language, even prior) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast((vocabulary, probabilities))

    def run(batches):
        vocab, p = sent.value
        met, kept = Met(), np.zeros((0, p.shape[1]))
        for batch in pieces(batches, "text"):
            data, off = flat(batch.column(1))
            n = batch.num_rows
            known = has_letter(data, off) if names else np.zeros(n, bool)
            logs = np.zeros((n, max(len(names), 1)))
            if names:
                text, word, hashes, norm, start, end = distinct_words(data, off)
                if len(met) > KEPT_WORDS:
                    met, kept = Met(), kept[:0]
                number, new = met.numbered(hashes)
                kept = np.concatenate([kept, Lattice(norm, start[new], end[new], vocab).word_logs(p)])
                for k in range(len(names)):
                    logs[:, k] = np.bincount(text, weights=kept[number[word], k], minlength=n)
            best = logs.argmax(axis=1)
            share = np.exp(logs - logs.max(axis=1, keepdims=True))
            score = np.where(known, np.round(1 / share.sum(axis=1), 6), 0.0)
            pred = pa.array([names[b] if ok else "und" for b, ok in zip(best.tolist(), known.tolist())], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pred, pa.array(score)], names=["doc_id", "lang_pred", "score"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def language_id(docs: DataFrame, vocabulary_path: str = VOCABULARY) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred and score.

    Rows with a null lang, text or doc_id are not learnt from.  A null text, one without a
    letter, and every text when nothing could be learnt is ``und`` with score 0.  Equal
    likelihoods go to the first language by code point.  A null doc_id is not held out;
    repeated rows are learnt from and predicted each; an empty table gives no rows.  A word of
    any length is summed over whole, step by step, so a text without spaces takes one short
    numpy step a byte.  Columns of other names are not read.
    """
    vocabulary = Vocabulary(read_vocabulary(vocabulary_path))
    names, probabilities = learn(docs, vocabulary)
    held = F.coalesce(crc32_mod(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return predict(docs, names, probabilities, vocabulary).select("doc_id", held.alias("held_out"), "lang_pred", "score")
