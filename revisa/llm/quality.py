"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs of every text are hashed into a fixed number of bins.  Two
multinomials over the bins are counted, one over the trusted documents (labelled
quality 1) and one over the whole corpus; a text's score is the mean over its n-grams
of log p_target - log p_raw.  The threshold is fixed by a rule: a small quantile of the
scores of trusted documents that were held out of the target counts, less a margin, so
it is the same for every run over the same data and applies to every document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import crc32_mod, flat, labelled, pieces, written
from revisa.llm.words import Words, byte_table, find_words, mix, per_text_sum, prefix_sums, rolling, span_hashes, spans

BINS = 1 << 16
#: Trusted documents with this remainder of crc32(doc_id) mod 5 set the threshold, the others the target counts.
FOLDS, HELD_FOLD = 5, 4
#: Share of held-out trusted documents below the threshold, and the margin subtracted from it.
QUANTILE, MARGIN = 0.002, 0.05
#: Documents with fewer n-grams than this are judged by the base rules alone.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = b"#*$%&|<>"
TABLE = byte_table("space", lower=False)
IS_SYMBOL = np.isin(np.arange(256, dtype=np.uint8), list(SYMBOLS))


def bins_of(words: Words, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and text number of every word and word pair."""
    pairs, at = rolling(words.hash, words.text, 2)
    grams = np.concatenate([words.hash, pairs])
    return (mix(grams) & np.uint64(bins - 1)).astype(np.int64), np.concatenate([words.text, words.text[at]])


def count_bins(docs: DataFrame, bins: int = BINS) -> DataFrame:
    """(bin, target, raw): n-grams of the rows flagged ``in_target``, and of all rows."""

    def run(batches):
        total = np.zeros((2, bins), np.int64)
        for batch in pieces(batches, "text"):
            words = find_words(*flat(batch.column(0)), TABLE)
            which, text = bins_of(words, bins)
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            total[0] += np.bincount(which[target[text]], minlength=bins)
            total[1] += np.bincount(which, minlength=bins)
        some = np.flatnonzero(total[1])
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])], names=["bin", "target", "raw"])

    counted = docs.select(F.col("text").cast("string").alias("text"), "in_target").mapInArrow(run, "bin long, target long, raw long")
    return counted.groupBy("bin").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def log_ratios(counts: DataFrame, bins: int = BINS) -> np.ndarray:
    """log p_target - log p_raw per bin, add-one smoothed.  At most ``bins`` rows reach the driver."""
    got = counts.toArrow()
    target, raw = np.ones(bins), np.ones(bins)
    at = got.column("bin").to_numpy()
    target[at] += got.column("target").to_numpy()
    raw[at] += got.column("raw").to_numpy()
    if target.sum() == bins:  # no trusted text: nothing to compare with
        return np.zeros(bins)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def repeated_words(words: Words, size: int = WINDOW) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur twice or more in the text."""
    grams, at = rolling(words.hash, words.text, size)
    owner = words.text[at]
    keys = mix(grams + mix(owner.astype(np.uint64)))
    _, which, n = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[n[which] > 1]
    step = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(step, hit, 1)
    np.add.at(step, hit + size, -1)
    inside = np.cumsum(step)[:-1] > 0
    return np.bincount(words.text[inside], minlength=words.n_texts)


def repeated_lines(data: np.ndarray, off: np.ndarray, words: Words) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of it."""
    start, end = spans(data != 10, off)  # empty lines hold no word
    text = np.searchsorted(off, start, side="right") - 1
    has = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    sums = prefix_sums(data.astype(np.uint64) + np.uint64(1))
    keys = mix(span_hashes(sums, start[has], end[has]) + mix(text[has].astype(np.uint64)))
    _, first = np.unique(keys, return_index=True)
    again = np.ones(len(keys), bool)
    again[first] = False
    return np.bincount(text[has][again], minlength=len(off) - 1)


def measure(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Per row: doc_id, the base counts and the length-normalised log-likelihood ratio ``llr``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios.astype(np.float32))
    bins = len(ratios)

    def run(batches):
        for batch in pieces(batches, "text"):
            data, off = flat(batch.column(1))
            words = find_words(data, off, TABLE)
            which, text = bins_of(words, bins)
            n = np.maximum(np.bincount(text, minlength=words.n_texts), 1)
            llr = np.bincount(text, weights=sent.value[which], minlength=words.n_texts) / n
            chars = per_text_sum((words.norm != 0) & ((data & 0xC0) != 0x80), off)
            columns = [words.per_text, chars, per_text_sum(IS_SYMBOL[data], off), repeated_lines(data, off, words), repeated_words(words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c.astype(np.int64)) for c in columns], pa.array(np.round(llr, 9))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, llr double"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def score_at(counts: DataFrame, rank: int) -> int:
    """The score with ``rank`` smaller rows, from (score, count); each step brings at most 2^16 rows to the driver."""
    found = 0
    for shift in (48, 32, 16, 0):
        within = counts if shift == 48 else counts.where(F.shiftright("score", shift + 16) == found)
        for r in within.groupBy(F.shiftright("score", shift).alias("part")).agg(F.sum("count").alias("n")).orderBy("part").collect():
            if rank < r["n"]:
                found = r["part"]
                break
            rank -= r["n"]
    return found


def quantile(scores: DataFrame, share: float) -> float | None:
    """Exact quantile, between two rows in proportion, of ``llr`` (nine decimals); None without rows."""
    whole = F.round(F.col("llr") * 1e9).cast("long").alias("score")
    counts = written(scores.select(whole).groupBy("score").count(), "quality-scores")
    total = counts.agg(F.sum("count").alias("n")).first()["n"]
    if not total:
        return None
    at = (total - 1) * share
    low = int(at)
    first = score_at(counts, low) / 1e9
    return first if low == at else (low + 1 - at) * first + (at - low) * (score_at(counts, low + 1) / 1e9)


def quality_rules(docs: DataFrame, labels: DataFrame, bins: int = BINS) -> DataFrame:
    """Per document: doc_id, n_words, the base counts, base_failed, kept, llr and threshold.

    ``labels`` has doc_id and quality (1: trusted).  Every labelled row counts, for the
    target and for the threshold; corpus counts cover every row.  A null text has no words and fails the
    base rules; without any trusted row all ratios are 0 and the base rules decide alone.
    A null doc_id is never trusted.
    """
    trusted = labelled(labels, "quality", F.lit(True)).where("label = 1").select(F.col("doc_id").alias("_trusted"))
    trusted = trusted.hint("merge")  # both tables grow: the same plan at every size
    fold = crc32_mod(F.col("doc_id"), FOLDS)
    target = docs.select("doc_id", "text").where(fold != HELD_FOLD).join(trusted, F.col("doc_id") == F.col("_trusted"))
    counts = count_bins(target.withColumn("in_target", F.lit(True)), bins).select("bin", "target", F.lit(0).cast("long").alias("raw"))
    counts = counts.unionByName(count_bins(docs.withColumn("in_target", F.lit(False)), bins))
    ratios = log_ratios(counts.groupBy("bin").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")), bins)

    held = measure(docs.where(fold == HELD_FOLD), ratios).where(F.col("n_words") >= MIN_WORDS).select("doc_id", "llr")
    low = quantile(held.join(trusted, F.col("doc_id") == F.col("_trusted"), "left_semi"), QUANTILE)
    threshold = float("-inf") if low is None else low - MARGIN

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = measure(docs, ratios).withColumn("base_failed", failed).withColumn("threshold", F.lit(threshold))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.col("threshold")))
    return rows.select(*[c for c in rows.columns if c not in ("llr", "threshold")], "llr", "threshold")
