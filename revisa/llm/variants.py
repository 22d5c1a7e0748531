"""Spelling variants by asymmetric q-chunks: words one edit apart, and the commoner form each stands for.

For a pair of words one code point apart, the longer one (of equal ones, either) is cut
into two disjoint chunks that cover it.  The edit leaves one of them whole, and the other
word holds that chunk as a positional gram within one place of where it stood: unshifted
before the edit, shifted by the difference in length behind it.  So the longer word
contributes its chunks, the shorter one all grams that stand where a chunk of a word as long
or one longer can stand, and they meet in one join.  A short chunk is shared by very many
words; the chunk with the edit is therefore cut in two again, one half of which is whole
as well and takes part in the key.  Each candidate pair is verified by its edit distance.
"""

from __future__ import annotations

import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import flat, written

#: Code points of the shortest word, occurrences of the rarest, and how much commoner a form is.
MIN_CHARS, MIN_COUNT, TIMES = 6, 5, 5
#: A run is cut by one code point where this divides the checksum of id and run.
CUT_EVERY = 199
#: Distinct words a task holds before it hands on their counts.
TASK_WORDS = 200_000


def runs_of(min_chars: int):
    """Pattern of the maximal runs of letters that hold ``min_chars`` code points or more, A-Z already lower-cased."""
    return re.compile("[a-zÀ-ÿ]{%d,}" % min_chars)


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of all texts, after the cuts, that are long and frequent enough.

    A task counts a text's distinct runs once and emits partial sums when it holds
    ``TASK_WORDS`` words, so its memory is bounded by that and the longest text.
    """

    def run(batches):
        find, total = runs_of(min_chars).findall, {}
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, off = flat(batch.column(1))
            for i, doc_id in enumerate(ids):
                # bytes.lower() changes A-Z alone
                found = find(data[off[i] : off[i + 1]].tobytes().lower().decode("utf-8", "replace"))
                mine: dict[str, int] = {}
                for word in found:
                    mine[word] = mine.get(word, 0) + 1
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in mine.items():
                    h = zlib.crc32(word.encode(), start)
                    if h % CUT_EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < min_chars:
                            continue
                    total[word] = total.get(word, 0) + n
                if len(total) >= TASK_WORDS:
                    yield counted(total)
                    total = {}
        if total:
            yield counted(total)

    def counted(total):
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _cuts(length: Column) -> list[Column]:
    """Bounds of the two chunks of a word of so many code points, and of the halves of each: start, quarter, half, quarter, end."""
    half = F.floor(length / 2)
    return [c.cast("int") for c in (F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length)]


def _kept(word: Column, length: Column, shift: int) -> list[Column]:
    """For each half chunk that may hold the edit: (length, broken, chunk, rest), what is whole of a word of ``length`` code points.

    ``chunk`` is the chunk that the edit misses, ``rest`` the half of the other chunk that it
    misses too.  They are read where the edit leaves them: unshifted before it, shifted
    by ``shift``, the difference in length, behind it.
    """
    cut = _cuts(length)

    def span(a, b, moved):
        return F.substring(word, cut[a] + 1 + (shift if moved else 0), cut[b] - cut[a])

    whole = [(span(2, 4, True), span(1, 2, True)), (span(2, 4, True), span(0, 1, False)), (span(0, 2, False), span(3, 4, True)), (span(0, 2, False), span(2, 3, False))]
    return [F.struct(length.alias("length"), F.lit(i).alias("broken"), chunk.alias("chunk"), rest.alias("rest")) for i, (chunk, rest) in enumerate(whole)]


KEY = ["length", "broken", "chunk", "rest"]


def chunks(words: DataFrame) -> DataFrame:
    """The two disjoint chunks of every word, each with either half of the other."""
    size = F.char_length("word")
    return words.select(F.explode(F.array(*_kept(F.col("word"), size, 0))).alias("x"), "word", "n").select("x.*", "word", "n")


def grams(words: DataFrame) -> DataFrame:
    """The positional grams of every word that are whole chunks of a word as long or one longer, if one edit parts them."""
    size = F.char_length("word")
    every = F.array(*_kept(F.col("word"), size, 0), *_kept(F.col("word"), size + 1, -1))
    return words.select(F.explode(every).alias("x"), F.col("word").alias("other"), F.col("n").alias("m")).select("x.*", "other", "m")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, m): every unordered pair of different words one edit apart, once."""
    met = chunks(words).join(grams(words), KEY)
    met = met.where((F.char_length("other") < F.col("length")) | (F.col("word") < F.col("other")))
    met = met.where(F.levenshtein("word", "other", 1) == 1)
    # a code point more in a run of equal ones can be any of them, in more than one half
    return met.select("word", "n", "other", "m").distinct()


def forms(pairs: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n) of the words with a near word; the form is null where none is common enough."""
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("less"), F.col("other").alias("form")))
    got = both.groupBy("word").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    common = -F.col("best.less") >= TIMES * F.col("n")
    return got.select("word", "n_near", F.when(common, F.col("best.form")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n"))


def roots(linked: DataFrame) -> DataFrame:
    """(word, root): the last word on each word's path of forms, by pointer jumping.

    A form is ``TIMES`` as common as its word, so a path is no longer than the logarithm of
    the largest count and the rounds are few.
    """
    now = written(linked.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left")
        step = written(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        now = step.select("word", "root")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """Per word: word, n, n_near, form, form_n and root (the word itself without a form).

    Words are the maximal runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased, after
    the contract's cuts; words with fewer than ``min_chars`` code points or ``min_count``
    occurrences are no words here.  A null or empty text has none; a null doc_id is the
    empty text in the checksum; repeated rows count each time; of equally common near
    words the smallest by code point is the form.  Texts are read whole, one at a time: a
    task needs some ten times a text's bytes.  Other columns are not read, whatever their
    names.  An empty table gives no rows.
    """
    words = written(count_words(docs, min_chars, min_count), "variants-words")
    found = written(forms(near_pairs(words)), "variants-forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    out = words.join(found, "word", "left").join(ends, "word", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
