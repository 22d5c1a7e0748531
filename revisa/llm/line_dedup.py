"""Line dedup over all documents, in DataFrame functions only.

Lines are hashed (two 64-bit hashes of the key), range-partitioned by hash and sorted
by document and position inside a hash; one pass over that order carries the first
document of each hash and marks the lines that repeat it from an earlier document.
What comes back is not text but, per document, the runs of dropped line numbers (a
run-length compressed keep bitmap); the documents are then cut by it.

Keys that hold very many lines are settled before the shuffle: their first document is
known from a partially aggregated minimum, and their lines are marked by a broadcast
join with that bounded list, so no task receives a whole hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revisa.llm.common import ascii_lower, written

#: Most keys in the list of hot keys, and fewest lines that make a key hot.
MAX_HOT_KEYS, MIN_HOT_LINES = 100_000, 1_000
WHITE = " \t\n\x0b\x0c\r"


def line_key(line):
    """The line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _named(docs: DataFrame) -> DataFrame:
    """doc_id, the text (null: empty) and a hash of it, which together name a row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id"), text.alias("text"), F.xxhash64(text).alias("th"))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key has ``min_chars`` code points: h1, h2, doc_id, th, pos."""
    lines = _named(docs).select("doc_id", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    keys = lines.select("doc_id", "th", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "th", "pos")


def dropped_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, th, pos) of every line that an earlier document already holds."""
    lines = written(line_hashes(docs, min_chars), "line-hashes")  # read three times below
    # null ids sort after all others
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id"))
    keys = written(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1"), "line-keys")
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # fewer than total / MAX_HOT_KEYS keys can hold so many lines: the list has a proven bound
    hot = keys.where(F.col("n") > max(MIN_HOT_LINES, total // MAX_HOT_KEYS)).select("h1", "h2", "first")
    marked = lines.join(F.broadcast(hot), ["h1", "h2"], "left")
    later = ~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    settled = marked.where(F.col("first").isNotNull() & later).select("doc_id", "th", "pos")

    order = Window.partitionBy("h1", "h2").orderBy(F.col("doc_id").isNull(), "doc_id", "pos")
    ranged = (
        lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti")
        .repartitionByRange(F.col("h1"), F.col("h2"))
        .sortWithinPartitions("h1", "h2", F.col("doc_id").isNull(), "doc_id", "pos")
    )
    streamed = ranged.withColumn("first", F.first(F.struct("doc_id")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return streamed.where(later).select("doc_id", "th", "pos").unionByName(settled)


def keep_runs(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """Per document with dropped lines: ``runs``, the (start, length) runs of line numbers to drop, in order."""
    drops = dropped_lines(docs, min_chars).groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("pos")).alias("d"))
    begins = F.filter("d", lambda x, i: (i == 0) | (F.get("d", i - 1) != x - 1))
    ends = F.filter("d", lambda x, i: (i == F.size("d") - 1) | (F.get("d", i + 1) != x + 1))
    drops = drops.select("doc_id", "th", F.size("d").alias("n_dropped"), begins.alias("b"), ends.alias("e"))
    return drops.select("doc_id", "th", "n_dropped", F.transform("b", lambda s, i: F.struct(s.alias("start"), (F.get("e", i) - s + 1).alias("length"))).alias("runs"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, keep: list[str] | None = None) -> DataFrame:
    """Documents without the lines that an earlier document (smaller doc_id) already holds.

    ``docs`` has doc_id and text; columns named in ``keep`` are carried along.  Returns
    doc_id, the kept text, n_lines, n_dropped and ``runs``.  A key of fewer than
    ``min_chars`` code points never drops.  Rows with one doc_id are one document when
    holders are told apart; a null id counts as one document after all others; a null
    or empty text is one empty line.  Repeats inside the first document stay.
    """
    extra = [F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep or [])]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("_text"), F.xxhash64(text).alias("_th"), *extra)
    runs = keep_runs(docs, min_chars).select(F.col("doc_id").alias("_id"), F.col("th"), "n_dropped", "runs")
    both = rows.join(runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("th")), "left")
    n_lines = F.size(F.split("_text", "\n"))
    # the kept stretches lie before, between and after the dropped runs
    kept = F.expr(
        """flatten(transform(sequence(0, size(runs)), i -> slice(split(_text, '\n'),
             if(i = 0, 0, get(runs, i - 1).start + get(runs, i - 1).length) + 1,
             if(i = size(runs), size(split(_text, '\n')), get(runs, i).start)
               - if(i = 0, 0, get(runs, i - 1).start + get(runs, i - 1).length))))"""
    )
    out = F.when(F.col("runs").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    return both.select(
        "doc_id",
        out.alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("runs", F.array()).alias("runs"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep or [])],
    )
