"""Benchmark decontamination by a distributed positional inverted index.

The index is cut by documents: each segment (some megabytes of texts) stores its terms in
order with their posting lists (word positions counted through the segment) and where its
documents begin, as one row of a Parquet table in the shared folder.  Test windows are
sent to the segments in blocks of bounded size.  Within a segment a window's posting
lists are offset-adjusted (position less the term's place in the window) and intersected
from the rarest term over the whole corpus on; nothing is shuffled but the few documents
that match.  Besides exact phrases, proximity matches are found: all but one of the
window's terms within ``slop`` words of their places.

Terms are 64-bit word hashes.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import flat, pieces, shared_folder, written
from revisa.llm.words import byte_table, find_words

TABLE = byte_table("alnum", lower=True)
WINDOW, SLOP = 10, 2
#: Text bytes of a segment, of a block of test items, and segments per index file.
SEGMENT_BYTES, BLOCK_BYTES, FILE_SEGMENTS = 4 << 20, 4 << 20, 8
#: Starts of windows that a task looks at together.
PORTION = 1 << 18


def build_index(docs: DataFrame) -> DataFrame:
    """One row per segment: segment, doc_id[], n_words[], first[] (word offsets of the documents, one more), terms[], ends[], positions[]."""

    def run(batches):
        for batch in pieces(batches, "text", SEGMENT_BYTES):
            words = find_words(*flat(batch.column(1)), TABLE)
            order = np.argsort(words.hash, kind="stable")
            ordered = words.hash[order]
            heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
            ends = np.concatenate([heads[1:], [len(ordered)]]) if len(heads) else heads
            lists = [batch.column(0), pa.array(words.per_text.astype(np.int64)), pa.array(words.first.astype(np.int32)), pa.array(ordered[heads].view(np.int64)), pa.array(ends.astype(np.int32)), pa.array(order.astype(np.int32))]
            row = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), *row], names=["segment", "doc_id", "n_words", "first", "terms", "ends", "positions"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"segment string, doc_id array<{kind}>, n_words array<long>, first array<int>, terms array<long>, ends array<int>, positions array<int>"
    index = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
    path = shared_folder(docs.sparkSession, "postings")
    index.write.option("compression", "zstd").option("maxRecordsPerFile", FILE_SEGMENTS).parquet(path)
    return docs.sparkSession.read.schema(index.schema).parquet(path)


class Windows:
    """Distinct windows of a block of test items: terms by place (0 beyond a short item's end), lengths, and which items hold them."""

    def __init__(self, texts: list[bytes], size: int):
        off = np.cumsum([0, *[len(t) for t in texts]])
        words = find_words(np.frombuffer(b"".join(texts), np.uint8), off, TABLE)
        n = words.per_text
        item = np.repeat(np.arange(len(texts)), np.where(n > 0, np.maximum(n - size, 0) + 1, 0))
        place = np.arange(len(item)) - np.searchsorted(item, item)
        length = np.minimum(n[item], size)
        at = words.first[item][:, None] + place[:, None] + np.arange(size)
        inside = np.arange(size) < length[:, None]
        terms = np.where(inside, words.hash[np.where(inside, at, 0)], np.uint64(0)) if len(item) else np.zeros((0, size), np.uint64)
        rows = np.ascontiguousarray(np.column_stack([terms, length.astype(np.uint64)])).view(np.dtype((np.void, 8 * (size + 1)))).ravel()
        _, first, number = np.unique(rows, return_index=True, return_inverse=True)
        self.terms, self.length = terms[first], length[first].astype(np.int64)
        self.held = np.unique(np.column_stack([number.ravel(), item]), axis=0)  # (window, item)
        within = inside[first]
        self.vocabulary = np.unique(self.terms[within]) if len(first) else np.zeros(0, np.uint64)
        self.number = np.where(within, np.searchsorted(self.vocabulary, self.terms), -1) if len(first) else np.zeros((0, size), np.int64)
        self.order = np.tile(np.arange(size), (len(first), 1))

    def by_rarity(self, counts: np.ndarray) -> None:
        """Order every window's places from the rarest term of the corpus to the commonest; ``counts`` by term of the vocabulary."""
        of = np.where(self.number >= 0, counts[self.number], np.iinfo(np.int64).max)
        self.order = np.argsort(of, axis=1, kind="stable")


class Segment:
    """One row of the index."""

    def __init__(self, first, terms, ends, positions):
        self.first, self.terms, self.ends, self.positions = first, terms.view(np.uint64), ends, positions

    def find(self, terms: np.ndarray) -> np.ndarray:
        """Number of each term in the segment, or -1."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def matches(self, asked: Windows, slop: int | None):
        """(window, start, exact) of the starts where a window stands, in bounded portions.

        A window's starts come from the offset-adjusted posting list of its rarest term (for
        proximity also of the second rarest); the lists of the other terms are intersected
        from the rarest on, a posting being looked up by its position.  A near start has all
        terms but one within ``slop`` words of their places.
        """
        size = asked.terms.shape[1]
        seen = self.find(asked.vocabulary)
        found = np.where(asked.number >= 0, seen[asked.number], -1) if len(seen) else np.full(asked.terms.shape, -1)
        absent = ((found < 0) & (asked.number >= 0)).sum(axis=1)
        allowed = (asked.length >= 3).astype(np.int64) if slop is not None else np.zeros(len(absent), np.int64)
        some = np.flatnonzero(absent <= allowed)
        margin = size + (slop or 0)
        term_at = np.full(len(self.positions) + 2 * margin, -1, np.int64)
        begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        term_at[self.positions + margin] = np.repeat(np.arange(len(self.terms)), self.ends - begins)
        leads = asked.order[some][:, : 1 if slop is None else 2]
        term = np.take_along_axis(found[some], leads, axis=1)
        lead_size = np.where(term >= 0, self.ends[term] - begins[term], 0)
        lead_size[:, 1:][asked.length[some] < 3] = 0
        for portion in _portions(lead_size.sum(axis=1), PORTION):
            n = lead_size[portion].ravel()
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start = self.positions[np.repeat(begins[term[portion]].ravel(), n) + offset].astype(np.int64) - np.repeat(leads[portion].ravel(), n)
            k = np.repeat(np.repeat(some[portion], leads.shape[1]), n)
            keep = (start >= 0) & (start + asked.length[k] <= len(self.positions))
            key = np.unique(k[keep] * (len(self.positions) + 1) + start[keep])
            k, start = np.divmod(key, len(self.positions) + 1)
            missed, exact = absent[k].copy(), absent[k] == 0
            for rank in range(size):
                place = asked.order[k, rank]
                wanted = found[k, place]
                at = start + place + margin
                open_ = rank < asked.length[k]
                here = term_at[at] == wanted
                exact &= here | ~open_
                if slop is None:
                    live = exact
                else:
                    close = here.copy()
                    for d in range(1, slop + 1):
                        close |= (term_at[at - d] == wanted) | (term_at[at + d] == wanted)
                    missed += open_ & (wanted >= 0) & ~close
                    live = missed <= allowed[k]
                k, start, missed, exact = k[live], start[live], missed[live], exact[live]
            one = self.text(start) == self.text(start + asked.length[k] - 1)
            if one.any():
                yield k[one], start[one], exact[one]

    def text(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, position, side="right") - 1


def _portions(sizes: np.ndarray, most: int):
    """Slices whose sizes sum to about ``most``, or one element."""
    run, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = int(np.searchsorted(run, (run[at - 1] if at else 0) + most, side="right"))
        end = max(end, at + 1)
        yield slice(at, end)
        at = end


def _segments(batches, names):
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            yield tuple(row[n][i].as_py() if n == "segment" else row[n][i].values.to_numpy(zero_copy_only=False) for n in names)


def term_counts(index: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """Occurrences of the test terms in the whole corpus; at most one row per test term reaches the driver."""
    sent = index.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        total = np.zeros(len(sent.value), np.int64)
        for terms, ends in _segments(batches, ["terms", "ends"]):
            found = Segment(None, terms, ends, None).find(sent.value)
            some = found[found >= 0]
            total[found >= 0] += ends[some] - np.where(some > 0, ends[np.maximum(some - 1, 0)], 0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "n"])

    got = index.select("terms", "ends").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(len(vocabulary), np.int64)
    out[got.column("term").to_numpy()] = got.column("n").to_numpy()
    sent.unpersist()
    return out


def search(index: DataFrame, windows: Windows, slop: int | None = SLOP, base: int = 0) -> DataFrame:
    """One row per match: segment, ord (document in it), at (word in the document), length, win (window number from ``base``), kind (phrase or near).

    ``slop`` None: exact phrases only.
    """
    sent = index.sparkSession.sparkContext.broadcast(windows)

    def run(batches):
        asked = sent.value
        for name, first, terms, ends, positions in _segments(batches, ["segment", "first", "terms", "ends", "positions"]):
            for k, start, exact in Segment(first, terms, ends, positions).matches(asked, slop):
                text = np.searchsorted(first, start, side="right") - 1
                columns = [
                    pa.array([name] * len(k)),
                    pa.array(text.astype(np.int32)),
                    pa.array((start - first[text]).astype(np.int32)),
                    pa.array(asked.length[k].astype(np.int32)),
                    pa.array(k + base),
                    pa.array(np.where(exact, "phrase", "near")),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "ord", "at", "length", "win", "kind"])

    return index.select("segment", "first", "terms", "ends", "positions").mapInArrow(run, "segment string, ord int, at int, length int, win long, kind string")


def matches(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = SLOP) -> tuple[DataFrame, DataFrame]:
    """Matches of all test items, and (win, item_id) of their windows.

    The items are read in blocks of about ``BLOCK_BYTES`` of text; a block's windows are arrays
    of some ten times that, and its matches are written before the next block is read, so
    neither driver nor executors hold more than one block.
    """
    spark = index.sparkSession
    asked = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null and text is not null").distinct()
    total = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = int(total // BLOCK_BYTES) + 1
    found, items = [], []
    for b in range(blocks):
        got = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).toArrow().combine_chunks().sort_by("id")
        data, off = flat(got.column("text").combine_chunks()) if got.num_rows else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        windows = Windows([data[x:y].tobytes() for x, y in zip(off[:-1], off[1:])], window)
        if len(windows.length):
            windows.by_rarity(term_counts(index, windows.vocabulary))
        base = b << 40
        found.append(written(search(index, windows, slop, base), "benchmark-matches"))
        ids = got.column("id").combine_chunks() if got.num_rows else pa.array([], pa.string())
        held = pa.table({"win": pa.array(windows.held[:, 0] + base, pa.int64()), "item_id": ids.take(pa.array(windows.held[:, 1])).cast(pa.string())})
        items.append(written(spark.createDataFrame(held), "benchmark-items"))
    for more in (found, items):
        while len(more) > 1:
            more.append(more.pop(0).unionByName(more.pop(0)))
    return found[0], items[0]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int | None = SLOP) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside exact phrases), items (sorted), near_items and contaminated.

    ``benchmark`` has item_id and text; an item shorter than the window is one window, one
    without words, or with a null id or text, has none.  Rows are told apart even if their
    ids are equal or null; a null text has no words.  Proximity matches are reported, not
    counted as hits.
    """
    index = build_index(docs)
    found, items = matches(index, benchmark, window, slop)
    ids = [F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("item_id")))) for k in ("phrase", "near")]
    words = found.where("kind = 'phrase'").select("segment", "ord", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).alias("w")).distinct()
    words = words.groupBy("segment", "ord").agg(F.count(F.lit(1)).alias("n_hit"))
    named = found.select("segment", "ord", "win", "kind").distinct().join(items, "win").groupBy("segment", "ord").agg(ids[0].alias("items"), ids[1].alias("near_items"))
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_id", "n_words")).alias("ord", "r")).select("segment", "ord", "r.doc_id", "r.n_words")
    out = rows.join(words, ["segment", "ord"], "left").join(named, ["segment", "ord"], "left")
    empty = F.array().cast("array<string>")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", empty).alias("items"),
        F.array_except(F.coalesce("near_items", empty), F.coalesce("items", empty)).alias("near_items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
