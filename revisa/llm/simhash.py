"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, Hamming check, components.

Fingerprints are split into blocks; two within ``max_bits`` differ in at most that many
blocks, so they agree on all blocks of at least one choice of ``blocks - max_bits`` of
them.  Distinct fingerprints are joined on those choices ("buckets") and verified.
Inside a bucket only a spanning forest of the verified links is returned, never all
pairs.  A bucket with more than ``max_bucket`` fingerprints is not compared pairwise:
its fingerprints go through the midpoint route, where each emits every value within
half the distance; two are linked if and only if they share such a value (distance up
to 2 * radius), and equal values are chained, which is linear in the fingerprints.
Links are then closed into components: contracted in each partition, then by alternating
star steps, each written to the shared folder.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.llm.common import flat, pieces, written
from revisa.operators.components import contracted_where_they_are

SEED = 42
#: Nodes of links a task holds before it hands on what it has contracted: some 50 MB.
HELD_NODES = 1 << 18
#: Bits whose counts are added up at once when a text has very many shingles.
COUNT_ROWS = 1 << 16


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """SimHash of one text's word shingles: a bit is set if set in over half the shingle hashes."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(gaps + 1).tolist()]
    ends = [*gaps.tolist(), len(joined)]
    h = xxhash.xxh64_digest
    tails = ends[shingle - 1 :] or ends[-1:]
    digests = b"".join([h(joined[a:b], SEED) for a, b in zip(starts, tails)])
    rows = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(rows), COUNT_ROWS):
        counts += np.unpackbits(rows[at : at + COUNT_ROWS], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(rows)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """doc_id and ``fp`` (the fingerprint as a signed 64-bit integer) of each whole text; null is empty."""

    def run(batches):
        for batch in pieces(batches, "text"):
            data, off = flat(batch.column(1))
            buf = data.tobytes()
            fps = [fingerprint(buf[a:b], shingle) for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "fp"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def bucket_keys(fps: DataFrame, max_bits: int, blocks: int) -> DataFrame:
    """Each fingerprint under every choice of ``blocks - max_bits`` blocks: choice, key, fp."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - max_bits):
        m = sum(((1 << (edges[b + 1] - edges[b])) - 1) << edges[b] for b in chosen)
        masks.append(m - (1 << 64) if m >= 1 << 63 else m)
    keys = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    return fps.select("fp", F.explode(keys).alias("k")).select("k.choice", "k.key", "fp")


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph "differ in at most ``max_bits`` bits", by breadth-first search."""
    left = np.sort(fps).view(np.uint64)
    links = []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            one, front = front[0], front[1:]
            near = np.bitwise_count(left ^ one) <= max_bits
            if near.any():
                found = left[near]
                links += [(int(np.int64(one)), int(x)) for x in found.view(np.int64)]
                front, left = np.concatenate([front, found]), left[~near]
    return links


def ball(fp: np.ndarray, radius: int) -> np.ndarray:
    """Every value within ``radius`` bits of each fingerprint, one row per fingerprint."""
    flips = [0]
    for r in range(1, radius + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(64), r)]
    return fp[:, None] ^ np.array(flips, np.uint64)[None, :]


def links(fps: DataFrame, max_bits: int = 4, blocks: int = 7, max_bucket: int = 4096) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect exactly what lies within ``max_bits``.

    ``fps`` holds distinct ``fp``.
    """
    keys = bucket_keys(fps, max_bits, blocks)
    sizes = written(keys.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-buckets")
    members = keys.join(sizes, ["choice", "key"])

    def compare(table: pa.Table) -> pa.Table:
        found = forest(table.column("fp").to_numpy(), max_bits)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    small = members.where(F.col("n") <= max_bucket).select("choice", "key", "fp").groupBy("choice", "key").applyInArrow(compare, "a long, b long")
    crowded = members.where(F.col("n") > max_bucket).select("fp").distinct()
    return small.unionByName(midpoint_links(crowded, max_bits)).distinct()


def midpoint_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links among ``fps`` by shared values within half the distance; exact and without pairs.

    For an even ``max_bits`` two fingerprints within it share a value within half of it
    of both, and fingerprints that share one are within it.  An odd distance is checked
    by flipping one side a bit further and is not supported.
    """
    if max_bits % 2:
        raise ValueError("the midpoint route needs an even max_bits")

    def spread(batches):
        for batch in batches:
            all_fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(all_fp), 512):
                fp = all_fp[at : at + 512]
                out = ball(fp, max_bits // 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out.ravel().view(np.int64)), pa.array(np.repeat(fp, out.shape[1]).view(np.int64))], names=["value", "fp"]
                )

    points = fps.mapInArrow(spread, "value long, fp long")
    first = points.groupBy("value").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return points.join(first, "value").where("fp <> a").select("a", F.col("fp").alias("b"))


def components(edges: DataFrame, name: str = "components", held_nodes: int = HELD_NODES) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the component's smallest node.

    Every partition first contracts its own edges to stars, with at most about ``held_nodes``
    nodes in memory at once; edges that fit there are done.  What is left is closed by
    alternating star steps: every node's larger neighbours, then its smaller ones, are linked
    to its smallest neighbour, until all links are stars.  A step's links are at most
    those before it plus the nodes, hubs are grouped with map-side minima, and each round
    is written to the shared folder.
    """
    stars = contracted_where_they_are(edges.where("a <> b").select("a", "b"), held_nodes)
    now = written(stars.select(F.col("root").alias("a"), F.col("node").alias("b")), name)
    while not settled(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        low = written(low, name)  # a plain join input: a hub's rows can be split
        large = both.where("b > a").join(low, "a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()
        large = written(large, name)
        up = written(large.groupBy("b").agg(F.min("a").alias("m")), name)  # likewise
        small = large.join(up, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        now = written(small.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), name)
    roots = now.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def settled(links: DataFrame) -> bool:
    """Whether links (a < b) are stars: no b has two different a, and none is an a itself."""
    ends = F.array(F.struct(F.col("b").alias("node"), F.col("a").alias("root")), F.struct(F.col("a").alias("node"), F.col("a").alias("root")))
    nodes = links.select(F.explode(ends).alias("x")).groupBy("x.node").agg(F.min("x.root").alias("low"), F.max("x.root").alias("high"))
    return nodes.where("low <> high").isEmpty()


def near_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, blocks: int = 7, max_bucket: int = 4096) -> DataFrame:
    """Per document: doc_id, ``fp`` (long) and component_id (the smallest doc_id reachable by links).

    Every row gets a result; rows with one id are told apart by nothing else and keep
    their own fingerprints.  A text without words has fingerprint 0.  A null id keeps its
    row; it is the component id only where no other id is reachable.  An empty table gives
    no rows; other columns are not read, whatever their names.  A text is hashed whole, in
    some tens of times its bytes.
    """
    prints = written(fingerprints(docs, shingle), "simhash-fp")
    least = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = written(components(links(least.select("fp"), max_bits, blocks, max_bucket), "simhash-star"), "simhash-roots")
    tied = least.join(roots, least.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = written(tied.groupBy("root").agg(F.min("least").alias("component_id")), "simhash-least")  # so that a large component's rows can be split
    by_fp = written(tied.join(ids, "root").select(F.col("fp").alias("_fp"), "component_id"), "simhash-ids")
    return prints.join(by_fp, prints.fp == by_fp._fp).select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents without those whose near group has a smaller doc_id.  Rows with a null id stay, and rows that repeat the kept id."""
    groups = near_groups(docs, shingle, max_bits)
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    known = docs.where(F.col("doc_id").isNotNull())
    # rows with a null id stay out of the join, where they would meet in one task
    return known.join(gone, known.doc_id == F.col("_gone"), "left_anti").unionByName(docs.where(F.col("doc_id").isNull()))
