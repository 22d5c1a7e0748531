"""Merkle manifest of a dataset: a digest per row, a tree per source, a tree over the sources, and a proof per row.

Rows are ordered by a distributed rank (range-partitioned sort, row numbers in each range,
offsets by range), and digests are joined in runs of ``fan`` level by level.  Proofs come from
pointer jumping: each inner node holds its segment, the siblings on the way to an ancestor
(at first its parent); a round joins the nodes with themselves, so that each appends the
segment its ancestor holds, and the distance doubles.  Rows make one last jump to their
parent's segment, so that only a sixteenth of the nodes carries long segments through shuffles.

Nodes are named (tree, level, place).  The tree over sources is number -1; the node that holds
a whole source is a leaf of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from revisa.llm.common import ascii_lower, written

FAN, DIGEST = 16, 64
TOP = -1
SEGMENTS = "array<struct<before:string,behind:string>>"
#: Rows whose crc32(doc_id) this divides are checked after tampering.
TAMPER_EVERY = 5


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*[p.cast("binary") for p in parts]), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it, or a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered): both digests of every row; ``tampered`` is null where the row is left alone."""

    def of(text: Column) -> Column:
        return digest(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))

    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return docs.select(F.col("source").cast("string").alias("source"), "doc_id", of(F.col("text")).alias("leaf"), F.when(hit, of(ascii_lower(F.col("text").cast("string")))).alias("tampered"))


def ranked(rows: DataFrame, group: list[str], order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written in order with ``_range`` and ``_row``, and per group and range ``shift`` and the group's ``size``.

    ``_row + shift`` is a row's place (from 0) in its group.  Ranges may cut a group anywhere,
    also between equal rows, so a group of any size is spread; what meets in one window is one
    row for each range that a group touches.
    """
    keys = [F.col(c).asc_nulls_first() for c in group + order]
    spread = rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*keys, "_at").sortWithinPartitions(*keys, "_at").drop("_at")
    row = F.monotonically_increasing_id()
    put = written(spread.select("*", F.shiftright(row, 33).alias("_range"), row.alias("_row")), name)
    parts = put.groupBy(*group, "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return put, parts.select(*group, "_range", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("shift"), F.sum("_n").over(whole).alias("size"))


def height(size: Column, fan: int) -> Column:
    """Levels above so many leaves."""
    step = lambda s, _: F.when(s["n"] > 1, F.struct((s["h"] + 1).alias("h"), F.ceil(s["n"] / fan).alias("n"))).otherwise(s)
    return F.aggregate(F.sequence(F.lit(1), F.lit(63)), F.struct(F.lit(0).alias("h"), size.cast("long").alias("n")), step)["h"]


def levels(base: DataFrame, fan: int, name: str) -> list[DataFrame]:
    """Levels above ``base`` (tree, height, place, digest): tables (tree, height, level, place, digest, run), ``run`` the digests joined, in order."""
    out, now = [], base
    for level in range(1, (base.agg(F.max("height").alias("h")).first()["h"] or 0) + 1):
        runs = now.where(F.col("height") >= level).groupBy("tree", "height", F.floor(F.col("place") / fan).alias("place"))
        runs = runs.agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("x"))  # at most ``fan`` of them
        run = F.array_join(F.col("x.digest"), "")
        out.append(written(runs.select("tree", "height", F.lit(level).alias("level"), "place", digest(run).alias("digest"), run.alias("run")), name))
        now = out[-1]
    return out


def siblings(run: Column, place: Column, fan: int) -> Column:
    """What stands before and behind a node in the run that it belongs to."""
    at = (place % fan).cast("int") * DIGEST
    return F.struct(F.substring(run, F.lit(1), at).alias("before"), F.substring(run, at + DIGEST + 1, F.length(run)).alias("behind"))


def jump(nodes: DataFrame, name: str) -> DataFrame:
    """(tree, level, place, run, subroot, segments): each node's siblings on the way to the root, run by run.

    ``nodes`` name a parent in up_tree, up_level, up_place (null at the root) and have in
    ``segments`` the siblings that stand beside the node itself.  A round doubles the distance
    that segments cover; the rounds end when every pointer has passed the root.
    """
    key, up = ["tree", "level", "place"], ["up_tree", "up_level", "up_place"]
    now = written(nodes, name)
    while not now.where("up_tree is not null").isEmpty():
        ahead = now.select(*[F.col(k).alias(u) for k, u in zip(key, up)], *[F.col(u).alias(f"_{u}") for u in up], F.col("segments").alias("_more"))
        open_ = now.where("up_tree is not null").join(ahead, up)
        open_ = open_.select(*key, *[F.col(f"_{u}").alias(u) for u in up], "run", "subroot", F.concat("segments", "_more").alias("segments"))
        now = written(open_.unionByName(now.where("up_tree is null")), name)
    return now.drop(*up)


def fold(leaf: Column, segments: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(segments, leaf, lambda got, s: digest(s["before"], got, s["behind"]))


def _named(tree: Column, level: Column, place: Column, height_: Column) -> Column:
    """A node's name; the one that holds a whole source is a leaf of the tree over sources."""
    own = F.struct(tree.cast("long").alias("tree"), level.cast("int").alias("level"), place.cast("long").alias("place"))
    source = F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), tree.cast("long").alias("place"))
    return F.when((tree != TOP) & (level == height_), source).otherwise(own)


def manifest(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of doc_id, source, lang, n_chars and text, each with its length, or a
    dash for null.  Rows of a source stand by doc_id (null first, equal ids by leaf, so equal
    rows are interchangeable), sources by UTF-8 bytes, null first as a source of its own.
    A row whose crc32(doc_id) is divisible by 5 is checked with A-Z lower-cased in its text,
    which a text without them or a null one survives; a null doc_id is never tampered with.
    Texts are hashed whole where they are read; no other column is read.  An empty table gives
    no rows.
    """
    rows, parts = ranked(written(leaves(docs), "merkle-leaves"), ["source"], ["doc_id", "leaf"], "merkle-ranks")
    parts = written(parts, "merkle-parts")
    sources, spots = ranked(parts.select("source", "size").distinct(), [], ["source"], "merkle-sources")
    trees = sources.join(spots, "_range").select(F.col("source").alias("_source"), (F.col("_row") + F.col("shift")).alias("tree"))
    places = parts.join(trees, F.col("source").eqNullSafe(F.col("_source"))).select("_source", F.col("_range").alias("_r"), "tree", "shift", height(F.col("size"), fan).alias("height"))
    rows = rows.join(places, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r")))
    rows = written(rows.select("doc_id", "leaf", "tampered", "tree", "height", (F.col("_row") + F.col("shift")).alias("place")), "merkle-rows")

    lower = levels(rows.select("tree", "height", "place", F.col("leaf").alias("digest")), fan, "merkle-level")
    subroots = rows.where("height = 0").select("tree", F.col("leaf").alias("subroot"))
    for level in lower:
        subroots = subroots.unionByName(level.where("level = height").select("tree", F.col("digest").alias("subroot")))
    subroots = written(subroots, "merkle-subroots")
    n_sources = subroots.count()
    base = subroots.select(F.lit(TOP).cast("long").alias("tree"), height(F.lit(n_sources), fan).alias("height"), F.col("tree").alias("place"), F.col("subroot").alias("digest"))
    upper = levels(base, fan, "merkle-top")
    top = upper[-1] if upper else base
    root = (top.first() or {"digest": None})["digest"]

    found = _proved(lower, upper, subroots, fan)

    up = F.when(F.col("height") > 0, _named(F.col("tree"), F.lit(1), F.floor(F.col("place") / fan), F.col("height")))
    if upper:  # a lone row is a leaf of the tree over sources
        up = F.coalesce(up, F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(1).alias("level"), F.floor(F.col("tree") / fan).cast("long").alias("place")))
    low = rows.select("doc_id", "leaf", "tampered", F.when(F.col("height") > 0, F.col("place")).otherwise(F.col("tree")).alias("_at"), (F.col("height") == 0).alias("_lone"), up.alias("_up"))
    low = low.select("*", "_up.tree", "_up.level", "_up.place")
    if found is None:  # no row, or one
        path, low = F.array().cast(SEGMENTS), low.withColumn("subroot", F.col("leaf"))
    else:
        low = low.join(found, ["tree", "level", "place"], "left")
        path = F.concat(F.array(siblings(F.col("run"), F.col("_at"), fan)), "segments")
    low = low.select("doc_id", "leaf", "tampered", F.when(F.col("_lone"), F.col("leaf")).otherwise(F.col("subroot")).alias("subroot"), path.alias("path"))
    # left to right on every level, level by level
    proof = digest(F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["behind"])), ""))
    low = low.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), proof.alias("proof_sha256"), fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return low.withColumn("verified", F.col("folded_root") == F.col("root"))


def _proved(lower: list[DataFrame], upper: list[DataFrame], subroots: DataFrame, fan: int) -> DataFrame | None:
    """The inner nodes by name, with their run, their source's subroot (null above the sources) and their segments to the root."""
    nodes = [t.join(subroots, "tree") for t in lower] + [t.withColumn("subroot", F.lit(None).cast("string")) for t in upper]
    if not nodes:
        return None
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    every = every.select(_named(F.col("tree"), F.col("level"), F.col("place"), F.col("height")).alias("x"), "height", "run", "subroot").select("x.*", "height", "run", "subroot")
    above = _named(F.col("tree"), F.col("level") + 1, F.floor(F.col("place") / fan), F.col("height"))
    up = F.when((F.col("tree") != TOP) | (F.col("level") < len(upper)), above)
    every = written(every.select("tree", "level", "place", "run", "subroot", up.alias("_up")).select("*", *[F.col(f"_up.{c}").alias(f"up_{c}") for c in ("tree", "level", "place")]).drop("_up"), "merkle-nodes")
    parent = every.select(*[F.col(c).alias(f"up_{c}") for c in ("tree", "level", "place")], F.col("run").alias("_run"))
    linked = every.join(parent, ["up_tree", "up_level", "up_place"], "left")
    beside = F.when(F.col("_run").isNull(), F.array().cast(SEGMENTS)).otherwise(F.array(siblings(F.col("_run"), F.col("place"), fan)))
    return jump(linked.select("tree", "level", "place", "up_tree", "up_level", "up_place", "run", "subroot", beside.alias("segments")), "merkle-jump")
