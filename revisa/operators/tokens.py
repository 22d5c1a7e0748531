"""Token reuse in list cells: new rows must not claim tokens that other rows hold.

JN-11: a new row reusing a token of an existing live row is reported (first holder named).
WIN-02: among the remaining new rows, in row order, a row is accepted iff none of its
tokens belongs to an *accepted* earlier new row (rejected rows register nothing).  That is
the lexicographically first maximal independent set of the token-sharing graph, which no
single window computes.  Rows that share tokens, directly or over others, form components
(:mod:`revisa.operators.components`).  A component of at most ``WALKED_PAIRS`` (row, token)
pairs is walked through once in row order by one task, many components side by side; a larger
one is decided by rounds over its pairs.  Both ways are exact.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from revisa.functions.lists import tokens as cell_tokens
from revisa.operators import components as cp
from revisa.operators import revision as rv
from revisa.operators import skew
from revisa.sources.tables import written_once
from revisa.spec import RevisionSpec

#: Pairs of one component that a task walks through; it holds that many tokens at most.
WALKED_PAIRS = 200_000


def _refs(pairs_with_holder: DataFrame, holder_col: str) -> DataFrame:
    """Per row: sorted ``TOKEN (row N)`` references (bounded by the tokens of one cell)."""
    ref = F.struct(F.col("token"), F.concat(F.col("token"), F.lit(" (row "), F.col(holder_col).cast("string"), F.lit(")")).alias("txt"))
    return pairs_with_holder.groupBy("ord").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(ref)), lambda r: r["txt"]), ", ").alias("reused"),
        F.count(F.lit(1)).alias("n_reused"),
    )


def row_tokens(prepared: DataFrame, spec: RevisionSpec) -> DataFrame:
    """(ord, token) for every distinct token of a row's list cell."""
    return prepared.select("ord", F.explode(F.array_distinct(cell_tokens(spec.list_column))).alias("token"))


def existing_holders(prepared: DataFrame, spec: RevisionSpec) -> DataFrame:
    """First live keyed row holding each token (partial aggregate: a hot token is one row per task)."""
    existing = prepared.where(F.col(rv.KEY).isNotNull() & ~F.col(rv.REMOVED))
    return row_tokens(existing, spec).groupBy("token").agg(F.min("ord").alias("holder"))


def reuse_existing(prepared: DataFrame, spec: RevisionSpec) -> DataFrame:
    """JN-11: new rows reusing tokens of existing rows → (ord, reused, n_reused)."""
    new = row_tokens(rv.new_rows(prepared), spec)
    hot = skew.hot_keys(skew.row_counts(new, "token"), "token", "_n")
    return _refs(skew.join_unique(new, existing_holders(prepared, spec), "token", hot), "holder")


def shared_pairs(pairs: DataFrame) -> DataFrame:
    """(ord, token, least): the pairs whose token several rows hold, with the smallest of these rows."""
    held = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("least")).where("n > 1")
    return skew.join_unique(pairs, held, "token", skew.hot_keys(held, "token", "n")).select("ord", "token", "least")


def walk(labelled: DataFrame) -> DataFrame:
    """(ord, accepted, reused): the rows of (root, ord, token), each root's in order against the tokens accepted before."""

    def run(batches):
        out: list[tuple] = []
        place, row, tokens = None, None, []
        holder: dict[str, int] = {}

        def settle():
            taken = sorted(t for t in tokens if t in holder)
            if not taken:
                holder.update((t, row) for t in tokens)
            out.append((row, not taken, ", ".join(f"{t} (row {holder[t]})" for t in taken) if taken else None))

        for batch in batches:
            for root, ordn, token in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (root, ordn) != (place, row):
                    if row is not None:
                        settle()
                    if root != place:
                        holder.clear()
                    place, row, tokens = root, ordn, []
                tokens.append(token)
            if out:
                yield told(out)
                out = []
        if row is not None:
            settle()
            yield told(out)

    def told(rows):
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.bool_()), pa.array(columns[2], pa.string())], names=["ord", "accepted", "reused"])

    ordered = labelled.select("root", "ord", "token").repartition("root").sortWithinPartitions("root", "ord")
    return ordered.mapInArrow(run, "ord long, accepted boolean, reused string")


def rounds(pairs: DataFrame) -> DataFrame:
    """(ord, accepted) by rounds over (ord, token): for components too large to be walked.

    Each round, over the pairs of undecided rows only: a row that is the smallest holder of
    each of its tokens is accepted, and every other row with a token of an accepted row is
    rejected.  The smallest undecided row is always decided, so the loop ends.  A round's
    remaining pairs are a written table; the decided rows are counted in the job that
    writes them.
    """
    decided = None
    while True:
        least = pairs.groupBy("token").agg(F.min("ord").alias("least"), F.count(F.lit(1)).alias("n"))
        hot = skew.hot_keys(least, "token", "n")
        per_row = skew.join_unique(pairs, least, "token", hot).groupBy("ord").agg(F.min((F.col("ord") == F.col("least")).cast("int")).alias("first"))
        accepted = written_once(per_row.where("first = 1").select("ord"), "claims-accepted")
        taken = pairs.join(accepted, "ord", "left_semi").select("token").distinct()
        lost = skew.join_unique(pairs, taken.withColumn("taken", F.lit(True)), "token", hot).join(accepted, "ord", "left_anti").select("ord").distinct()
        lost = written_once(lost, "claims-rejected")
        now = accepted.withColumn("accepted", F.lit(True)).unionByName(lost.withColumn("accepted", F.lit(False)))
        decided = now if decided is None else written_once(decided.unionByName(now), "claims-decided")
        seen = Observation()
        left = pairs.join(now, "ord", "left_anti").observe(seen, F.count(F.lit(1)).alias("n"))
        pairs = written_once(left, "claims-pairs")
        if not seen.get["n"]:
            return decided


def greedy_claims(candidates: DataFrame, pairs: DataFrame, walked_pairs: int = WALKED_PAIRS) -> DataFrame:
    """WIN-02 core: decide every candidate row (``ord``) given its (ord, token) pairs.

    Returns (ord, accepted, reused): of a rejected row, the tokens it shares with accepted
    earlier rows and these rows.  A row that shares no token is accepted.
    """
    shared = written_once(shared_pairs(pairs.select(F.col("ord").cast("long").alias("ord"), "token").distinct()), "claims-shared")
    found = cp.components(shared.select("ord", "least"))
    sizes = shared.join(found, F.col("ord") == F.col("node"), "left")
    labelled = written_once(sizes.select(F.coalesce("root", "ord").alias("root"), "ord", "token"), "claims-labelled")
    large = labelled.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > walked_pairs).select("root")
    if large.isEmpty():
        decided = walk(labelled)
    else:
        large = written_once(large, "claims-large")
        decided = walk(labelled.join(large, "root", "left_anti"))
        rest = written_once(labelled.join(large, "root", "left_semi").select("ord", "token"), "claims-rest")
        won = rounds(rest)
        holders = rest.join(won.where("accepted"), "ord", "left_semi").select("token", F.col("ord").alias("holder"))
        beaten = rest.join(won.where("not accepted"), "ord", "left_semi")
        hot = skew.hot_keys(skew.row_counts(beaten, "token"), "token", "_n")
        refs = _refs(skew.join_unique(beaten, holders, "token", hot).where("holder < ord"), "holder").select("ord", "reused")
        decided = decided.unionByName(won.join(refs, "ord", "left"))
    alone = candidates.select(F.col("ord").cast("long").alias("ord")).distinct().join(decided, "ord", "left")
    return alone.select("ord", F.coalesce("accepted", F.lit(True)).alias("accepted"), "reused")


def reuse_new(prepared: DataFrame, spec: RevisionSpec, walked_pairs: int = WALKED_PAIRS) -> DataFrame:
    """WIN-02 report: every candidate new row with ``status`` and, if rejected, the
    accepted earlier rows whose tokens it reuses.

    Candidates (new rows not already failing JN-11) are written once with their tokens.
    """
    new = rv.new_rows(prepared).select("ord", F.array_distinct(cell_tokens(spec.list_column)).alias("toks"))
    conflicts = reuse_existing(prepared, spec).select("ord")
    rows = written_once(new.join(conflicts, "ord", "left_anti"), "claims-candidates")
    decided = greedy_claims(rows, rows.select("ord", F.explode("toks").alias("token")), walked_pairs)
    return decided.select("ord", F.when(F.col("accepted"), F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"), "reused")
