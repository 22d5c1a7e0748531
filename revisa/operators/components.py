"""Connected components of links between whole numbers, by contraction.

A round contracts the links inside every partition with a union-find, then hooks what
different partitions found for the same node and shortens paths by one jump.  Links that fit
in one partition are done after one round; otherwise every round merges neighbouring trees and
halves their depth.  The state of a round is a written table, so a lost executor costs at
most one round.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from revisa.operators import skew
from revisa.sources.tables import written_once

#: Nodes a task holds before it hands on what it has contracted.
HELD_NODES = 1_000_000


class Forest(dict):
    """Union-find in which the smallest node of a tree is its root."""

    def root(self, node: int) -> int:
        top = node
        while (up := self.get(top, top)) != top:
            top = up
        while (up := self.get(node, node)) != top:
            self[node], node = top, up
        return top

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.setdefault(a, a)
        self.setdefault(b, b)
        if a != b:
            self[max(a, b)] = min(a, b)


def contracted(links: DataFrame, held_nodes: int = HELD_NODES) -> DataFrame:
    """(node, root): in each partition, the nodes of its links and the smallest node they reach inside it; links of one node meet."""
    return contracted_where_they_are(links.repartition("node"), held_nodes)


def contracted_where_they_are(links: DataFrame, held_nodes: int = HELD_NODES) -> DataFrame:
    """(node, root) of whole numbers, as ``contracted``, in the partitions that ``links`` has; a node may get a row in several."""

    def run(batches):
        forest = Forest()
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                forest.link(a, b)
            if len(forest) > held_nodes:
                yield told(forest)
                forest = Forest()
        if forest:
            yield told(forest)

    def told(forest):
        found = [(n, r) for n in forest if (r := forest.root(n)) != n]
        return pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], names=["node", "root"])

    return links.mapInArrow(run, "node long, root long")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that is not the smallest of its component; ``links`` has two columns of whole numbers."""
    a, b = links.columns
    now = links.select(F.greatest(a, b).cast("long").alias("node"), F.least(a, b).cast("long").alias("root")).where("node <> root")
    while True:
        held = Observation()
        local = written_once(contracted(now).observe(held, F.count(F.lit(1)).alias("n")), "components-local")
        up = local.groupBy("node").agg(F.min("root").alias("root"))
        # partitions that found different roots for a node: these belong together
        hooks = local.join(up.withColumnRenamed("root", "least"), "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"), F.lit(1).alias("open"))
        ahead = up.select(F.col("node").alias("root"), F.col("root").alias("next"))
        hot = skew.hot_keys(skew.row_counts(up, "root"), "root", "_n") if held.get["n"] > skew.HOT_ROWS else []
        jumped = skew.join_unique(up, ahead, "root", hot, "left")
        jumped = jumped.select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().cast("int").alias("open"))
        seen = Observation()
        step = written_once(jumped.unionByName(hooks).observe(seen, F.coalesce(F.sum("open"), F.lit(0)).alias("open")), "components-step")
        now = step.select("node", "root")
        if not seen.get["open"]:
            return now
