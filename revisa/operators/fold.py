"""Ordered fold: entries applied one after another to the stored rows of their key.

Every entry has its own guard, which sees what earlier entries have left, so the outcome
depends on the order.  Keys with one entry need no order and are joined.  For the others,
stored rows and entries are sorted together by (key, kind, entry): a task holds a key's
stored rows, then reads its entries as a stream and changes the rows that match, found by
an index on (target, value).  Memory is bounded by ``HELD_ROWS`` stored rows; the rows of a
key with more are dealt over several tasks, each of which reads that key's entries.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

#: Stored rows of one key that a task holds.
HELD_ROWS = 10_000


class Held:
    """The stored rows of one key, found by the value of a target."""

    def __init__(self, guard: str):
        self.all = guard == "all"
        self.rows: list[dict] = []
        self.applied: list[bool] = []
        self.entries = 0
        self.by_value: dict[tuple, set[int]] = {}

    def hold(self, row: dict, targets) -> None:
        for t in targets:
            self.by_value.setdefault((t, row[t]), set()).add(len(self.rows))
        self.rows.append(row)
        self.applied.append(False)

    def apply(self, changes: list[tuple]) -> None:
        """One entry: ``changes`` are (target, old value, new value)."""
        self.entries += 1
        found = [self.by_value.get((t, old), set()) for t, old, _ in changes]
        hit = set.intersection(*found) if self.all else set().union(*found)
        for i in sorted(hit):
            self.applied[i] = True
            for t, _, new in changes:
                old = self.rows[i][t]
                if old != new:
                    self.by_value[t, old].discard(i)
                    self.by_value.setdefault((t, new), set()).add(i)
                    self.rows[i][t] = new

    def out(self):
        for row, applied in zip(self.rows, self.applied):
            yield row | {"update_status": "applied" if applied else "guard_miss" if self.entries else None}


def fold_entries(stored: DataFrame, entries: DataFrame, key: str, targets: dict[str, bool], guard: str = "any", held_rows: int = HELD_ROWS) -> DataFrame:
    """``stored`` with the entries of its ``key`` applied in order, and ``update_status``.

    ``entries``: key_num, ord, o_ord and ``ch``, an array of structs with target, old_value and
    new_value as text; ``targets`` says for each target whether it is a whole number.
    """
    per_key = stored.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.ceil(F.count(F.lit(1)) / F.lit(held_rows)).cast("int").alias("_tasks"))
    named = stored.select(F.col(key).alias("_key"), F.struct(*stored.columns).alias("row"), F.monotonically_increasing_id().alias("_at"))
    rows = named.join(per_key, "_key").select("_key", F.pmod("_at", "_tasks").cast("int").alias("_task"), F.lit(0).alias("_kind"), F.lit(0).cast("bigint").alias("_ord"), F.col("_at").alias("_second"), "row")
    change = F.transform("ch", lambda c: F.struct(c["target"].alias("target"), c["old_value"].alias("old"), c["new_value"].alias("new")))
    asked = entries.select(F.col("key_num").alias("_key"), F.col("o_ord").cast("bigint").alias("_ord"), F.col("ord").cast("bigint").alias("_second"), change.alias("ch"))
    asked = asked.join(per_key, "_key").select("_key", F.explode(F.sequence(F.lit(0), F.col("_tasks") - 1)).alias("_task"), F.lit(1).alias("_kind"), "_ord", "_second", "ch")
    both = rows.unionByName(asked, allowMissingColumns=True)
    order = ["_key", "_task", "_kind", "_ord", "_second"]
    both = both.repartition("_key", "_task").sortWithinPartitions(*order).select("_key", "_task", "_kind", "row", "ch")
    schema = Ty.StructType([*stored.schema.fields, Ty.StructField("update_status", Ty.StringType())])
    names = list(targets)

    def typed(value, whole):
        return int(value) if whole and value is not None else value

    def run(batches):
        place, held = None, None
        done: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if (r["_key"], r["_task"]) != place:
                    if held is not None:
                        done.extend(held.out())
                        if len(done) >= 10_000:
                            yield emitted(done)
                            done = []
                    place, held = (r["_key"], r["_task"]), Held(guard)
                if r["_kind"] == 0:
                    held.hold(r["row"], names)
                else:
                    held.apply([(c["target"], typed(c["old"], targets[c["target"]]), typed(c["new"], targets[c["target"]])) for c in r["ch"]])
        if held is not None:
            done.extend(held.out())
        if done:
            yield emitted(done)

    def emitted(rows):
        return pa.RecordBatch.from_pylist(rows, schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return both.mapInArrow(run, schema)
