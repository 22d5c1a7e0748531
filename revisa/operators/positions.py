"""Positions in a total order, and running sums, without one task for all rows.

Rows are range-partitioned and sorted, written once with their range and their number in
it, and each range's total (one row per partition) gives the offset of the ranges behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revisa.sources.shared import written_once


def positioned(rows: DataFrame, order: list[Column], name: str = "position", base: int = 1) -> DataFrame:
    """The rows in ``order`` with their position, from ``base``; equal rows stand in any order."""
    put = _laid(rows, order)
    starts = _starts(put, F.count(F.lit(1)))
    found = put.join(F.broadcast(starts), "_range")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_row") - F.col("_first") + base).cast("bigint").alias(name))


def running_sum(rows: DataFrame, order: list[Column], amount: str, name: str) -> DataFrame:
    """The rows with the sum of ``amount`` over all rows before them in ``order``."""
    put = _laid(rows, order)
    starts = _starts(put, F.sum(amount))
    inside = Window.partitionBy("_range").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    found = put.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(F.broadcast(starts), "_range")
    return found.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_before") + F.col("_inside")).cast("bigint").alias(name))


def _laid(rows: DataFrame, order: list[Column]) -> DataFrame:
    row = F.monotonically_increasing_id()
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return written_once(laid.select("*", F.shiftright(row, 33).alias("_range"), row.alias("_row")), "positions")


def _starts(put: DataFrame, total: Column) -> DataFrame:
    """(_range, _first, _before): a row for each range, of which there are no more than shuffle partitions."""
    ranges = put.groupBy("_range").agg(F.min("_row").alias("_first"), total.cast("bigint").alias("_n")).orderBy("_range").collect()
    out, before = [], 0
    for r in ranges:
        out.append((r["_range"], r["_first"], before))
        before += r["_n"] or 0
    return put.sparkSession.createDataFrame(out, "_range bigint, _first bigint, _before bigint")
