"""Positional diff of two table sets held as long cell grids ``(sheet, row, col, value)``.

Cells pair by position (full outer join on sheet pair, row, column), so a cell present
on one side only is a diff against "absent".  Rule tables (ignore rules, explicit sheet
pairs) are driver-side configuration and become column predicates, not joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T

EMPTY = "<empty>"


def sheet_names(grid: DataFrame) -> DataFrame:
    return grid.select("sheet").distinct()


def table_set_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """SET-01: sheets only in the old set and only in the new set."""
    o, n = sheet_names(old), sheet_names(new)
    return o.join(n, "sheet", "left_anti").withColumn("side", F.lit("old_only")).unionByName(
        n.join(o, "sheet", "left_anti").withColumn("side", F.lit("new_only"))
    )


def table_pairs(old: DataFrame, new: DataFrame, spark=None, pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """SET-02: sheet pairs to compare: the common names, or an explicit ``old:new`` list
    (pairs naming a sheet that does not exist are skipped)."""
    if pairs:
        p = spark.createDataFrame(pairs, "old_sheet string, new_sheet string")
        return p.join(sheet_names(old).withColumnRenamed("sheet", "old_sheet"), "old_sheet", "left_semi").join(
            sheet_names(new).withColumnRenamed("sheet", "new_sheet"), "new_sheet", "left_semi"
        ).select("old_sheet", "new_sheet")
    common = sheet_names(old).join(sheet_names(new), "sheet", "inner")
    return common.select(F.col("sheet").alias("old_sheet"), F.col("sheet").alias("new_sheet"))


def parse_ignore_rules(items) -> list[tuple[str, str]]:
    """FLT-10: ``table_regex:value_regex`` (split on the first colon, both halves required)."""
    out = []
    for item in items:
        if ":" not in item:
            raise ValueError(f"Invalid ignore rule '{item}' (expected TABLE_REGEX:VALUE_REGEX)")
        t, v = item.split(":", 1)
        if not t or not v:
            raise ValueError(f"Invalid ignore rule '{item}' (expected TABLE_REGEX:VALUE_REGEX)")
        out.append((t, v))
    return out


def _label(old_sheet, new_sheet):
    return F.when(old_sheet == new_sheet, old_sheet).otherwise(F.concat(old_sheet, F.lit(" -> "), new_sheet))


def _paired(grid: DataFrame, pairs, side: str) -> DataFrame:
    """The cells under every pair that names their sheet as its ``side``.

    A list of pairs is configuration and becomes a literal looked up in the row, so no
    large sheet meets in one task; pairs found in the data (a DataFrame) are joined.
    """
    if isinstance(pairs, DataFrame):
        return grid.join(pairs, grid.sheet == pairs[side])
    known = F.array(*[F.struct(F.lit(o).alias("old_sheet"), F.lit(n).alias("new_sheet")) for o, n in pairs])
    known = known.cast("array<struct<old_sheet:string,new_sheet:string>>")
    return grid.select("*", F.inline(F.filter(known, lambda p: p[side] == F.col("sheet"))))


def cell_diff(old: DataFrame, new: DataFrame, pairs, ignore_whitespace_only: bool = False) -> DataFrame:
    """DIF-01 (+ DIF-02): cells whose displayed values differ, absent = null.

    ``pairs``: a list of (old sheet, new sheet), or :func:`table_pairs`.
    Grids carry each cell's display text (SCL-23; :func:`to_grid` casts to string), so a
    type change with the same display is no diff (Q15) and equal values never are.
    """
    o = _paired(old, pairs, "old_sheet").select("old_sheet", "new_sheet", "row", "col", F.col("value").alias("old_value"))
    n = _paired(new, pairs, "new_sheet").select("old_sheet", "new_sheet", "row", "col", F.col("value").alias("new_value"))
    j = o.join(n, ["old_sheet", "new_sheet", "row", "col"], "full")
    d = j.where(~F.col("old_value").eqNullSafe(F.col("new_value")))
    if ignore_whitespace_only:
        d = d.where(~T.whitespace_only_change("old_value", "new_value"))
    return d.select(_label(F.col("old_sheet"), F.col("new_sheet")).alias("sheet"), "old_sheet", "row", "col", "old_value", "new_value")


def ignored_rows(new: DataFrame, pairs, rules: list[tuple[str, str]]) -> DataFrame:
    """JN-14: (sheet label, row) of new-side rows where any cell matches a rule whose table
    regex matches the old sheet name (regex search, Q16)."""
    if not rules:
        return new.sparkSession.createDataFrame([], "sheet string, row bigint")
    n = _paired(new, pairs, "new_sheet").where(F.col("value").isNotNull())
    hit = reduce(lambda a, b: a | b, [F.col("old_sheet").rlike(t) & F.col("value").rlike(v) for t, v in rules])
    return n.where(hit).select(_label(F.col("old_sheet"), F.col("new_sheet")).alias("sheet"), F.col("row").cast("bigint").alias("row")).distinct()


def drop_ignored(diffs: DataFrame, ignored: DataFrame) -> DataFrame:
    """DIF-03: value diffs on ignored rows are dropped."""
    return diffs.join(ignored, ["sheet", "row"], "left_anti")


def by_cell(diffs: DataFrame) -> DataFrame:
    """DIF-04: ``A1: old -> new`` per cell."""
    txt = F.concat(T.a1_address("row", "col"), F.lit(": "), F.coalesce("old_value", F.lit(EMPTY)), F.lit(" -> "), F.coalesce("new_value", F.lit(EMPTY)))
    return diffs.select("sheet", "row", "col", txt.alias("text"))


def by_row(diffs: DataFrame) -> DataFrame:
    """DIF-05 / AGG-11: ``Row n: A: old -> new, C: ...`` with cells in column order.

    The collected list is the changed cells of one row: bounded by the row's width.
    """
    cell = F.struct(
        F.col("col"),
        F.concat(T.a1_column("col"), F.lit(": "), F.coalesce("old_value", F.lit(EMPTY)), F.lit(" -> "), F.coalesce("new_value", F.lit(EMPTY))).alias("t"),
    )
    g = diffs.groupBy("sheet", "row").agg(F.array_sort(F.collect_list(cell)).alias("cells"))
    return g.select("sheet", "row", F.concat(F.lit("Row "), F.col("row").cast("string"), F.lit(": "), F.array_join(F.transform("cells", lambda c: c["t"]), ", ")).alias("text"))


def row_counts(diffs: DataFrame) -> DataFrame:
    """DIF-06 / AGG-10: rows with differences, per table."""
    return diffs.groupBy("sheet").agg(F.countDistinct("row").alias("rows_with_differences"))


def verdict(diffs: DataFrame, set_diff: DataFrame) -> DataFrame:
    """DIF-07: one row: any difference over all tables, and the message."""
    n = diffs.select(F.lit(1).alias("d")).unionByName(set_diff.select(F.lit(1).alias("d"))).agg(F.count(F.lit(1)).alias("n_differences"))
    return n.select(
        (F.col("n_differences") > 0).alias("has_differences"),
        F.when(F.col("n_differences") > 0, F.lit("Differences found.")).otherwise(F.lit("No differences found.")).alias("message"),
        "n_differences",
    )


def to_grid(df: DataFrame, sheet: str, ord_col: str = "ord", header: bool = True) -> DataFrame:
    """A table as a long cell grid ``(sheet, row, col, value)`` for positional diffs.

    ``row`` is the row's ordinal (+1 when the header row is part of the grid, as in a
    sheet whose first row holds the column names); ``col`` is the 1-based column
    position; values are their display text (cast to string), absent cells are skipped.
    One ``explode`` per row: no shuffle.
    """
    cols = [c for c in df.columns if c != ord_col]
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("col"), F.col(c).cast("string").alias("value")) for i, c in enumerate(cols, start=1)]))
    body = df.select((F.col(ord_col).cast("bigint") + (1 if header else 0)).alias("row"), cells.alias("c")).select(
        F.lit(sheet).alias("sheet"), "row", "c.col", "c.value"
    ).where(F.col("value").isNotNull())
    if not header:
        return body
    spark = df.sparkSession
    head = spark.createDataFrame([(sheet, 1, i, c) for i, c in enumerate(cols, start=1)], "sheet string, row bigint, col int, value string")
    return head.unionByName(body)
