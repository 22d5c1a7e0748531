"""Row masking by LIKE rules ``(table_name, col, pattern)``.

Rules are configuration (a few lines of a rule file), read to the driver once and folded
into one filter predicate per table; Catalyst pushes prefix patterns (``'ECO%'``) into
the Parquet scan as ``StartsWith``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T

RULE_HEADER = ["table_name", "col", "pattern"]


def like_pattern(pattern: str) -> str:
    """FLT-01: the rule language has no escape character; Spark's LIKE escapes with ``\\``."""
    return pattern.replace("\\", "\\\\")


def like(c, pattern: str) -> Column:
    return T._c(c).like(like_pattern(pattern))


def read_rules(rules: DataFrame, strict: bool = True) -> list[tuple[str, str, str]]:
    """SRC-06: header must be exactly the three names; rows with a blank field are an error.

    Returns the rules as a driver-side list (rule files are kB-sized configuration).  Not
    ``strict``, rows with a blank field are left out; :func:`rule_issues` reports them.
    """
    if rules.columns != RULE_HEADER:
        raise ValueError(f"Mask rules must have header columns: {', '.join(RULE_HEADER)}")
    out = []
    for i, r in enumerate(rules.collect(), start=2):
        t, c, p = (str(x).strip() if x is not None else "" for x in r)
        if t and c and p:
            out.append((t, c, p))
        elif strict:
            raise ValueError(f"Mask rule row {i} must provide table_name, col and pattern")
    return out


def rule_issues(rules: DataFrame, schemas: dict[str, list[str]]) -> DataFrame:
    """SRC-06 as issues (check, message, severity): rules that cannot be applied, each an ERROR; a wrong header is one."""
    if rules.columns != RULE_HEADER:
        message = f"Mask rules must have header columns: {', '.join(RULE_HEADER)}"
        return rules.sparkSession.createDataFrame([("mask", message, "ERROR")], "check string, message string, severity string")
    bad = rule_status(rules, schemas).where("status <> 'ok'")
    shown = [F.coalesce(T.norm(c), F.lit("")) for c in RULE_HEADER]
    why = F.when(F.col("status") == "blank_field", F.lit("must provide table_name, col and pattern")).otherwise(F.lit("names a column that the table lacks"))
    rule = F.concat(F.lit("Mask rule "), shown[0], F.lit("."), shown[1], F.lit(" LIKE '"), shown[2], F.lit("' "), why)
    return bad.select(F.lit("mask").alias("check"), rule.alias("message"), F.lit("ERROR").alias("severity"))


def rule_status(rules: DataFrame, schemas: dict[str, list[str]]) -> DataFrame:
    """Per rule: ``ok``, ``blank_field`` or ``unknown_column`` (Q23: a rule on a column the
    table lacks is reported and skipped instead of masking every row)."""
    blank = F.coalesce(*[T.norm(c) for c in RULE_HEADER]).isNull() | T.norm("table_name").isNull() | T.norm("col").isNull() | T.norm("pattern").isNull()
    known = F.lit(False)
    for t, cols in schemas.items():
        known = known | ((F.col("table_name") == t) & F.col("col").isin(cols))
    status = F.when(blank, F.lit("blank_field")).when(~known, F.lit("unknown_column")).otherwise(F.lit("ok"))
    return rules.select(*RULE_HEADER, status.alias("status"))


def mask_predicate(rules, table: str, columns, null_as_empty: bool = True) -> Column | None:
    """FLT-02 / FLT-03: true for rows any rule of ``table`` matches.

    ``null_as_empty``: a null cell is matched as ``''`` (flat-file behaviour, rows kept
    unless a rule matches ''); without it a null makes the predicate unknown and the row
    is dropped by ``NOT (...)`` (database behaviour, Q2).
    """
    preds = []
    for t, c, p in rules:
        if t != table or c not in columns:
            continue
        cell = F.coalesce(F.col(c), F.lit("")) if null_as_empty else F.col(c)
        preds.append(like(cell, p))
    if not preds:
        return None
    return reduce(lambda a, b: a | b, preds)


def empty_matches(pattern: str) -> bool:
    """Does ``''`` match the LIKE pattern (only ``%`` wildcards)?"""
    return all(ch == "%" for ch in pattern)


def keep_predicate(rules, table: str, columns, null_as_empty: bool = True) -> Column | None:
    """The rows a mask keeps, written without ``coalesce`` so the scan can take it.

    Flat-file semantics (a null cell is ``''``): keep ``c IS NULL OR NOT c LIKE p``, or
    ``c IS NOT NULL AND NOT c LIKE p`` when ``''`` itself matches ``p``.  Database
    semantics: ``c IS NOT NULL AND NOT c LIKE p`` (a null makes ``NOT (...)`` unknown).
    Prefix patterns become ``StartsWith`` and reach Parquet as pushed filters.
    """
    keeps = []
    for t, c, p in rules:
        if t != table or c not in columns:
            continue
        col = F.col(c)
        if null_as_empty and not empty_matches(p):
            keeps.append(col.isNull() | ~like(col, p))
        else:
            keeps.append(col.isNotNull() & ~like(col, p))
    if not keeps:
        return None
    return reduce(lambda a, b: a & b, keeps)


def mask_table(df: DataFrame, table: str, rules, null_as_empty: bool = True) -> DataFrame:
    keep = keep_predicate(rules, table, df.columns, null_as_empty)
    return df if keep is None else df.where(keep)


def matched_counts(df: DataFrame, table: str, rules) -> DataFrame:
    """AGG-14: rows each rule of ``table`` matches (one pass, one aggregate)."""
    mine = [(t, c, p) for t, c, p in rules if t == table and c in df.columns]
    aggs = [F.sum(F.when(like(F.coalesce(F.col(c), F.lit("")), p), 1).otherwise(0)).alias(f"m{i}") for i, (_, c, p) in enumerate(mine)]
    if not aggs:
        return df.sparkSession.createDataFrame([], "table_name string, col string, pattern string, n_matched bigint")
    wide = df.agg(*aggs)
    stack = F.explode(
        F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("col"), F.lit(p).alias("pattern"), F.col(f"m{i}").cast("bigint").alias("n_matched")) for i, (t, c, p) in enumerate(mine)])
    )
    return wide.select(stack.alias("r")).select("r.*")
