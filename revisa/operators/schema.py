"""Schema and name guards.  They look at column and table *names* (driver-side metadata,
never rows) and feed issues to the jobs that use them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def header_position_check(expected, actual) -> list[str]:
    """SCH-01: too short → the missing tail; else every position that differs."""
    expected, actual = list(expected), list(actual)
    if len(actual) < len(expected):
        return ["Worksheet is missing required columns: " + ", ".join(expected[len(actual):])]
    return [f"Column {i + 1} mismatch: expected '{e}' but found '{a}'" for i, (e, a) in enumerate(zip(expected, actual)) if e != a]


def schema_diff(expected, actual, exempt=(), formula_columns=()) -> dict[str, list[str]]:
    """SCH-02: names missing from ``actual`` and unexpected in ``actual``."""
    skip = set(exempt) | set(formula_columns)
    e = [c for c in expected if c not in skip]
    a = [c for c in actual if c not in skip]
    return {"missing": [c for c in e if c not in a], "unexpected": [c for c in a if c not in e]}


def column_segments(columns, marker: str, change_marker: str) -> tuple[list, list, list, list[str]]:
    """SCH-03: data columns before ``marker``, delta columns from ``marker`` up to
    ``change_marker``, change columns after it; change count must be data count − 1."""
    cols = list(columns)
    if marker not in cols or change_marker not in cols:
        return cols, [], [], [f"Missing marker column '{marker if marker not in cols else change_marker}'"]
    i, j = cols.index(marker), cols.index(change_marker)
    data, delta, change = cols[:i], cols[i : j + 1], cols[j + 1 :]
    issues = [] if len(change) == len(data) - 1 else [f"Expected {len(data) - 1} change columns, found {len(change)}"]
    return data, delta, change, issues


def required_tables(required, present) -> list[str]:
    """SCH-04: required names (plain or regular expressions, full match) not present."""
    out = []
    for r in required:
        if not any(re.fullmatch(r, p) for p in present):
            out.append(r)
    return out


def required_columns_ci(required, columns) -> list[str]:
    """SCH-05: required columns missing, compared case-insensitively."""
    have = {str(c).strip().lower() for c in columns}
    return [c for c in required if c.lower() not in have]


def discover_release_table(names, pattern: str) -> tuple[str | None, list[str]]:
    """SRC-07: the table whose name fully matches ``pattern``; none or several are errors
    (with several, the first in order is used)."""
    matches = [n for n in names if re.fullmatch(pattern, n)]
    if not matches:
        return None, [f"No table named like '{pattern}'"]
    issues = [] if len(matches) == 1 else ["Multiple release tables found: " + ", ".join(matches)]
    return matches[0], issues


def first_existing(candidates, available, case_insensitive: bool = False) -> str | None:
    """SRC-08: the first candidate that exists (columns case-insensitively if asked)."""
    if case_insensitive:
        lookup = {}
        for a in available:
            lookup.setdefault(str(a).strip().lower(), a)
        for c in candidates:
            if c.lower() in lookup:
                return lookup[c.lower()]
        return None
    for c in candidates:
        if c in available:
            return c
    return None


def issues_frame(spark: SparkSession, check: str, messages, severity: str = "ERROR") -> DataFrame:
    """Guard messages as rows of the issue schema, to union into an issue log."""
    rows = [(check, "", None, m, severity) for m in messages]
    return spark.createDataFrame(rows, "check string, worksheet string, row bigint, message string, severity string")
