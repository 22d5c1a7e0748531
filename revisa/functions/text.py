"""Scalar text functions: ``Column -> Column`` expressions that stay inside codegen.

Every function here is a composition of built-in Spark SQL functions (no Python in the
hot path).  Blank, whitespace-only and null are one value, "absent" (null).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# Whitespace as Python's ``str.strip()`` sees it (Spark's ``trim`` strips U+0020 only).
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
# The same set as characters, for ``btrim`` (a code-point loop, much cheaper than a regex).
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Space-like characters for whitespace-only diffs: all of WS plus these code points.
SPACE_LIKE = r"[\t-\r\x1c-\x20\x85\p{Z}\x{00A0}\x{2007}\x{202F}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]"
# Integer-like text accepted before a numeric cast (``try_cast`` alone accepts '1d', '0x1p3').
NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# Visible forms of whitespace characters, in this order.
VISIBLE_WHITESPACE = (
    (" ", "<sp>"),
    ("\t", "<tab>"),
    ("\n", "<nl>"),
    ("\r", "<cr>"),
    ("\u00a0", "<nbsp>"),
    ("\u2007", "<figsp>"),
    ("\u202f", "<nnbsp>"),
    ("\u200b", "<zwsp>"),
    ("\u200c", "<zwnj>"),
    ("\u200d", "<zwj>"),
    ("\u2060", "<wj>"),
    ("\ufeff", "<zwnbsp>"),
)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Strip Unicode whitespace on both ends; keeps '' (use :func:`norm` for absent)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def norm(c) -> Column:
    """SCL-01: trim Unicode whitespace; blank → null."""
    return F.nullif(strip_ws(c), F.lit(""))


def norm_column_key(c) -> Column:
    """SCL-02: normalised column name (trimmed, lower case)."""
    return F.lower(norm(c))


def norm_key(c) -> Column:
    """SCL-03: normalised row key (trimmed, upper case)."""
    return F.upper(norm(c))


def key_numeric(c, pattern: str = r"^[A-Z]*(\d+)$") -> Column:
    """SCL-04: number of a normalised key that matches ``pattern`` (one group), else null."""
    k = norm_key(c)
    return F.when(k.rlike(pattern), F.regexp_extract(k, pattern, 1).try_cast("bigint"))


HYPERLINK = r'(?i)^=HYPERLINK\(".*?","(.*)"\)$'


def hyperlink_label(c) -> Column:
    """SCL-05: label of a ``=HYPERLINK("url","label")`` cell, else the text (normalised)."""
    t = norm(c)
    return F.when(t.rlike(HYPERLINK), norm(F.regexp_extract(t, HYPERLINK, 1))).otherwise(t)


def hyperlink_build(c, base_url: str) -> Column:
    """SCL-06: link text for a key; blanks stay, already-linked cells stay."""
    t = strip_ws(F.coalesce(_c(c), F.lit("")))
    return (
        F.when(t == "", _c(c))
        .when(t.startswith("=HYPERLINK("), _c(c))
        .otherwise(F.concat(F.lit('=HYPERLINK("' + base_url), t, F.lit('","'), t, F.lit('")')))
    )


def canonical_value(c) -> Column:
    """SCL-07: letters and digits only, lower case."""
    return F.lower(F.regexp_replace(_c(c), r"[^\p{L}\p{N}]", ""))


def int_like(c) -> Column:
    """SCL-09: integer value of integer-like text (``'12'``, ``' 12.0 '``, ``'1e3'``), else null."""
    t = strip_ws(_c(c).cast("string"))
    d = t.try_cast("double")
    return F.when(t.rlike(NUMBER_TEXT) & (d % 1 == 0), d.try_cast("bigint"))


def type_code(c, codes=(("E", "EXEM"), ("A", "ADD"))) -> Column:
    """SCL-10: two-value type code from free text, else null."""
    u = F.upper(norm(c))
    expr = None
    for code, _ in codes:
        cond = u == code
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    for code, prefix in codes:
        expr = expr.when(u.startswith(prefix), F.lit(code))
    return expr


TYPE_CODES = (("E", "EXEM"), ("A", "ADD"))


def norm_value(c, kind: str, fallback: bool = True, codes=TYPE_CODES) -> Column:
    """SCL-11 / FLT-08 normaliser by value kind, as text.

    ``fallback`` keeps the normalised text when a type code or integer cannot be read
    (the reconcile behaviour).  Without it an unreadable value becomes null, so two
    different unreadable values compare equal (the reference's update behaviour, Q9).
    """
    if kind == "type":
        v = type_code(c, codes)
    elif kind == "int":
        v = int_like(c).cast("string")
    elif kind == "link":
        return hyperlink_label(c)
    elif kind == "date":
        return F.date_format(_c(c), "MMM-yy")
    else:
        return norm(c)
    return F.coalesce(v, norm(c)) if fallback else v


def values_equal(a, b, kind: str, fallback: bool = True, codes=TYPE_CODES) -> Column:
    """FLT-08: null-safe equality after the kind's normaliser, which equal texts need not pass."""
    same = _c(a).cast("string").eqNullSafe(_c(b).cast("string"))
    return same | norm_value(a, kind, fallback, codes).eqNullSafe(norm_value(b, kind, fallback, codes))


TAXNODE_PATTERN = r"^TX(\d+)$"


def _taxnode(c, pattern: str) -> Column:
    u = F.upper(norm(c))
    return F.when(u.rlike(pattern), F.regexp_extract(u, pattern, 1).try_cast("bigint").cast("string"))


def convert_checked(c, kind: str, column: str, taxnode_pattern: str = TAXNODE_PATTERN, codes=TYPE_CODES) -> Column:
    """SCL-12: ``struct(value string, error string)`` for a new value of a target column."""
    t = norm(c)
    if kind == "taxnode":
        value = _taxnode(c, taxnode_pattern)
        prefix = taxnode_pattern.lstrip("^").split("(")[0]
        err = F.when(t.isNotNull() & value.isNull(), F.lit(f"Column '{column}' must resemble {prefix}######## to derive taxnode_id."))
    elif kind == "int":
        value = int_like(c).cast("string")
        err = F.when(t.isNotNull() & value.isNull(), F.lit(f"Column '{column}' must contain an integer value."))
    elif kind == "type":
        value = type_code(c, codes)
        allowed = " or ".join(f"'{code}'" for code, _ in codes)
        err = F.when(t.isNotNull() & value.isNull(), F.lit(f"Column '{column}' must contain {allowed}."))
    else:
        value = t
        err = F.lit(None).cast("string")
    return F.struct(value.alias("value"), err.alias("error"))


def convert_lenient(c, kind: str, taxnode_pattern: str = TAXNODE_PATTERN, codes=TYPE_CODES) -> Column:
    """SCL-13: conversion of an old value without an error; an unreadable one is null."""
    if kind == "int":
        return int_like(c).cast("string")
    if kind == "type":
        return type_code(c, codes)
    if kind == "taxnode":
        return _taxnode(c, taxnode_pattern)
    return norm(c)


def sql_literal(c, kind: str = "text", escape_backslash: bool = False) -> Column:
    """SCL-26: SQL literal text of a value: NULL, a bare integer, or a quoted string."""
    v = _c(c)
    if kind in ("int", "taxnode"):
        return F.when(v.isNull(), F.lit("NULL")).otherwise(v.cast("string"))
    s = v.cast("string")
    if escape_backslash:
        s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    return F.when(v.isNull(), F.lit("NULL")).otherwise(F.concat(F.lit("'"), F.replace(s, F.lit("'"), F.lit("''")), F.lit("'")))


def sql_condition(target: str, c, kind: str = "text") -> Column:
    """``col IS NULL`` or ``col = literal``."""
    return F.when(_c(c).isNull(), F.lit(f"{target} IS NULL")).otherwise(F.concat(F.lit(f"{target} = "), sql_literal(c, kind)))


def flatten_newlines(c) -> Column:
    """SCL-27: newlines shown as `` | `` in one-line comments."""
    return F.regexp_replace(_c(c), r"\r\n|\r|\n", " | ")


def id_url(c, base_url: str, prefix: str = "") -> Column:
    """SCL-19: URL of a key; an existing prefix is not doubled."""
    u = F.upper(norm(c))
    return F.when(u.isNotNull(), F.concat(F.lit(base_url + prefix), F.regexp_replace(u, "^" + prefix, "")))


def a1_column(col) -> Column:
    """SCL-22: spreadsheet column letters of a 1-based column number (up to three letters)."""
    n = _c(col).cast("bigint")
    n1 = F.floor((n - 1) / 26)
    n2 = F.floor((n1 - 1) / 26)

    def letter(x):
        return F.substring(F.lit(LETTERS), (F.pmod(x - 1, F.lit(26)) + 1).cast("int"), 1)

    return F.concat(
        F.when(n2 > 0, letter(n2)).otherwise(F.lit("")),
        F.when(n1 > 0, letter(n1)).otherwise(F.lit("")),
        letter(n),
    )


def a1_address(row, col) -> Column:
    """SCL-22: A1 address of (row, column)."""
    return F.concat(a1_column(col), _c(row).cast("string"))


def visible_whitespace(c) -> Column:
    """SCL-24: whitespace characters made visible."""
    out = _c(c)
    for ch, shown in VISIBLE_WHITESPACE:
        out = F.replace(out, F.lit(ch), F.lit(shown))
    return out


def strip_space_like(c) -> Column:
    """SCL-25: text without any space-like character; null counts as ''."""
    return F.regexp_replace(F.coalesce(_c(c), F.lit("")), SPACE_LIKE, "")


def whitespace_only_change(old, new) -> Column:
    """FLT-09: texts differ, but not once space-like characters are removed."""
    o = F.coalesce(_c(old), F.lit(""))
    n = F.coalesce(_c(new), F.lit(""))
    return (o != n) & (strip_space_like(o) == strip_space_like(n))


def removal_marked(c, marker: str = "abolish") -> Column:
    """FLT-05: the removal marker, any case, any outer whitespace."""
    return F.coalesce(F.lower(norm(c)) == marker.lower(), F.lit(False))
