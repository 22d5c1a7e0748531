"""List-valued cells (``"seg: ACC; ACC2\\nACC3"``) as arrays of ``struct(segment, token)``.

Higher-order functions (``transform`` / ``filter``) keep the work in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from revisa.functions.text import _c, norm, strip_ws

ENTRY = Ty.StructType([Ty.StructField("segment", Ty.StringType()), Ty.StructField("token", Ty.StringType())])
ENTRIES = Ty.ArrayType(ENTRY)
# Fragment separators and the segment delimiter.
SEPARATORS = "[;\n]+"
SEGMENT_DELIM = ":"


def split_segments(c) -> Column:
    """SCL-14: ``[(segment or null, token)]``; only the first colon splits; empty tokens dropped.

    Lambda bodies of higher-order functions are evaluated outside whole-stage codegen, so
    they use position arithmetic (``instr`` / ``substr``) rather than a regex per fragment,
    and the cell is split on one character (newlines mapped to ``;`` first; fragments are
    stripped and empty ones dropped, so runs of separators need no regex).
    """
    frags = F.split(F.replace(norm(c), F.lit("\n"), F.lit(";")), ";")
    parts = F.filter(F.transform(frags, lambda f: strip_ws(f)), lambda p: p != "")

    def entry(p):
        at = F.instr(p, SEGMENT_DELIM)
        seg = F.when(at > 0, norm(p.substr(F.lit(1), at - 1)))
        tok = F.when(at > 0, strip_ws(p.substr(at + 1, F.length(p)))).otherwise(p)
        return F.struct(seg.alias("segment"), tok.alias("token"))

    entries = F.filter(F.transform(parts, entry), lambda e: e["token"] != "")
    return F.coalesce(entries, F.array().cast(ENTRIES))


def canonical_entries(entries, with_segment: bool) -> Column:
    """SCL-15: upper-cased ``(segment, token)`` pairs in order; segments blanked when ignored."""
    if with_segment:
        return F.transform(_c(entries), lambda e: F.struct(F.upper(F.coalesce(e["segment"], F.lit(""))).alias("segment"), F.upper(e["token"]).alias("token")))
    return F.transform(_c(entries), lambda e: F.struct(F.lit("").alias("segment"), F.upper(e["token"]).alias("token")))


def classify_change(old, new) -> Column:
    """SCL-16: ``whitespace`` / ``was_empty`` / ``segment_name`` / ``meaningful``.

    For large tables prefer :func:`classify_frame`, which parses each cell once."""
    return classify_entries(split_segments(old), split_segments(new), norm(old).isNull())


def classify_frame(df, old: str, new: str, out: str = "change_class"):
    """Add the change class of two list cells, parsing each changed cell once: cells that
    are equal once normalised are not parsed, and the parsed arrays are projected first (an
    expensive projection referenced several times is not inlined by the optimizer)."""
    same = norm(old).eqNullSafe(norm(new))
    parsed = [F.when(~F.col("_same"), split_segments(c)).alias(n) for c, n in ((old, "_o_entries"), (new, "_u_entries"))]
    tmp = df.withColumn("_same", same).select("*", *parsed).withColumn("_o_absent", norm(old).isNull())
    told = F.when(F.col("_same"), F.lit("whitespace")).otherwise(classify_entries("_o_entries", "_u_entries", F.col("_o_absent")))
    return tmp.withColumn(out, told).drop("_same", "_o_entries", "_u_entries", "_o_absent")


def classify_entries(o, u, old_absent) -> Column:
    """The SCL-16 decision on parsed entry lists (``old_absent``: the old cell is blank)."""
    o, u = _c(o), _c(u)
    no, nu = F.size(o), F.size(u)
    return (
        F.when((no == 0) & (nu == 0), F.lit("whitespace"))
        .when((no == 0) & old_absent, F.lit("was_empty"))
        .when(nu == 0, F.lit("meaningful"))
        .when(canonical_entries(o, True) == canonical_entries(u, True), F.lit("whitespace"))
        .when(canonical_entries(o, False) == canonical_entries(u, False), F.lit("segment_name"))
        .otherwise(F.lit("meaningful"))
    )


def tokens(c) -> Column:
    """SCL-17: upper-cased tokens of a list cell, in order."""
    return F.transform(split_segments(c), lambda e: F.upper(e["token"]))


def token_url(c, base_url: str) -> Column:
    """SCL-18: lookup URL of a list cell: tokens without spaces, comma-joined; none → null."""
    toks = F.filter(F.transform(split_segments(c), lambda e: F.replace(e["token"], F.lit(" "), F.lit(""))), lambda t: t != "")
    return F.when(F.size(toks) > 0, F.concat(F.lit(base_url), F.array_join(toks, ",")))


def entries_text(entries) -> Column:
    """Stable text of an entry list (for reports and oracles): ``seg|token;seg|token``."""
    return F.array_join(F.transform(_c(entries), lambda e: F.concat(F.coalesce(e["segment"], F.lit("")), F.lit("|"), e["token"])), ";")


def list_tokens(c) -> Column:
    """SCL-20: comma list → trimmed, non-blank tokens."""
    return F.filter(F.transform(F.split(_c(c), ","), lambda x: strip_ws(x)), lambda x: x != "")


LINE_BREAKS = "\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029]"
BULLET = r"^[\t-\r\x1c-\x20\x85\p{Z}]*-[\t-\r\x1c-\x20\x85\p{Z}]*(.+?)[\t-\r\x1c-\x20\x85\p{Z}]*$"


def bullets(c) -> Column:
    """SCL-21: items of ``- item`` lines, line by line (an empty bullet gives '')."""
    lines = F.split(_c(c), LINE_BREAKS)
    hits = F.filter(lines, lambda ln: ln.rlike(BULLET))
    return F.transform(hits, lambda ln: strip_ws(F.regexp_extract(ln, BULLET, 1)))
