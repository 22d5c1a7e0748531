"""Row reconciliation of a baseline table and its edited version.

All operators take prepared frames (see :func:`prepare`) and return lazy DataFrames.
Plan shape rules used throughout:

* the edited side is reduced to one row per key by an aggregate (partial, map-side
  combined; a hot key costs one small buffer per task), never by a window over the key;
* original and edited are joined once on the normalised key and cells are compared
  *inside* the joined row (array of structs, ``filter``, ``explode``), so rows without
  a change never multiply and the scans keep their pushed filters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import skew
from revisa.spec import RevisionSpec

KEY = "rkey"
REMOVED = "removed"


def prepare(df: DataFrame, spec: RevisionSpec, keyed_only: bool = False) -> DataFrame:
    """SRC-05 + FLT-04 + FLT-05: required columns, normalised key, removal flag, no blank rows.

    The spec's ordinal column comes out as ``ord`` (the name every operator uses).
    ``keyed_only`` keeps only rows with a key; when the key is a blank-check column such a
    row is never blank, so the blank filter (which reads every column) is skipped and the
    scan reads only the columns the caller uses.
    """
    cols = [F.col(spec.ordinal).alias("ord"), *spec.columns]
    removed = T.removal_marked(spec.removal_column, spec.removal_marker) if spec.removal_column else F.lit(False)
    base = df.select(*cols)
    if not (keyed_only and spec.key in spec.blank_columns):
        base = base.where(F.coalesce(*[T.norm(c) for c in spec.blank_columns]).isNotNull())
    out = base.select("ord", *spec.columns, T.norm_key(spec.key).alias(KEY), removed.alias(REMOVED))
    return out.where(F.col(KEY).isNotNull()) if keyed_only else out


def key_frame(df: DataFrame, spec: RevisionSpec) -> DataFrame:
    """``(ord, rkey)`` of the rows with a key, for operators that only look at keys.

    When the key is one of the blank-check columns, a row with a key is never blank, so
    the blank filter (which reads every column) is skipped and the scan reads only the
    ordinal and the key.
    """
    if spec.key in spec.blank_columns:
        k = df.select(F.col(spec.ordinal).alias("ord"), T.norm_key(spec.key).alias(KEY))
        return k.where(F.col(KEY).isNotNull())
    return prepare(df, spec).where(F.col(KEY).isNotNull()).select("ord", KEY)


def blank_rows(df: DataFrame, spec: RevisionSpec) -> DataFrame:
    """Rows FLT-04 drops (all blank-check columns absent)."""
    return df.where(F.coalesce(*[T.norm(c) for c in spec.blank_columns]).isNull())


def repeated_keys(prepared: DataFrame) -> DataFrame:
    """(rkey, n_rows, first_ord) of the keys that occur more than once: a hash aggregate over the key alone."""
    keyed = prepared.where(F.col(KEY).isNotNull()).groupBy(KEY)
    return keyed.agg(F.count(F.lit(1)).alias("n_rows"), F.min("ord").alias("first_ord")).where(F.col("n_rows") > 1)


def first_rows(prepared: DataFrame, spec: RevisionSpec, columns=None) -> DataFrame:
    """WIN-01: the first row (smallest ordinal) of each key, with a row count.

    Only the repeated keys are aggregated and looked up; rows are never packed into an
    aggregate, so nothing wide is sorted or shuffled before the join that follows.
    """
    columns = list(columns if columns is not None else spec.columns)
    rows = prepared.where(F.col(KEY).isNotNull()).select(KEY, "ord", *columns)
    j = rows.join(repeated_keys(prepared), KEY, "left")
    j = j.where(F.col("first_ord").isNull() | (F.col("ord") == F.col("first_ord")))
    return j.select(KEY, F.coalesce("n_rows", F.lit(1)).cast("bigint").alias("n_rows"), "ord", *columns)


def key_stats(prepared: DataFrame) -> DataFrame:
    """Per key: number of rows, first ordinal, and whether any copy is marked removed."""
    return (
        prepared.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min("ord").alias("first_ord"), F.max(F.col(REMOVED).cast("int")).alias("any_removed"))
    )


def unique_rows(prepared: DataFrame, spec: RevisionSpec) -> DataFrame:
    """Rows whose key occurs exactly once in ``prepared``: raw rows without the repeated keys."""
    rows = prepared.where(F.col(KEY).isNotNull())
    return rows.join(repeated_keys(prepared).select(KEY), KEY, "left_anti").select(KEY, *[c for c in prepared.columns if c != KEY])


def _side(df: DataFrame, prefix: str, spec: RevisionSpec, columns) -> DataFrame:
    return df.select(F.col(KEY), F.col("ord").alias(prefix + "ord"), *[F.col(c).alias(prefix + c) for c in columns])


def matched(original: DataFrame, edited: DataFrame, spec: RevisionSpec, columns=None) -> DataFrame:
    """Original rows with a key joined to the edited row of the same key.

    ``edited`` must already be reduced to one row per key.  Original duplicates are
    kept: each copy is compared (the reference does the same).
    """
    columns = list(columns if columns is not None else spec.columns)
    o = _side(original.where(F.col(KEY).isNotNull()), "o_", spec, columns)
    u = _side(edited, "u_", spec, columns)
    return o.join(u, KEY, "inner")


def cell_changes(columns, spec: RevisionSpec, fallback: bool | None = None) -> Column:
    """Array of ``struct(column, old, new)`` for compared cells that differ (FLT-08)."""
    fallback = spec.fallback(fallback)
    items = [
        F.when(
            ~T.values_equal(F.col("o_" + c), F.col("u_" + c), spec.kind(c), fallback, spec.type_codes),
            F.struct(F.lit(c).alias("column"), T.norm(F.col("o_" + c)).alias("old"), T.norm(F.col("u_" + c)).alias("new")),
        )
        for c in columns
    ]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def _explode_changes(m: DataFrame, columns, spec: RevisionSpec, fallback: bool) -> DataFrame:
    return (
        m.select(KEY, F.col("u_ord").alias("ord"), F.explode(cell_changes(columns, spec, fallback)).alias("ch"))
        .select(KEY, "ord", "ch.column", "ch.old", "ch.new")
    )


def project_once(df: DataFrame, keep, **exprs: Column) -> DataFrame:
    """Project expensive expressions once, behind a one-row generator.

    A filter on a projected alias is normally pushed below the projection by substituting
    the expression (into a join condition, say), so an expensive array or regex would be
    evaluated twice.  Columns produced by a generator cannot be substituted, so filters
    on them stay above it and each expression runs once per row.
    """
    packed = F.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select(*keep, F.inline(F.array(packed)))


def live(prepared: DataFrame) -> DataFrame:
    return prepared.where(~F.col(REMOVED))


def updatable_changes(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """JN-06: changed updatable cells of live, unambiguous edited rows."""
    cols = [c for c, _ in spec.updatable]
    e = live(edited).select("ord", KEY, REMOVED, *cols)
    m = matched(original, unique_rows(e, spec), spec, cols)
    return _explode_changes(m, cols, spec, fallback)


def read_only_changes(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """JN-05: changed read-only cells; duplicated keys (any row) and removed rows skipped."""
    cols = [c for c in spec.read_only if c != spec.key]
    candidates = unique_rows(edited.select("ord", KEY, REMOVED, *cols), spec).where(~F.col(REMOVED))
    m = matched(original, candidates, spec, cols)
    return _explode_changes(m, cols, spec, fallback)


def keys_added(original: DataFrame, edited: DataFrame) -> DataFrame:
    """JN-01: keys only in the edited table, with their first edited row."""
    e = edited.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min("ord").alias("ord"))
    o = original.where(F.col(KEY).isNotNull()).select(KEY)
    return e.join(o, KEY, "left_anti")


def keys_missing(original: DataFrame, edited: DataFrame) -> DataFrame:
    """JN-02: keys only in the original, with their first original row."""
    o = original.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min("ord").alias("ord"))
    e = edited.where(F.col(KEY).isNotNull()).select(KEY)
    return o.join(e, KEY, "left_anti")


def duplicate_keys(prepared: DataFrame) -> DataFrame:
    """AGG-01: every row of a key that occurs more than once, with the count and first row.

    Long form (one row per duplicated row) instead of a collected row list, so a key
    with millions of copies never becomes one array; such a key's rows stay where they are.
    """
    dup = repeated_keys(prepared)
    return skew.join_unique(prepared.where(F.col(KEY).isNotNull()).select(KEY, "ord"), dup, KEY, skew.hot_keys(dup, KEY, "n_rows"))


def duplicate_later_rows(prepared: DataFrame) -> DataFrame:
    """AGG-02: first row of a key wins; every later row is reported."""
    return duplicate_keys(prepared).where(F.col("ord") > F.col("first_ord")).select(KEY, "ord", "first_ord")


def key_format(prepared: DataFrame, spec: RevisionSpec) -> DataFrame:
    """FLT-07: non-blank keys that do not match the key pattern."""
    return prepared.where(F.col(KEY).isNotNull() & ~F.col(KEY).rlike(spec.key_pattern)).select("ord", F.col(spec.key).alias("raw_key"), KEY)


def new_rows(prepared: DataFrame) -> DataFrame:
    """Rows to insert: no key and not marked removed."""
    return prepared.where(F.col(KEY).isNull() & ~F.col(REMOVED))


def exact_changes(columns) -> Column:
    """AGG-09 change list: raw text compared exactly, absent = ''.

    The first compared column shows its name only, the others ``name:old``.
    """
    items = []
    for i, c in enumerate(columns):
        o, u = F.coalesce(F.col("o_" + c), F.lit("")), F.coalesce(F.col("u_" + c), F.lit(""))
        label = F.lit(c) if i == 0 else F.concat(F.lit(c + ":"), o)
        items.append(F.when(o != u, label))
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def row_change_summary(original: DataFrame, edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """AGG-09 + FLT-12: per original row, number of changed cells and the change text.

    The edited row of a key is its first row (lookup by first match); keys missing
    from the edited table are left to :func:`keys_missing`.
    """
    cols = list(spec.compared_columns)
    m = matched(original, first_rows(edited, spec, cols), spec, cols)
    ch = exact_changes(cols)
    return m.select(
        F.col("o_ord").alias("ord"),
        F.col(KEY),
        F.size(ch).cast("bigint").alias("n_changes"),
        F.array_join(ch, ",").alias("changes"),
        (F.size(ch) > 0).alias("changed"),
    )


def changed_flags(original: DataFrame, edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """JN-20: per edited row with a key, one flag per column: cell differs from the original.

    Original duplicates: the first copy is the lookup target.
    """
    cols = list(spec.compared_columns)
    o = first_rows(original, spec, cols).select(KEY, *[F.col(c).alias("o_" + c) for c in cols])
    e = edited.where(F.col(KEY).isNotNull()).select(KEY, "ord", *[F.col(c).alias("u_" + c) for c in cols])
    j = skew.join_unique(e, o, KEY, skew.hot_keys(skew.row_counts(edited, KEY), KEY, "_n"))
    return j.select(
        "ord",
        KEY,
        *[(F.coalesce(F.col("o_" + c), F.lit("")) != F.coalesce(F.col("u_" + c), F.lit(""))).alias("chg_" + c) for c in cols],
    )


def delta_columns(original: DataFrame, edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """JN-13: change count and text carried from the original row to each edited row.

    New rows (no key, name present) get ``1`` and the spec's label; rows without a key look
    nothing up and stay out of the join.  Every copy of a repeated edited key carries what
    its first row has.
    """
    cols = list(spec.compared_columns)
    summary = row_change_summary(first_rows(original, spec, cols), edited, spec).select(KEY, "n_changes", "changes")
    e = edited.select("ord", KEY, F.col(spec.name_column).alias("_name") if spec.name_column else F.lit(None).cast("string").alias("_name"))
    is_new = T.norm("_name").isNotNull()
    new = e.where(F.col(KEY).isNull()).select(
        "ord", KEY, F.when(is_new, F.lit(1)).cast("bigint").alias("n_changes"), F.when(is_new, F.lit(spec.new_label)).alias("changes")
    )
    keyed = e.where(F.col(KEY).isNotNull()).select("ord", KEY)
    known = skew.join_unique(keyed, summary, KEY, skew.hot_keys(skew.row_counts(edited, KEY), KEY, "_n"), "left")
    return known.select("ord", KEY, "n_changes", "changes").unionByName(new)


def values_equal_flags(original: DataFrame, edited: DataFrame, spec: RevisionSpec, columns=None, fallback: bool | None = None) -> DataFrame:
    """FLT-08 per matched pair: one boolean per column."""
    columns = list(columns if columns is not None else spec.data_columns)
    fallback = spec.fallback(fallback)
    m = matched(original, unique_rows(edited, spec), spec, columns)
    return m.select(
        F.col("u_ord").alias("ord"),
        KEY,
        *[T.values_equal(F.col("o_" + c), F.col("u_" + c), spec.kind(c), fallback, spec.type_codes).alias("eq_" + c) for c in columns],
    )


def union_all(dfs) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
