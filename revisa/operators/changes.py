"""Change set: build update / insert / delete entries, apply them with guards, render DML.

Entries are DataFrames, not driver lists.  An update entry keeps its assignments as an
ordered ``array<struct>`` (spec order), so rendering and applying never regroup rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.functions import lists as L
from revisa.functions import text as T
from revisa.operators import revision as rv
from revisa.spec import RevisionSpec

KEY = rv.KEY


def _conv_struct(spec: RevisionSpec, c: str, target: str) -> Column:
    kind = spec.kind(c)
    conv = T.convert_checked(F.col("u_" + c), kind, c, spec.taxnode_pattern, spec.type_codes)
    return F.struct(
        F.lit(c).alias("column"),
        F.lit(target).alias("target"),
        F.lit(kind in ("int", "taxnode")).alias("is_int"),
        conv["value"].alias("new_value"),
        T.convert_lenient(F.col("o_" + c), kind, spec.taxnode_pattern, spec.type_codes).alias("old_value"),
        conv["error"].alias("error"),
    )


def changed_cells(spec: RevisionSpec, fallback: bool | None = None) -> Column:
    """The changed updatable cells of a joined pair (``o_``, ``u_`` columns), in spec order, converted."""
    fallback = spec.fallback(fallback)
    items = [
        F.when(~T.values_equal(F.col("o_" + c), F.col("u_" + c), spec.kind(c), fallback, spec.type_codes), _conv_struct(spec, c, t))
        for c, t in spec.updatable
    ]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def update_candidates(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """One row per (original row, unambiguous live edited row) with at least one change.

    Columns: ``rkey, key_num, ord (edited row), o_ord, ch`` where ``ch`` is the ordered
    array of changed updatable cells with converted new and old values and an error.
    """
    cols = [c for c, _ in spec.updatable]
    e = rv.live(edited).select("ord", KEY, rv.REMOVED, *cols)
    m = rv.matched(original, rv.unique_rows(e, spec), spec, cols)
    ch = changed_cells(spec, fallback)
    m = m.select(KEY, F.col("u_ord").alias("ord"), "o_ord", *[F.col(x) for x in m.columns if x.startswith(("o_", "u_")) and x not in ("o_ord", "u_ord")])
    c = rv.project_once(m, [KEY, "ord", "o_ord"], ch=ch).where(F.size("ch") > 0)
    return rv.project_once(
        c,
        [KEY, "ord", "o_ord", "ch"],
        key_num=T.key_numeric(F.col(KEY), spec.key_pattern),
        valid=F.forall("ch", lambda x: x["error"].isNull()),
    )


def update_entries(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """CHG-01: accepted update entries (all conversions valid, numeric key)."""
    c = update_candidates(original, edited, spec, fallback)
    return c.where(F.col("valid") & F.col("key_num").isNotNull()).select(KEY, "key_num", "ord", "o_ord", "ch")


def change_updates(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """CHG-01 in long form: one row per assignment."""
    e = update_entries(original, edited, spec, fallback)
    return e.select(KEY, "key_num", "ord", "o_ord", F.explode("ch").alias("a")).select(
        KEY, "key_num", "ord", "o_ord", "a.target", "a.new_value", "a.old_value"
    )


def update_issues(original: DataFrame, edited: DataFrame, spec: RevisionSpec, fallback: bool | None = None) -> DataFrame:
    """Issues of CHG-01: conversion errors, then non-numeric keys of otherwise valid rows."""
    c = update_candidates(original, edited, spec, fallback)
    conv = c.select("ord", F.explode(F.filter("ch", lambda x: x["error"].isNotNull())).alias("a")).select(
        "ord", F.col("a.error").alias("message"), F.lit("ERROR").alias("severity")
    )
    nonnum = c.where(F.col("valid") & F.col("key_num").isNull()).select(
        "ord", F.concat(F.lit("Key '"), F.col(KEY), F.lit("' cannot be converted to numeric form.")).alias("message"), F.lit("ERROR").alias("severity")
    )
    return conv.unionByName(nonnum)


def _insert_values(spec: RevisionSpec) -> list[tuple[str, str, Column]]:
    out = []
    for target, c in spec.insertable:
        out.append((target, spec.kind(c), T.convert_checked(F.col(c), spec.kind(c), c, spec.taxnode_pattern, spec.type_codes)))
    return out


def insert_candidates(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """New rows with converted values (``v_<target>``) and the array of conversion errors."""
    vals = _insert_values(spec)
    errors = F.filter(F.array(*[v["error"] for _, _, v in vals]), lambda x: x.isNotNull())
    return rv.project_once(rv.new_rows(edited), ["ord"], **{"v_" + t: v["value"] for t, _, v in vals}, errors=errors)


def change_inserts(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """CHG-03: typed insert rows (integers as bigint) for new rows whose conversions all pass."""
    c = insert_candidates(edited, spec)
    out = []
    for target, c_name in spec.insertable:
        v = F.col("v_" + target)
        out.append((v.cast("bigint") if spec.kind(c_name) in ("int", "taxnode") else v).alias(target))
    return c.where(F.size("errors") == 0).select("ord", *out)


def insert_issues(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    c = insert_candidates(edited, spec)
    return c.select("ord", F.explode("errors").alias("message")).withColumn("severity", F.lit("ERROR"))


def delete_candidates(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    rows = edited.where(F.col(rv.REMOVED))
    return rows.withColumn("key_num", T.key_numeric(F.col(KEY), spec.key_pattern)).withColumn("target_value", T.norm(spec.key))


def change_deletes(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    """CHG-04: soft-delete entries: removal-marked rows with a numeric key, full row as detail."""
    details = [c for c in spec.columns if c != spec.removal_column]
    d = delete_candidates(edited, spec)
    return d.where(F.col("key_num").isNotNull()).select(KEY, "key_num", "ord", "target_value", *[F.col(c).alias("d_" + c) for c in details])


def delete_issues(edited: DataFrame, spec: RevisionSpec) -> DataFrame:
    d = delete_candidates(edited, spec)
    msg = F.when(F.col(KEY).isNull(), F.lit("Row marked for removal must contain a key.")).when(
        F.col("key_num").isNull(), F.concat(F.lit("Key '"), F.col(KEY), F.lit("' cannot be converted to numeric form."))
    )
    return d.select("ord", msg.alias("message")).where(F.col("message").isNotNull()).withColumn("severity", F.lit("ERROR"))


# ---------------------------------------------------------------- stored table and apply

def stored_table(original: DataFrame, spec: RevisionSpec) -> DataFrame:
    """The stored form of a baseline: numeric id, no taxon id yet, typed target columns."""
    cols = [F.col("record_id"), F.lit(None).cast("bigint").alias("taxnode_id")]
    sel = [T.key_numeric(F.col(KEY), spec.key_pattern).alias("record_id")]
    for target, c in spec.insertable:
        v = T.convert_lenient(F.col(c), spec.kind(c), spec.taxnode_pattern, spec.type_codes)
        sel.append((v.cast("bigint") if spec.kind(c) in ("int", "taxnode") else v).alias(target))
        cols.append(F.col(target))
    return original.where(F.col(KEY).isNotNull()).select(*sel).select(*cols)


def apply_updates(stored: DataFrame, entries: DataFrame, spec: RevisionSpec, guard: str = "any") -> DataFrame:
    """CHG-06: apply update entries, in entry order, where the key matches and the guard holds.

    ``guard='any'``: one old value that still matches (null-safe) lets the update through
    (the reference's OR); ``guard='all'`` needs every old value to match.  An entry sees what
    the entries before it (by original row) have left of a stored row.  Keys with one entry are
    joined; those with several go through :func:`revisa.operators.fold.fold_entries`.  The
    entries are written once, since both ways read them.
    Adds ``update_status``: ``applied``, ``guard_miss`` or null (no entry).
    """
    from revisa.operators.fold import fold_entries
    from revisa.sources.tables import written_once

    targets = {t: spec.kind(c) in ("int", "taxnode") for c, t in spec.updatable}
    entries = written_once(entries.select("key_num", "ord", "o_ord", "ch"), "update-entries")
    several = entries.groupBy("key_num").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key_num")
    if several.isEmpty():
        return _apply_single(stored, entries, targets, guard)
    several = written_once(several, "several-entries")
    names = several.withColumnRenamed("key_num", "record_id")
    ordered = fold_entries(stored.join(names, "record_id", "left_semi"), entries.join(several, "key_num", "left_semi"), "record_id", targets, guard)
    return _apply_single(stored.join(names, "record_id", "left_anti"), entries.join(several, "key_num", "left_anti"), targets, guard).unionByName(ordered)


def _apply_single(stored: DataFrame, entries: DataFrame, targets: dict[str, bool], guard: str) -> DataFrame:
    """Entries of keys that have one: a join, and the guard as an expression over the entry's array."""
    j = stored.join(entries.select(F.col("key_num").alias("record_id"), "ch"), "record_id", "left")

    def about(t):
        return lambda c: c["target"] == t

    def of(t, field):
        value = F.get(F.filter("ch", about(t)), F.lit(0))[field]
        return value.cast("bigint") if targets[t] else value

    checks = F.array(*[F.when(F.exists("ch", about(t)), F.col(t).eqNullSafe(of(t, "old_value"))) for t in targets])
    asked = F.filter(checks, lambda x: x.isNotNull())
    ok = F.forall(asked, lambda x: x) if guard == "all" else F.exists(asked, lambda x: x)
    j = rv.project_once(j, [*[F.col(c) for c in stored.columns], "ch"], ok=F.coalesce(F.col("ch").isNotNull() & ok, F.lit(False)))
    out = [
        F.when(F.col("ok") & F.exists("ch", about(c)), of(c, "new_value")).otherwise(F.col(c)).alias(c) if c in targets else F.col(c)
        for c in stored.columns
    ]
    status = F.when(F.col("ok"), F.lit("applied")).when(F.col("ch").isNotNull(), F.lit("guard_miss"))
    return j.select(*out, status.alias("update_status"))


def apply_deletes(stored: DataFrame, deletes: DataFrame, name_column: str) -> DataFrame:
    """CHG-07: soft delete: taxon id cleared, name set to ``'abolished'``."""
    ids = deletes.select(F.col("key_num").alias("record_id")).distinct().withColumn("_del", F.lit(True))
    j = stored.join(ids, "record_id", "left")
    hit = F.coalesce(F.col("_del"), F.lit(False))
    out = []
    for c in stored.columns:
        if c == "taxnode_id":
            out.append(F.when(hit, F.lit(None).cast("bigint")).otherwise(F.col(c)).alias(c))
        elif c == name_column:
            out.append(F.when(hit, F.lit("abolished")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def apply_inserts(stored: DataFrame, inserts: DataFrame, resolver, name_column: str) -> DataFrame:
    """CHG-08: append inserts (no id yet), then fill a missing taxon id by name for every
    live row without one (``resolver(names) -> (name, taxnode_id)``)."""
    new = inserts.select(
        F.lit(None).cast("bigint").alias("record_id"),
        F.lit(None).cast("bigint").alias("taxnode_id"),
        *[F.col(c) for c in stored.columns if c not in ("record_id", "taxnode_id")],
    )
    allrows = stored.unionByName(new)
    need = allrows.where(F.col("taxnode_id").isNull() & ~F.coalesce(F.col(name_column) == "abolished", F.lit(False)))
    names = need.select(F.col(name_column).alias("name")).where(F.col("name").isNotNull()).distinct()
    resolved = resolver(names).withColumnRenamed("taxnode_id", "_tx").withColumnRenamed("name", name_column)
    # only rows that can change are joined: abolished and unnamed rows would meet in one task
    fill = F.col("taxnode_id").isNull() & F.col(name_column).isNotNull() & ~F.coalesce(F.col(name_column) == "abolished", F.lit(False))
    filled = allrows.where(fill).join(resolved, name_column, "left")
    filled = filled.select(*[F.col("_tx").alias(c) if c == "taxnode_id" else F.col(c) for c in allrows.columns])
    return allrows.where(~fill).unionByName(filled)


# ---------------------------------------------------------------- rendering (CHG-09)

def render_updates(entries: DataFrame, spec: RevisionSpec) -> DataFrame:
    """One UPDATE statement per entry, assignments in spec order, OR-guard on old values."""
    lit_new = lambda a: F.when(a["new_value"].isNull(), F.lit("NULL")).when(a["is_int"], a["new_value"]).otherwise(
        F.concat(F.lit("'"), F.replace(a["new_value"], F.lit("'"), F.lit("''")), F.lit("'"))
    )
    lit_old = lambda a: F.when(a["is_int"], a["old_value"]).otherwise(
        F.concat(F.lit("'"), F.replace(a["old_value"], F.lit("'"), F.lit("''")), F.lit("'"))
    )
    assigns = F.array_join(F.transform("ch", lambda a: F.concat(F.lit("    "), a["target"], F.lit(" = "), lit_new(a))), ",\n")
    conds = F.transform(
        "ch", lambda a: F.when(a["old_value"].isNull(), F.concat(a["target"], F.lit(" IS NULL"))).otherwise(F.concat(a["target"], F.lit(" = "), lit_old(a)))
    )
    where = F.concat(F.lit("WHERE record_id = "), F.col("key_num").cast("string"))
    guard = F.when(F.size(conds) == 1, F.concat(where, F.lit(" AND "), conds[0], F.lit(";"))).otherwise(
        F.concat(where, F.lit(" AND (\n    "), F.array_join(conds, "\n    OR "), F.lit("\n);"))
    )
    stmt = F.concat_ws(
        "\n",
        F.concat(F.lit("-- "), F.col(KEY), F.lit(" (worksheet row "), F.col("ord").cast("string"), F.lit(")")),
        F.lit(f"UPDATE {spec.target_table}"),
        F.lit("SET"),
        assigns,
        guard,
    )
    return entries.select("ord", KEY, stmt.alias("statement"))


def render_inserts(inserts: DataFrame, spec: RevisionSpec) -> DataFrame:
    targets = [t for t, _ in spec.insertable]
    kinds = {t: spec.kind(c) for t, c in spec.insertable}
    vals = [T.sql_literal(F.col(t), "int" if kinds[t] in ("int", "taxnode") else "text") for t in targets]
    stmt = F.concat_ws(
        "\n",
        F.concat(F.lit("-- Worksheet row "), F.col("ord").cast("string")),
        F.lit(f"INSERT INTO {spec.target_table} ("),
        F.lit("    " + ",\n    ".join(targets)),
        F.lit(") VALUES ("),
        F.concat(F.lit("    "), F.concat_ws(",\n    ", *vals)),
        F.lit(");"),
    )
    return inserts.select("ord", stmt.alias("statement"))


def render_deletes(deletes: DataFrame, spec: RevisionSpec, name_column: str = "entry_name") -> DataFrame:
    details = [c for c in spec.columns if c != spec.removal_column]
    lines = [F.concat(F.lit(f"-- {c}: "), F.coalesce(T.flatten_newlines(T.norm(F.col("d_" + c))), F.lit(""))) for c in details]
    stmt = F.concat_ws(
        "\n",
        F.concat(F.lit("-- "), F.col(KEY), F.lit(" (worksheet row "), F.col("ord").cast("string"), F.lit(")")),
        *lines,
        F.lit(f"UPDATE {spec.target_table} SET taxnode_id=NULL, {name_column}='abolished' "),
        F.concat(F.lit("WHERE record_id = "), F.col("key_num").cast("string"), F.lit(";")),
    )
    return deletes.select("ord", KEY, stmt.alias("statement"))


def list_finding(spec: RevisionSpec, strict: bool) -> tuple[Column, Column]:
    """Whether a joined pair's list cell changed in a way to report (any way under strict), and the message."""
    o, u = F.col("o_" + spec.list_column), F.col("u_" + spec.list_column)
    told = ~T.values_equal(o, u, "text")
    if not strict:
        told = F.when(told, L.classify_change(o, u) == "meaningful").otherwise(F.lit(False))
    return told, _list_message(spec, o, u)


def _list_message(spec: RevisionSpec, o: Column, u: Column) -> Column:
    return F.concat(
        F.lit(f"List column '{spec.list_column}' changed from '"), F.coalesce(T.norm(o), F.lit("")), F.lit("' to '"), F.coalesce(T.norm(u), F.lit("")),
        F.lit("' for key "), F.col(KEY), F.lit("."),
    )


def list_change_issues(original, edited, spec, strict: bool = False):
    """CHG-02: warnings for list-cell changes (only ``meaningful`` ones unless strict)."""
    m = rv.matched(original, rv.unique_rows(rv.live(edited), spec), spec, [spec.list_column])
    o, u = F.col("o_" + spec.list_column), F.col("u_" + spec.list_column)
    c = rv.project_once(m.where(~T.values_equal(o, u, "text")), [KEY, F.col("u_ord").alias("ord"), o, u], change_class=L.classify_change(o, u))
    if not strict:
        c = c.where(F.col("change_class") == "meaningful")
    return c.select(KEY, "ord", "change_class", _list_message(spec, o, u).alias("message"), F.lit("WARNING").alias("severity"))
