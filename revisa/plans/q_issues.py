"""Catalog: the whole revision check and its issue table (fixtures R and V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.operators import issues as iss
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans import q_changes as qc
from revisa.plans import q_lists as ql
from revisa.plans import q_revision as qr
from revisa.plans import q_vocab as qv
from revisa.plans.q_revision import SPEC, r_frames
from revisa.plans.registry import register

KEYPAT = S.q(SPEC.key_pattern)


REFERENCE = f"SELECT DISTINCT 'segment' AS col, {S.norm('c_mktsegment')} AS value FROM customer WHERE {S.norm('c_mktsegment')} IS NOT NULL AND c_mktsegment <> 'HOUSEHOLD' UNION ALL SELECT 'grade', 'A'"


def reference(spark, sf_dir):
    """Reference lists: the segments of customer but one, and a column no vocabulary has."""
    seg = fx.table(spark, sf_dir, "customer").where("c_mktsegment <> 'HOUSEHOLD'").select(F.lit("segment").alias("col"), F.col("c_mktsegment").alias("value"))
    return seg.unionByName(spark.createDataFrame([("grade", "A")], "col string, value string"))


def _list_pieces() -> list[str]:
    """The checks against vocabularies, reference lists and the export, as the whole check has them."""
    said = "'Value ''' || value || ''' in column ''' || col || "
    first = "(SELECT col, value, min(ord) AS ord FROM ({}) GROUP BY col, value)"
    return [
        f"SELECT 'vocabulary_revision' AS \"check\", 'vocabulary' AS worksheet, ord AS row, {said}''' does not appear in the original vocabulary.' AS message, 'ERROR' AS severity FROM {first.format(qv._ADDED)}",
        f"SELECT 'vocabulary_revision', 'vocabulary_original', ord, {said}''' is missing from the vocabulary.', 'ERROR' FROM {first.format(qv._REMOVED)}",
        f"SELECT 'reference_lists', 'vocabulary_original', ord, {said}''' is not present in the reference list.', 'ERROR' FROM nv_o "
        "WHERE col IN (SELECT col FROM ref) AND NOT EXISTS (SELECT 1 FROM ref r WHERE r.col = nv_o.col AND r.value = nv_o.value)",
        "SELECT DISTINCT 'reference_lists', 'vocabulary_original', NULL::bigint, 'Column ''' || col || ''' missing from the original vocabulary.', 'ERROR' FROM ref "
        "WHERE col NOT IN (SELECT col FROM nv_o)",
        "SELECT 'vocabulary', 'edited', ord, message, severity FROM corr WHERE message IS NOT NULL",
        "SELECT 'reconcile', 'export', ord, 'Key ' || rkey || ' appears multiple times in the export.', 'ERROR' FROM "
        "(SELECT rkey, ord, min(ord) OVER (PARTITION BY rkey) AS first_ord FROM px WHERE rkey IS NOT NULL) WHERE ord > first_ord",
        "SELECT 'reconcile', 'export', min(ord), 'Key ' || rkey || ' missing from the original table.', 'ERROR' FROM px "
        "WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM po WHERE rkey IS NOT NULL) GROUP BY rkey",
        "SELECT 'reconcile', 'original', min(ord), 'Key ' || rkey || ' missing from the export.', 'ERROR' FROM po "
        "WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM px WHERE rkey IS NOT NULL) GROUP BY rkey",
        "SELECT 'reconcile', 'original', ord, 'Column ''' || \"column\" || ''' for key ' || rkey || ' does not match the export (original=''' || coalesce(original_value, '') "
        "|| ''', export=''' || coalesce(export_value, '') || ''').', 'ERROR' FROM cells_x",
    ]


def _pieces(correct: bool) -> list[str]:
    p = _list_pieces() if correct else []
    p.append(
        "SELECT 'blank_keys' AS \"check\", 'original' AS worksheet, ord AS row, 'Original table contains a blank key.' AS message, 'ERROR' AS severity "
        "FROM po WHERE rkey IS NULL"
    )
    for side, src in (("edited", "pu"), ("original", "po")):
        p.append(f"SELECT 'key_format', '{side}', ord, 'Invalid key format: ' || id, 'ERROR' FROM {src} WHERE rkey IS NOT NULL AND NOT regexp_matches(rkey, {KEYPAT})")
        p.append(
            f"SELECT 'duplicate_keys', '{side}', ord, 'Key ' || rkey || ' appears multiple times (' || cast(count(*) OVER (PARTITION BY rkey) AS varchar) || ' rows).', 'ERROR' "
            f"FROM {src} WHERE rkey IS NOT NULL QUALIFY count(*) OVER (PARTITION BY rkey) > 1"
        )
    p.append(
        "SELECT 'keys_added', 'edited', min(ord), 'Key ' || rkey || ' not present in original table.', 'ERROR' FROM pu "
        "WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM po WHERE rkey IS NOT NULL) GROUP BY rkey"
    )
    p.append(
        "SELECT 'keys_missing', 'original', min(ord), 'Key ' || rkey || ' missing from edited table.', 'ERROR' FROM po "
        "WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM pu WHERE rkey IS NOT NULL) GROUP BY rkey"
    )
    ro = qr._changes_sql(qr._RO_COLS, f"SELECT * FROM ({qr._unique_sql('pu')}) WHERE NOT removed")
    p.append(f"SELECT 'read_only', 'edited', ord, 'Read-only column ''' || \"column\" || ''' changed for key ' || rkey || '.', 'ERROR' FROM ({ro})")
    p.append("SELECT 'token_reuse', 'edited', ord, 'New record reuses existing token(s): ' || reused, 'ERROR' FROM reuse_ex")
    p.append("SELECT 'token_reuse', 'edited', ord, 'New record reuses token(s) from other new rows: ' || reused, 'ERROR' FROM walk WHERE rn > 0 AND status = 'rejected'")
    kn = S.key_numeric("rkey", SPEC.key_pattern)
    p.append(
        f"SELECT 'deletes', 'edited', ord, CASE WHEN rkey IS NULL THEN 'Row marked for removal must contain a key.' "
        f"ELSE 'Key ''' || rkey || ''' cannot be converted to numeric form.' END, 'ERROR' FROM pu WHERE removed AND (rkey IS NULL OR {kn} IS NULL)"
    )
    p.append("SELECT 'updates', 'edited', ord, error, 'ERROR' FROM longc WHERE error IS NOT NULL")
    p.append(
        "SELECT 'updates', 'edited', ord, 'Key ''' || rkey || ''' cannot be converted to numeric form.', 'ERROR' FROM longc "
        "GROUP BY rkey, ord, o_ord, key_num HAVING count(error) = 0 AND key_num IS NULL"
    )
    for t, c in SPEC.insertable:
        _, e = S.convert_checked(c, SPEC.kind(c), c)
        p.append(f"SELECT 'inserts', 'edited', ord, {e}, 'ERROR' FROM pu WHERE rkey IS NULL AND NOT removed AND {e} IS NOT NULL")
    lst = ql.LIST
    p.append(
        f"SELECT 'list_changes', 'edited', ord, 'List column ''{lst}'' changed from ''' || coalesce({S.norm('o_t')}, '') || ''' to ''' || coalesce({S.norm('u_t')}, '') "
        f"|| ''' for key ' || rkey || '.', 'WARNING' FROM (SELECT o.rkey, u.ord, o.{lst} AS o_t, u.{lst} AS u_t, {S.classify_change('o.' + lst, 'u.' + lst)} AS cls "
        f"FROM po o JOIN ({qr._unique_sql('pu', 'NOT removed')}) u ON o.rkey = u.rkey WHERE NOT {S.values_equal('o.' + lst, 'u.' + lst, 'text')}) WHERE cls = 'meaningful'"
    )
    return p


def _corrected_pu() -> str:
    cols = []
    joins = []
    for c in ["ord", *SPEC.columns, "rkey", "removed"]:
        if c in qv.CONSTRAINED:
            cols.append(f"k_{c}.value AS {c}")
            joins.append(f"LEFT JOIN corr k_{c} ON k_{c}.ord = r.ord AND k_{c}.\"column\" = {S.q(c)}")
        else:
            cols.append(f"r.{c}")
    return f"SELECT {', '.join(cols)} FROM pu_raw r {' '.join(joins)}"


def check_sql(correct: bool, body: str | None = None) -> str:
    union = "\nUNION ALL\n".join(_pieces(correct))
    ctes = [("po", S.prepared("rev_original", SPEC)), ("pu_raw", S.prepared("rev_updated", SPEC))]
    if correct:
        corr_sql = qv._correct_sql()
        corr_body = corr_sql[corr_sql.index("\nSELECT x.ord") + 1 :]
        ctes += [
            ("nv_u", f"SELECT {S.norm('col')} AS col, {S.norm('value')} AS value, ord FROM vocab_updated WHERE {S.norm('value')} IS NOT NULL AND {S.norm('col')} IS NOT NULL"),
            ("cells", "\nUNION ALL\n".join(f"SELECT ord, {S.q(c)} AS col, {c} AS raw FROM pu_raw" for c in qv.CONSTRAINED)),
            ("allowed", "SELECT DISTINCT col, value FROM nv_u"),
            ("canon", qv._CANON),
            ("corr", corr_body),
            ("pu", _corrected_pu()),
            ("nv_o", f"SELECT {S.norm('col')} AS col, {S.norm('value')} AS value, ord FROM vocab_original WHERE {S.norm('value')} IS NOT NULL AND {S.norm('col')} IS NOT NULL"),
            ("ref", REFERENCE),
            ("px", qr._PX),
            ("fo", qr._FIRST.format("po")),
            ("fx", qr._FIRST.format("px")),
            ("cells_x", qr._reconcile_body()),
        ]
    else:
        ctes.append(("pu", "SELECT * FROM pu_raw"))
    ctes += [
        ("longc", qc._long_sql()),
        ("existing", ql._EXISTING),
        ("newt", ql._NEWT),
        ("reuse_ex", ql._REUSE_EXISTING),
        ("cand", ql._CAND),
        ("walk", ql._WALK),
        ("issues", union),
    ]
    names = ["rev_original", "rev_updated"] + (["vocab_original", "vocab_updated", "rev_export"] if correct else [])
    sql = S.with_fixtures(names, body or 'SELECT "check", worksheet, cast(row AS bigint) AS row, message, severity FROM issues', ctes)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _check(spark, sf_dir) -> iss.RevisionCheck:
    """The complete check: vocabularies, reference lists and export included."""
    o, u = r_frames(spark, sf_dir)
    vo, vu = qv.frames(spark, sf_dir)
    lists = {"vocab_original": vo, "reference": reference(spark, sf_dir), "export": qr._export_prepared(spark, sf_dir), "export_kinds": qr.RECONCILE_KINDS}
    return iss.RevisionCheck(o, u, SPEC, vu, qv.CONSTRAINED, **lists)


@register("issue_log", check_sql(False))
def issue_log(spark, sf_dir):
    """The check without vocabularies, lists and export: the edit is not corrected first."""
    return iss.check_revision(*r_frames(spark, sf_dir), SPEC)


@register("check_revision", check_sql(True))
def check_revision(spark, sf_dir):
    return iss.all_issues(_check(spark, sf_dir))


@register("has_errors", check_sql(True, "SELECT coalesce(max(severity = 'ERROR'), false) AS has_errors FROM issues"))
def has_errors(spark, sf_dir):
    return spark.createDataFrame([(_check(spark, sf_dir).has_errors(),)], "has_errors boolean")


def _report_body() -> str:
    ctx = list(SPEC.context_columns)
    flags = ", ".join(
        f"CASE WHEN e.rkey IS NULL THEN {S.norm('e.' + c)} IS NOT NULL ELSE NOT {S.values_equal('o.' + c, 'e.' + c, SPEC.kind(c))} END AS chg_{c}" for c in ctx
    )
    vals = ", ".join(f"e.{c} AS ctx_{c}" for c in ctx)
    first = "SELECT * FROM po WHERE rkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rkey ORDER BY ord) = 1"
    ctxt = f"SELECT 'edited' AS worksheet, e.ord AS row, e.rkey, {vals}, {flags} FROM pu e LEFT JOIN ({first}) o ON e.rkey = o.rkey"
    return (
        f"SELECT i.\"check\", i.worksheet, cast(i.row AS bigint) AS row, i.message, i.severity, c.rkey, "
        + ", ".join(f"c.ctx_{x}" for x in ctx)
        + ", "
        + ", ".join(f"c.chg_{x}" for x in ctx)
        + f" FROM issues i LEFT JOIN ({ctxt}) c ON i.worksheet = c.worksheet AND i.row = c.row"
    )


@register("issue_report", check_sql(True, _report_body()))
def issue_report(spark, sf_dir):
    check = _check(spark, sf_dir)
    return iss.report(iss.all_issues(check), check.original, check.edited, SPEC)
