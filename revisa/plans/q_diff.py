"""Catalog: positional table-set diff (fixture S)."""

from __future__ import annotations


from revisa.functions import text as T
from revisa.operators import tablediff as td
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.registry import register

# The ignore rule used on fixture S (table regex : value regex).
IGNORE = ["par:ignore th"]
# The tables of fixture S that both sets have.
PAIRS = [("part", "part")]
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def grids(spark, sf_dir):
    o = fx.grid_old(spark, sf_dir)
    return o, fx.grid_new(spark, sf_dir, o)


def _diffs(spark, sf_dir, ws=False):
    o, n = grids(spark, sf_dir)
    return td.cell_diff(o, n, PAIRS, ignore_whitespace_only=ws)


_PAIRS = "SELECT o.sheet AS old_sheet, o.sheet AS new_sheet FROM (SELECT DISTINCT sheet FROM grid_old) o JOIN (SELECT DISTINCT sheet FROM grid_new) n ON o.sheet = n.sheet"
_DIFF = (
    "SELECT CASE WHEN x.old_sheet = x.new_sheet THEN x.old_sheet ELSE x.old_sheet || ' -> ' || x.new_sheet END AS sheet, x.old_sheet, x.row, x.col, x.old_value, x.new_value FROM ("
    "SELECT coalesce(o.old_sheet, n.old_sheet) AS old_sheet, coalesce(o.new_sheet, n.new_sheet) AS new_sheet, coalesce(o.row, n.row) AS row, coalesce(o.col, n.col) AS col, "
    "o.value AS old_value, n.value AS new_value FROM "
    "(SELECT p.old_sheet, p.new_sheet, g.row, g.col, g.value FROM grid_old g JOIN pairs p ON g.sheet = p.old_sheet) o FULL OUTER JOIN "
    "(SELECT p.old_sheet, p.new_sheet, g.row, g.col, g.value FROM grid_new g JOIN pairs p ON g.sheet = p.new_sheet) n "
    "ON o.old_sheet = n.old_sheet AND o.new_sheet = n.new_sheet AND o.row = n.row AND o.col = n.col) x WHERE x.old_value IS DISTINCT FROM x.new_value"
)


def _strip_sl(x):
    return f"regexp_replace(coalesce({x}, ''), '{S.SPACE_LIKE}', '', 'g')"


def _ws_only(a, b):
    return f"(coalesce({a}, '') <> coalesce({b}, '') AND {_strip_sl(a)} = {_strip_sl(b)})"


def _a1_col(c):
    def letter(x):
        return f"substr('{LETTERS}', cast(((({x}) - 1) % 26 + 26) % 26 + 1 AS integer), 1)"

    n1 = f"floor(({c} - 1) / 26)"
    n2 = f"floor(({n1} - 1) / 26)"
    return f"((CASE WHEN {n2} > 0 THEN {letter(n2)} ELSE '' END) || (CASE WHEN {n1} > 0 THEN {letter(n1)} ELSE '' END) || {letter(c)})"


def _ignored_sql():
    hit = " OR ".join(f"(regexp_matches(p.old_sheet, {S.q(t)}) AND regexp_matches(g.value, {S.q(v)}))" for t, v in td.parse_ignore_rules(IGNORE))
    return (
        "SELECT DISTINCT CASE WHEN p.old_sheet = p.new_sheet THEN p.old_sheet ELSE p.old_sheet || ' -> ' || p.new_sheet END AS sheet, cast(g.row AS bigint) AS row "
        f"FROM grid_new g JOIN pairs p ON g.sheet = p.new_sheet WHERE g.value IS NOT NULL AND ({hit})"
    )


def s_sql(body: str, extra=()) -> str:
    return S.with_fixtures(["grid_old", "grid_new"], body, [("pairs", _PAIRS), ("diffs", _DIFF), ("ign", _ignored_sql()), *extra])


@register("cell_diff", s_sql("SELECT * FROM diffs"))
def cell_diff(spark, sf_dir):
    return _diffs(spark, sf_dir)


@register("cell_diff_no_ws", s_sql(f"SELECT * FROM diffs WHERE NOT {_ws_only('old_value', 'new_value')}"))
def cell_diff_no_ws(spark, sf_dir):
    return _diffs(spark, sf_dir, ws=True)


@register("whitespace_only_change", s_sql(f"SELECT sheet, row, col, {_ws_only('old_value', 'new_value')} AS ws_only FROM diffs"))
def whitespace_only_change(spark, sf_dir):
    return _diffs(spark, sf_dir).select("sheet", "row", "col", T.whitespace_only_change("old_value", "new_value").alias("ws_only"))


@register("strip_space_like", s_sql(f"SELECT sheet, row, col, {_strip_sl('value')} AS stripped FROM grid_new"))
def strip_space_like(spark, sf_dir):
    return grids(spark, sf_dir)[1].select("sheet", "row", "col", T.strip_space_like("value").alias("stripped"))


def _visible_sql(x):
    out = x
    for ch, shown in T.VISIBLE_WHITESPACE:
        out = f"replace({out}, chr({ord(ch)}), {S.q(shown)})"
    return out


@register("visible_whitespace", s_sql(f"SELECT sheet, row, col, {_visible_sql('value')} AS visible FROM grid_new"))
def visible_whitespace(spark, sf_dir):
    return grids(spark, sf_dir)[1].select("sheet", "row", "col", T.visible_whitespace("value").alias("visible"))


@register("a1_address", s_sql(f"SELECT sheet, row, col, {_a1_col('col')} || cast(row AS varchar) AS addr FROM diffs"))
def a1_address(spark, sf_dir):
    return _diffs(spark, sf_dir).select("sheet", "row", "col", T.a1_address("row", "col").alias("addr"))


@register("diff_ignore_rows", s_sql("SELECT * FROM diffs d WHERE NOT EXISTS (SELECT 1 FROM ign i WHERE i.sheet = d.sheet AND i.row = d.row)"))
def diff_ignore_rows(spark, sf_dir):
    o, n = grids(spark, sf_dir)
    return td.drop_ignored(td.cell_diff(o, n, PAIRS), td.ignored_rows(n, PAIRS, td.parse_ignore_rules(IGNORE)))


@register(
    "diff_by_cell",
    s_sql(f"SELECT sheet, row, col, {_a1_col('col')} || cast(row AS varchar) || ': ' || coalesce(old_value, '<empty>') || ' -> ' || coalesce(new_value, '<empty>') AS text FROM diffs"),
)
def diff_by_cell(spark, sf_dir):
    return td.by_cell(_diffs(spark, sf_dir))


@register(
    "diff_by_row",
    s_sql(
        f"SELECT sheet, row, 'Row ' || cast(row AS varchar) || ': ' || string_agg({_a1_col('col')} || ': ' || coalesce(old_value, '<empty>') || ' -> ' || "
        "coalesce(new_value, '<empty>'), ', ' ORDER BY col) AS text FROM diffs GROUP BY sheet, row"
    ),
)
def diff_by_row(spark, sf_dir):
    return td.by_row(_diffs(spark, sf_dir))


@register("diff_row_counts", s_sql("SELECT sheet, count(DISTINCT row) AS rows_with_differences FROM diffs GROUP BY sheet"))
def diff_row_counts(spark, sf_dir):
    return td.row_counts(_diffs(spark, sf_dir))


_SETDIFF = (
    "SELECT sheet, 'old_only' AS side FROM (SELECT DISTINCT sheet FROM grid_old) WHERE sheet NOT IN (SELECT sheet FROM grid_new) "
    "UNION ALL SELECT sheet, 'new_only' FROM (SELECT DISTINCT sheet FROM grid_new) WHERE sheet NOT IN (SELECT sheet FROM grid_old)"
)


@register("table_set_diff", s_sql("SELECT * FROM setdiff", extra=[("setdiff", _SETDIFF)]))
def table_set_diff(spark, sf_dir):
    o, n = grids(spark, sf_dir)
    return td.table_set_diff(o, n)


@register("table_pairs", s_sql("SELECT * FROM pairs"))
def table_pairs(spark, sf_dir):
    o, n = grids(spark, sf_dir)
    return td.table_pairs(o, n)


@register(
    "diff_verdict",
    s_sql(
        "SELECT n > 0 AS has_differences, CASE WHEN n > 0 THEN 'Differences found.' ELSE 'No differences found.' END AS message, n AS n_differences "
        "FROM (SELECT count(*) AS n FROM (SELECT 1 FROM diffs UNION ALL SELECT 1 FROM setdiff))",
        extra=[("setdiff", _SETDIFF)],
    ),
)
def diff_verdict(spark, sf_dir):
    o, n = grids(spark, sf_dir)
    return td.verdict(td.cell_diff(o, n, PAIRS), td.table_set_diff(o, n))


