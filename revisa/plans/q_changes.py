"""Catalog: change set (CHG), apply, render, resolve (fixtures R and N)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.operators import changes as ch
from revisa.operators import resolve as rs
from revisa.operators import revision as rv
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.q_revision import SPEC, _unique_sql, r_frames, r_keyed
from revisa.plans.registry import register

NL = "chr(10)"


def _is_int(c):
    return SPEC.kind(c) in ("int", "taxnode")


def _long_sql() -> str:
    """All update candidates, one row per changed cell (the CHG-01 working set)."""
    parts = []
    for pos, (c, t) in enumerate(SPEC.updatable):
        v, e = S.convert_checked("u." + c, SPEC.kind(c), c)
        parts.append(
            f"SELECT o.rkey, {S.key_numeric('o.rkey', SPEC.key_pattern)} AS key_num, u.ord, o.ord AS o_ord, {pos} AS pos, {S.q(t)} AS target, "
            f"{'true' if _is_int(c) else 'false'} AS is_int, {v} AS new_value, {S.convert_lenient('o.' + c, SPEC.kind(c))} AS old_value, {e} AS error "
            f"FROM po o JOIN ({_unique_sql('pu', 'NOT removed')}) u ON o.rkey = u.rkey WHERE NOT {S.values_equal('o.' + c, 'u.' + c, SPEC.kind(c))}"
        )
    return "\nUNION ALL\n".join(parts)


def _valid_sql() -> str:
    return (
        "SELECT l.* FROM longc l JOIN (SELECT rkey, ord, o_ord FROM longc GROUP BY rkey, ord, o_ord HAVING count(error) = 0) v "
        "ON l.rkey = v.rkey AND l.ord = v.ord AND l.o_ord = v.o_ord WHERE l.key_num IS NOT NULL"
    )


def c_sql(body: str, extra=()) -> str:
    ctes = [("po", S.prepared("rev_original", SPEC)), ("pu", S.prepared("rev_updated", SPEC)), ("longc", _long_sql()), ("validc", _valid_sql()), *extra]
    return S.with_fixtures(["rev_original", "rev_updated"], body, ctes)


@register("change_updates", c_sql("SELECT rkey, key_num, ord, o_ord, target, new_value, old_value FROM validc"))
def change_updates(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return ch.change_updates(o, u, SPEC)


def _insert_select() -> str:
    cols, errs = [], []
    for t, c in SPEC.insertable:
        v, e = S.convert_checked(c, SPEC.kind(c), c)
        cols.append(f"{'cast(' + v + ' AS bigint)' if _is_int(c) else v} AS {t}")
        errs.append(f"{e} IS NULL")
    return f"SELECT ord, {', '.join(cols)} FROM pu WHERE rkey IS NULL AND NOT removed AND {' AND '.join(errs)}"


@register("change_inserts", c_sql(_insert_select()))
def change_inserts(spark, sf_dir):
    return ch.change_inserts(r_frames(spark, sf_dir)[1], SPEC)


_DETAILS = [c for c in SPEC.columns if c != SPEC.removal_column]
_DEL_SQL = (
    f"SELECT rkey, {S.key_numeric('rkey', SPEC.key_pattern)} AS key_num, ord, {S.norm('id')} AS target_value, "
    + ", ".join(f"{c} AS d_{c}" for c in _DETAILS)
    + f" FROM pu WHERE removed AND {S.key_numeric('rkey', SPEC.key_pattern)} IS NOT NULL"
)


@register("change_deletes", c_sql(_DEL_SQL))
def change_deletes(spark, sf_dir):
    return ch.change_deletes(r_frames(spark, sf_dir)[1], SPEC)


# ---------------------------------------------------------------- apply

_INT_TARGETS = {t for t, c in SPEC.insertable if _is_int(c)}


def _stored_sql() -> str:
    cols = [f"{S.key_numeric('rkey', SPEC.key_pattern)} AS record_id", "cast(NULL AS bigint) AS taxnode_id"]
    for t, c in SPEC.insertable:
        v = S.convert_lenient(c, SPEC.kind(c))
        cols.append(f"{'cast(' + v + ' AS bigint)' if _is_int(c) else v} AS {t}")
    return f"SELECT {', '.join(cols)} FROM po WHERE rkey IS NOT NULL"


_STORED_COLS = ["record_id", "taxnode_id", *[t for t, _ in SPEC.insertable]]


def _typed(x, t):
    return f"cast({x} AS bigint)" if t in _INT_TARGETS else x


def _apply_updates_sql() -> str:
    """Entries of a key one after another: a recursive walk with the row's values as state."""
    targets = [t for _, t in SPEC.updatable]
    entry = ", ".join(
        f"count(*) FILTER (WHERE target = {S.q(t)}) > 0 AS h_{t}, max(new_value) FILTER (WHERE target = {S.q(t)}) AS n_{t}, max(old_value) FILTER (WHERE target = {S.q(t)}) AS v_{t}"
        for t in targets
    )
    ent = f"SELECT key_num, row_number() OVER (PARTITION BY key_num ORDER BY o_ord, ord) AS rn, {entry} FROM validc GROUP BY key_num, ord, o_ord"
    guard = "(" + " OR ".join(f"(e.h_{t} AND f.{t} IS NOT DISTINCT FROM {_typed(f'e.v_{t}', t)})" for t in targets) + ")"
    state = ", ".join(f"CASE WHEN {guard} AND e.h_{t} THEN {_typed(f'e.n_{t}', t)} ELSE f.{t} END" for t in targets)
    names = ", ".join(targets)
    walk = (
        f"SELECT rid, record_id, cast(0 AS bigint) AS step, false AS applied, {names} FROM st "
        f"UNION ALL SELECT f.rid, f.record_id, e.rn, f.applied OR {guard}, {state} FROM fold f JOIN ent e ON e.key_num = f.record_id AND e.rn = f.step + 1"
    )
    out = ", ".join(f"l.{c}" if c in targets else f"s.{c}" for c in _STORED_COLS)
    body = (
        f"SELECT {out}, CASE WHEN l.applied THEN 'applied' WHEN l.step > 0 THEN 'guard_miss' END AS update_status "
        "FROM st s JOIN (SELECT * FROM fold QUALIFY row_number() OVER (PARTITION BY rid ORDER BY step DESC) = 1) l ON s.rid = l.rid"
    )
    ctes = [
        ("po", S.prepared("rev_doubled", SPEC)),
        ("pu", S.prepared("rev_updated", SPEC)),
        ("longc", _long_sql()),
        ("validc", _valid_sql()),
        ("stored", _stored_sql()),
        ("st", "SELECT *, row_number() OVER () AS rid FROM stored"),
        ("ent", ent),
        ("fold", walk),
    ]
    return S.with_fixtures(["rev_doubled", "rev_updated"], body, ctes).replace("WITH ", "WITH RECURSIVE ", 1)


def _apply_frames(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return o, u, ch.stored_table(o, SPEC)


@register("apply_updates", _apply_updates_sql())
def apply_updates(spark, sf_dir):
    """A baseline in which some keys have several originals, each with its own entry."""
    o = rv.prepare(fx.rev_doubled(spark, sf_dir), SPEC, keyed_only=True)
    u = r_keyed(spark, sf_dir)[1]
    return ch.apply_updates(ch.stored_table(o, SPEC), ch.update_entries(o, u, SPEC), SPEC)


@register(
    "apply_deletes",
    c_sql(
        "SELECT s.record_id, CASE WHEN d.key_num IS NOT NULL THEN NULL ELSE s.taxnode_id END AS taxnode_id, "
        + ", ".join(
            f"CASE WHEN d.key_num IS NOT NULL THEN 'abolished' ELSE s.{t} END AS {t}" if t == "entry_name" else f"s.{t}"
            for t, _ in SPEC.insertable
        )
        + " FROM stored s LEFT JOIN (SELECT DISTINCT key_num FROM dels) d ON s.record_id = d.key_num",
        extra=[("stored", _stored_sql()), ("dels", _DEL_SQL)],
    ),
)
def apply_deletes(spark, sf_dir):
    o, u, stored = _apply_frames(spark, sf_dir)
    return ch.apply_deletes(stored, ch.change_deletes(u, SPEC), "entry_name")


def _resolve_sql(names_cte: str) -> list[tuple[str, str]]:
    return [
        ("nn", FIXTURE_NN),
        ("names", names_cte),
        ("ids", "SELECT n.name, max(x.stable_id) AS stable_id FROM nn x JOIN names n ON x.name = n.name GROUP BY n.name"),
        ("cur", "SELECT stable_id, taxnode_id FROM nn WHERE release_num = (SELECT max(release_num) FROM toc)"),
        ("hits", "SELECT i.name, count(c.taxnode_id) AS n_matches, min(c.taxnode_id) AS tx FROM ids i LEFT JOIN cur c ON i.stable_id = c.stable_id GROUP BY i.name"),
        (
            "resolved",
            "SELECT n.name, CASE WHEN h.n_matches = 1 THEN h.tx END AS taxnode_id, cast(coalesce(h.n_matches, 0) AS bigint) AS n_matches "
            "FROM names n LEFT JOIN hits h ON n.name = h.name",
        ),
    ]


FIXTURE_NN = "SELECT * FROM node_names"


def _apply_inserts_sql() -> str:
    ins_cols = ", ".join(t for t, _ in SPEC.insertable)
    allrows = f"SELECT * FROM stored UNION ALL SELECT cast(NULL AS bigint), cast(NULL AS bigint), {ins_cols} FROM ({_insert_select()})"
    names = "SELECT DISTINCT entry_name AS name FROM allrows WHERE taxnode_id IS NULL AND NOT coalesce(entry_name = 'abolished', false) AND entry_name IS NOT NULL"
    fill = "a.taxnode_id IS NULL AND NOT coalesce(a.entry_name = 'abolished', false)"
    body = (
        f"SELECT a.record_id, CASE WHEN {fill} THEN r.taxnode_id ELSE a.taxnode_id END AS taxnode_id, "
        + ", ".join(f"a.{t}" for t, _ in SPEC.insertable)
        + " FROM allrows a LEFT JOIN resolved r ON a.entry_name = r.name"
    )
    ctes = [("po", S.prepared("rev_original", SPEC)), ("pu", S.prepared("rev_named", SPEC)), ("stored", _stored_sql()), ("allrows", allrows)]
    ctes += _resolve_sql(names)
    return S.with_fixtures(["rev_original", "rev_named", "node_names", "toc"], body, ctes)


@register("apply_inserts", _apply_inserts_sql())
def apply_inserts(spark, sf_dir):
    """Inserts whose names have no id, one or two in the latest release, no name, or the removal name."""
    stored = _apply_frames(spark, sf_dir)[2]
    u = rv.prepare(fx.rev_named(spark, sf_dir), SPEC)
    nn, toc = fx.node_names(spark, sf_dir), fx.toc(spark)
    return ch.apply_inserts(stored, ch.change_inserts(u, SPEC), lambda names: rs.resolve_current_id(names, nn, toc), "entry_name")


@register(
    "resolve_current_id",
    S.with_fixtures(
        ["node_names", "toc"],
        "SELECT name, taxnode_id, n_matches FROM resolved",
        _resolve_sql("SELECT DISTINCT name FROM node_names"),
    ),
)
def resolve_current_id(spark, sf_dir):
    nn = fx.node_names(spark, sf_dir)
    return rs.resolve_current_id(nn.select("name"), nn, fx.toc(spark))


@register(
    "latest_release",
    S.with_fixtures(
        ["node_names", "toc"],
        "SELECT r.release_num, t.version_tag, r.n_names FROM (SELECT release_num, count(*) AS n_names FROM node_names GROUP BY release_num) r "
        "JOIN toc t ON r.release_num = t.release_num ORDER BY r.release_num DESC LIMIT 1",
    ),
)
def latest_release(spark, sf_dir):
    nn = fx.node_names(spark, sf_dir)
    rel = nn.groupBy("release_num").agg(F.count(F.lit(1)).alias("n_names")).join(fx.toc(spark), "release_num")
    return rs.latest_release(rel.select("release_num", "version_tag", "n_names"))


# ---------------------------------------------------------------- render


def _lit_sql(x: str, is_int: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN 'NULL' WHEN {is_int} THEN {x} ELSE '''' || replace({x}, '''', '''''') || '''' END)"


def _render_updates_sql() -> str:
    cond = f"(CASE WHEN old_value IS NULL THEN target || ' IS NULL' ELSE target || ' = ' || {_lit_sql('old_value', 'is_int')} END)"
    stmt = (
        f"'-- ' || rkey || ' (worksheet row ' || cast(ord AS varchar) || ')' || {NL} || 'UPDATE {SPEC.target_table}' || {NL} || 'SET' || {NL} || "
        f"string_agg('    ' || target || ' = ' || {_lit_sql('new_value', 'is_int')}, ',' || {NL} ORDER BY pos) || {NL} || "
        f"CASE WHEN count(*) = 1 THEN 'WHERE record_id = ' || cast(key_num AS varchar) || ' AND ' || min({cond}) || ';' "
        f"ELSE 'WHERE record_id = ' || cast(key_num AS varchar) || ' AND (' || {NL} || '    ' || string_agg({cond}, {NL} || '    OR ' ORDER BY pos) || {NL} || ');' END"
    )
    return c_sql(f"SELECT ord, rkey, {stmt} AS statement FROM validc GROUP BY rkey, key_num, ord, o_ord")


@register("render_updates", _render_updates_sql())
def render_updates(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return ch.render_updates(ch.update_entries(o, u, SPEC), SPEC)


def _render_inserts_sql() -> str:
    targets = [t for t, _ in SPEC.insertable]
    vals = f" || ',' || {NL} || '    ' || ".join(S.sql_literal(t, "int" if t in _INT_TARGETS else "text") for t in targets)
    cols_txt = (",\n    ").join(targets)
    stmt = (
        f"'-- Worksheet row ' || cast(ord AS varchar) || {NL} || 'INSERT INTO {SPEC.target_table} (' || {NL} || {S.q('    ' + cols_txt)} || {NL} || "
        f"') VALUES (' || {NL} || '    ' || {vals} || {NL} || ');'"
    )
    return c_sql(f"SELECT ord, {stmt} AS statement FROM ({_insert_select()})")


@register("render_inserts", _render_inserts_sql())
def render_inserts(spark, sf_dir):
    return ch.render_inserts(ch.change_inserts(r_frames(spark, sf_dir)[1], SPEC), SPEC)


def _render_deletes_sql() -> str:
    lines = f" || {NL} || ".join(
        f"{S.q('-- ' + c + ': ')} || coalesce(replace({S.norm('d_' + c)}, {NL}, ' | '), '')" for c in _DETAILS
    )
    stmt = (
        f"'-- ' || rkey || ' (worksheet row ' || cast(ord AS varchar) || ')' || {NL} || {lines} || {NL} || "
        f"'UPDATE {SPEC.target_table} SET taxnode_id=NULL, entry_name=''abolished'' ' || {NL} || 'WHERE record_id = ' || cast(key_num AS varchar) || ';'"
    )
    return c_sql(f"SELECT ord, rkey, {stmt} AS statement FROM ({_DEL_SQL})")


@register("render_deletes", _render_deletes_sql())
def render_deletes(spark, sf_dir):
    return ch.render_deletes(ch.change_deletes(r_frames(spark, sf_dir)[1], SPEC), SPEC)
