"""Catalog: key reconciliation, cell comparison and normalisers on fixture R."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import revision as rv
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.registry import register

SPEC = fx.R_SPEC
BASE_URL = "http://example.org/"


def r_frames(spark, sf_dir):
    o = fx.rev_original(spark, sf_dir)
    u = fx.rev_updated(spark, sf_dir, o)
    return rv.prepare(o, SPEC), rv.prepare(u, SPEC)


def r_keyed(spark, sf_dir):
    """Prepared frames with keyed rows only (for operators that join on the key)."""
    o = fx.rev_original(spark, sf_dir)
    u = fx.rev_updated(spark, sf_dir, o)
    return rv.prepare(o, SPEC, keyed_only=True), rv.prepare(u, SPEC, keyed_only=True)


def r_sql(body: str, extra=()) -> str:
    """Oracle with ``po`` / ``pu`` = prepared original / edited."""
    ctes = [("po", S.prepared("rev_original", SPEC)), ("pu", S.prepared("rev_updated", SPEC)), *extra]
    return S.with_fixtures(["rev_original", "rev_updated"], body, ctes)


def _unique_sql(src: str, where: str = "TRUE") -> str:
    return (
        f"SELECT * FROM {src} WHERE {where} AND rkey IN "
        f"(SELECT rkey FROM {src} WHERE rkey IS NOT NULL AND {where} GROUP BY rkey HAVING count(*) = 1)"
    )


def _changes_sql(cols, src_unique: str) -> str:
    parts = []
    for c in cols:
        k = SPEC.kind(c)
        parts.append(
            f"SELECT o.rkey, u.ord, {S.q(c)} AS \"column\", {S.norm('o.' + c)} AS old, {S.norm('u.' + c)} AS new "
            f"FROM po o JOIN ({src_unique}) u ON o.rkey = u.rkey WHERE NOT {S.values_equal('o.' + c, 'u.' + c, k)}"
        )
    return "\nUNION ALL\n".join(parts)


# ---------------------------------------------------------------- SRC-05 / FLT / SCL on R

_ALL = ", ".join(["ord", *SPEC.columns])


@register("prepare_revision", r_sql(f"SELECT {_ALL}, rkey, removed FROM pu"))
def prepare_revision(spark, sf_dir):
    return r_frames(spark, sf_dir)[1]


_CMP = list(SPEC.compared_columns)


def _summary_sql():
    n = " + ".join(f"(CASE WHEN coalesce(o.{c}, '') <> coalesce(u.{c}, '') THEN 1 ELSE 0 END)" for c in _CMP)
    txt = ", ".join(
        f"CASE WHEN coalesce(o.{c}, '') <> coalesce(u.{c}, '') THEN {S.q(c) if i == 0 else S.q(c + ':') + ' || coalesce(o.' + c + ', ' + S.q('') + ')'} END"
        for i, c in enumerate(_CMP)
    )
    return (
        f"SELECT o.ord, o.rkey, cast({n} AS bigint) AS n_changes, concat_ws(',', {txt}) AS changes, ({n}) > 0 AS changed FROM po o JOIN "
        "(SELECT * FROM pu WHERE rkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rkey ORDER BY ord) = 1) u ON o.rkey = u.rkey"
    )


@register("row_change_summary", r_sql(_summary_sql()))
def row_change_summary(spark, sf_dir):
    o, u = r_keyed(spark, sf_dir)
    return rv.row_change_summary(o, u, SPEC)


@register("keys_added", r_sql("SELECT rkey, min(ord) AS ord FROM pu WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM po WHERE rkey IS NOT NULL) GROUP BY rkey"))
def keys_added(spark, sf_dir):
    o = fx.rev_original(spark, sf_dir)
    u = fx.rev_updated(spark, sf_dir, o)
    return rv.keys_added(rv.key_frame(o, SPEC), rv.key_frame(u, SPEC))


@register("keys_missing", r_sql("SELECT rkey, min(ord) AS ord FROM po WHERE rkey IS NOT NULL AND rkey NOT IN (SELECT rkey FROM pu WHERE rkey IS NOT NULL) GROUP BY rkey"))
def keys_missing(spark, sf_dir):
    o = fx.rev_original(spark, sf_dir)
    u = fx.rev_updated(spark, sf_dir, o)
    return rv.keys_missing(rv.key_frame(o, SPEC), rv.key_frame(u, SPEC))


@register(
    "duplicate_keys",
    r_sql(
        "SELECT p.rkey, p.ord, d.n_rows, d.first_ord FROM pu p JOIN "
        "(SELECT rkey, count(*) AS n_rows, min(ord) AS first_ord FROM pu WHERE rkey IS NOT NULL GROUP BY rkey HAVING count(*) > 1) d ON p.rkey = d.rkey"
    ),
)
def duplicate_keys(spark, sf_dir):
    return rv.duplicate_keys(r_frames(spark, sf_dir)[1])


@register("blank_keys", r_sql("SELECT 'original' AS side, ord FROM po WHERE rkey IS NULL UNION ALL SELECT 'edited', ord FROM pu WHERE rkey IS NULL"))
def blank_keys(spark, sf_dir):
    """Rows without a key on both sides; the edit is the next revision's baseline."""
    o, u = (df.where(F.col(rv.KEY).isNull()) for df in r_frames(spark, sf_dir))
    return o.select(F.lit("original").alias("side"), "ord").unionByName(u.select(F.lit("edited").alias("side"), "ord"))


@register(
    "key_format",
    r_sql(
        f"SELECT 'edited' AS side, ord, id AS raw_key, rkey FROM pu WHERE rkey IS NOT NULL AND NOT regexp_matches(rkey, {S.q(SPEC.key_pattern)}) "
        f"UNION ALL SELECT 'original', ord, id, rkey FROM po WHERE rkey IS NOT NULL AND NOT regexp_matches(rkey, {S.q(SPEC.key_pattern)})"
    ),
)
def key_format(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return rv.key_format(u, SPEC).select(F.lit("edited").alias("side"), "*").unionByName(
        rv.key_format(o, SPEC).select(F.lit("original").alias("side"), "*")
    )


_UPD_COLS = [c for c, _ in SPEC.updatable]
_RO_COLS = [c for c in SPEC.read_only if c != SPEC.key]


@register("updatable_changes", r_sql(_changes_sql(_UPD_COLS, _unique_sql("pu", "NOT removed"))))
def updatable_changes(spark, sf_dir):
    o, u = r_keyed(spark, sf_dir)
    return rv.updatable_changes(o, u, SPEC)


@register(
    "read_only_changes",
    r_sql(_changes_sql(_RO_COLS, f"SELECT * FROM ({_unique_sql('pu')}) WHERE NOT removed")),
)
def read_only_changes(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return rv.read_only_changes(o, u, SPEC)


@register(
    "norm_text",
    S.with_fixtures(
        ["rev_updated"],
        f"SELECT ord, {S.norm('name')} AS name_n, {S.norm('segment')} AS segment_n, {S.norm('tokens')} AS tokens_n, {S.norm('id')} AS id_n FROM rev_updated",
    ),
)
def norm_text(spark, sf_dir):
    u = fx.rev_updated(spark, sf_dir)
    return u.select("ord", T.norm("name").alias("name_n"), T.norm("segment").alias("segment_n"), T.norm("tokens").alias("tokens_n"), T.norm("id").alias("id_n"))


@register("norm_key", S.with_fixtures(["rev_updated"], f"SELECT ord, {S.norm_key('id')} AS rkey FROM rev_updated"))
def norm_key(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.norm_key("id").alias("rkey"))


@register("norm_column_key", S.with_fixtures(["rev_updated"], f"SELECT ord, lower({S.norm('family')}) AS family_key, lower({S.norm('segment')}) AS segment_key FROM rev_updated"))
def norm_column_key(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.norm_column_key("family").alias("family_key"), T.norm_column_key("segment").alias("segment_key"))


@register("key_numeric", S.with_fixtures(["rev_updated"], f"SELECT ord, {S.key_numeric('id', SPEC.key_pattern)} AS key_num FROM rev_updated"))
def key_numeric(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.key_numeric("id", SPEC.key_pattern).alias("key_num"))


@register("int_like", S.with_fixtures(["rev_updated"], f"SELECT ord, {S.int_like('sort_minor')} AS minor_int, {S.int_like('sort_major')} AS major_int FROM rev_updated"))
def int_like(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.int_like("sort_minor").alias("minor_int"), T.int_like("sort_major").alias("major_int"))


#: Other codes than the spec's, met by the segments of fixture R.
OTHER_CODES = (("B", "BUILD"), ("M", "MACH"), ("S", "SPACE"))


@register(
    "type_code",
    S.with_fixtures(["rev_updated"], f"SELECT ord, {S.type_code('kind')} AS kind_code, {S.type_code('segment', OTHER_CODES)} AS segment_code FROM rev_updated"),
)
def type_code(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.type_code("kind").alias("kind_code"), T.type_code("segment", OTHER_CODES).alias("segment_code"))


_DATA = list(SPEC.data_columns)


@register(
    "values_equal",
    r_sql(
        "SELECT u.ord, u.rkey, "
        + ", ".join(f"{S.values_equal('o.' + c, 'u.' + c, SPEC.kind(c))} AS eq_{c}" for c in _DATA)
        + f" FROM po o JOIN ({_unique_sql('pu')}) u ON o.rkey = u.rkey"
    ),
)
def values_equal(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return rv.values_equal_flags(o, u, SPEC)


@register(
    "drop_blank_rows",
    S.with_fixtures(["rev_updated"], "SELECT ord FROM rev_updated WHERE coalesce(" + ", ".join(S.norm(c) for c in SPEC.blank_columns) + ") IS NULL"),
)
def drop_blank_rows(spark, sf_dir):
    return rv.blank_rows(fx.rev_updated(spark, sf_dir), SPEC).select("ord")


@register("removal_marked", r_sql("SELECT ord, rkey FROM pu WHERE removed"))
def removal_marked(spark, sf_dir):
    return r_frames(spark, sf_dir)[1].where(F.col(rv.REMOVED)).select("ord", rv.KEY)


@register("new_row_flag", r_sql(f"SELECT ord, (rkey IS NULL AND {S.norm('name')} IS NOT NULL) AS new_row FROM pu"))
def new_row_flag(spark, sf_dir):
    u = r_frames(spark, sf_dir)[1]
    return u.select("ord", (F.col(rv.KEY).isNull() & T.norm("name").isNotNull()).alias("new_row"))


@register(
    "first_occurrence",
    r_sql("SELECT rkey, count(*) AS n_rows, min(ord) AS ord, arg_min(name, ord) AS name FROM pu WHERE rkey IS NOT NULL GROUP BY rkey"),
)
def first_occurrence(spark, sf_dir):
    u = r_frames(spark, sf_dir)[1]
    return rv.first_rows(u, SPEC, ["name"]).select(rv.KEY, "n_rows", "ord", "name")


@register(
    "cell_changed_flags",
    r_sql(
        "SELECT u.ord, u.rkey, "
        + ", ".join(f"(coalesce(o.{c}, '') <> coalesce(u.{c}, '')) AS chg_{c}" for c in _CMP)
        + " FROM pu u JOIN (SELECT * FROM po WHERE rkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rkey ORDER BY ord) = 1) o ON o.rkey = u.rkey"
    ),
)
def cell_changed_flags(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return rv.changed_flags(o, u, SPEC)


@register(
    "delta_columns",
    r_sql(
        f"SELECT u.ord, u.rkey, CASE WHEN u.rkey IS NULL AND {S.norm('u.name')} IS NOT NULL THEN 1 ELSE s.n_changes END AS n_changes, "
        f"CASE WHEN u.rkey IS NULL AND {S.norm('u.name')} IS NOT NULL THEN 'new isolate' ELSE s.changes END AS changes "
        "FROM pu u LEFT JOIN (SELECT * FROM summ QUALIFY row_number() OVER (PARTITION BY rkey ORDER BY ord) = 1) s ON u.rkey = s.rkey",
        extra=[("summ", _summary_sql())],
    ),
)
def delta_columns(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return rv.delta_columns(o, u, SPEC)


_KIND_COLS = [("sort_minor", "int", "minor"), ("kind", "type", "type"), ("name", "text", "name"), ("node", "taxnode", "node"), ("segment", "type", "segment")]
#: A node reference for every row: written in several ways, blank, or unreadable.
_NODE_SQL = "CASE ord % 5 WHEN 0 THEN 'TX' || cast(ord AS varchar) WHEN 1 THEN ' tx' || cast(ord AS varchar) || ' ' WHEN 2 THEN 'T' || cast(ord AS varchar) WHEN 3 THEN 'TX99999999999999999999' END"


def _with_node(df):
    n, text = F.col("ord") % 5, F.col("ord").cast("string")
    node = F.when(n == 0, F.concat(F.lit("TX"), text)).when(n == 1, F.concat(F.lit(" tx"), text, F.lit(" "))).when(n == 2, F.concat(F.lit("T"), text)).when(n == 3, F.lit("TX99999999999999999999"))
    return df.withColumn("node", node)


def _codes(column):
    return {"codes": OTHER_CODES} if column == "segment" else {}


@register(
    "convert_checked",
    r_sql(
        "SELECT ord, "
        + ", ".join(f"{S.convert_checked(c, k, c, **_codes(c))[0]} AS {a}_value, {S.convert_checked(c, k, c, **_codes(c))[1]} AS {a}_error" for c, k, a in _KIND_COLS)
        + f" FROM (SELECT *, {_NODE_SQL} AS node FROM pu)"
    ),
)
def convert_checked(spark, sf_dir):
    u = _with_node(r_frames(spark, sf_dir)[1])
    cols = []
    for c, k, a in _KIND_COLS:
        conv = T.convert_checked(c, k, c, **_codes(c))
        cols += [conv["value"].alias(f"{a}_value"), conv["error"].alias(f"{a}_error")]
    return u.select("ord", *cols)


@register(
    "convert_lenient",
    r_sql("SELECT ord, " + ", ".join(f"{S.convert_lenient(c, k, **_codes(c))} AS {a}_value" for c, k, a in _KIND_COLS) + f" FROM (SELECT *, {_NODE_SQL} AS node FROM po)"),
)
def convert_lenient(spark, sf_dir):
    o = _with_node(r_frames(spark, sf_dir)[0])
    return o.select("ord", *[T.convert_lenient(c, k, **_codes(c)).alias(f"{a}_value") for c, k, a in _KIND_COLS])


@register(
    "hyperlink_build",
    S.with_fixtures(
        ["rev_updated"],
        f"SELECT ord, CASE WHEN {S.strip_ws('coalesce(id, ' + S.q('') + ')')} = '' THEN id WHEN starts_with({S.strip_ws('coalesce(id, ' + S.q('') + ')')}, '=HYPERLINK(') THEN id "
        f"ELSE '=HYPERLINK(\"{BASE_URL}' || {S.strip_ws('id')} || '\",\"' || {S.strip_ws('id')} || '\")' END AS link FROM rev_updated",
    ),
)
def hyperlink_build(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.hyperlink_build("id", BASE_URL).alias("link"))


@register(
    "id_url",
    S.with_fixtures(
        ["rev_updated"],
        f"SELECT ord, CASE WHEN {S.norm_key('id')} IS NOT NULL THEN '{BASE_URL}id/CU' || regexp_replace({S.norm_key('id')}, '^CU', '') END AS url FROM rev_updated",
    ),
)
def id_url(spark, sf_dir):
    return fx.rev_updated(spark, sf_dir).select("ord", T.id_url("id", BASE_URL + "id/", "CU").alias("url"))


@register(
    "sql_literal",
    S.with_fixtures(
        ["rev_updated"],
        f"SELECT ord, {S.sql_literal(S.norm('name'))} AS name_lit, {S.sql_literal(S.int_like('sort_minor'), 'int')} AS minor_lit, "
        f"{S.sql_condition('entry_name', S.norm('name'))} AS name_cond FROM rev_updated",
    ),
)
def sql_literal(spark, sf_dir):
    u = fx.rev_updated(spark, sf_dir)
    return u.select(
        "ord",
        T.sql_literal(T.norm("name")).alias("name_lit"),
        T.sql_literal(T.int_like("sort_minor"), "int").alias("minor_lit"),
        T.sql_condition("entry_name", T.norm("name")).alias("name_cond"),
    )


# ---------------------------------------------------------------- reconcile with an export (rev_export)

RECONCILE_KINDS = {"id": "link", "sort_major": "int", "sort_minor": "int", "kind": "type"}


def _export_prepared(spark, sf_dir, original=None):
    x = fx.rev_export(spark, sf_dir, original)
    return x.select("ord", *SPEC.columns, T.norm_key(T.hyperlink_label("id")).alias(rv.KEY))


_PX = f"SELECT ord, {', '.join(SPEC.columns)}, {S.norm_key(S.hyperlink_label('id'))} AS rkey FROM rev_export"


def x_sql(body: str) -> str:
    ctes = [("po", S.prepared("rev_original", SPEC)), ("px", _PX)]
    return S.with_fixtures(["rev_original", "rev_export"], body, ctes)


@register("hyperlink_label", S.with_fixtures(["rev_export"], f"SELECT ord, {S.hyperlink_label('id')} AS label FROM rev_export"))
def hyperlink_label(spark, sf_dir):
    return fx.rev_export(spark, sf_dir).select("ord", T.hyperlink_label("id").alias("label"))


@register(
    "norm_by_column",
    S.with_fixtures(
        ["rev_export"],
        "SELECT ord, " + ", ".join(f"{S.norm_value(c, RECONCILE_KINDS.get(c, 'text'))} AS n_{c}" for c in SPEC.columns) + " FROM rev_export",
    ),
)
def norm_by_column(spark, sf_dir):
    x = fx.rev_export(spark, sf_dir)
    return x.select("ord", *[T.norm_value(c, RECONCILE_KINDS.get(c, "text")).alias(f"n_{c}") for c in SPEC.columns])


@register("duplicate_later_rows", x_sql("SELECT rkey, ord, first_ord FROM (SELECT rkey, ord, min(ord) OVER (PARTITION BY rkey) AS first_ord FROM px WHERE rkey IS NOT NULL) WHERE ord > first_ord"))
def duplicate_later_rows(spark, sf_dir):
    return rv.duplicate_later_rows(_export_prepared(spark, sf_dir))


@register(
    "reconcile_keys",
    x_sql(
        "SELECT coalesce(o.rkey, x.rkey) AS rkey, CASE WHEN o.rkey IS NULL THEN 'export_only' WHEN x.rkey IS NULL THEN 'original_only' ELSE 'both' END AS status, "
        "o.ord AS o_ord, x.ord AS x_ord FROM (SELECT rkey, min(ord) AS ord FROM po WHERE rkey IS NOT NULL GROUP BY rkey) o "
        "FULL OUTER JOIN (SELECT rkey, min(ord) AS ord FROM px WHERE rkey IS NOT NULL GROUP BY rkey) x ON o.rkey = x.rkey"
    ),
)
def reconcile_keys(spark, sf_dir):
    from revisa.operators import reconcile

    o = r_frames(spark, sf_dir)[0]
    return reconcile.reconcile_keys(o, _export_prepared(spark, sf_dir))


_FIRST = "SELECT * FROM {} WHERE rkey IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rkey ORDER BY ord) = 1"


def _reconcile_body() -> str:
    parts = []
    for c in SPEC.columns:
        k = RECONCILE_KINDS.get(c, "text")
        a, b = S.norm_value("o." + c, k), S.norm_value("x." + c, k)
        parts.append(f"SELECT o.rkey, o.ord, {S.q(c)} AS \"column\", {a} AS original_value, {b} AS export_value FROM fo o JOIN fx x ON o.rkey = x.rkey WHERE {a} IS DISTINCT FROM {b}")
    return "\nUNION ALL\n".join(parts)


def _reconcile_cells_sql():
    ctes = [("po", S.prepared("rev_original", SPEC)), ("px", _PX), ("fo", _FIRST.format("po")), ("fx", _FIRST.format("px"))]
    return S.with_fixtures(["rev_original", "rev_export"], _reconcile_body(), ctes)


@register("reconcile_cells", _reconcile_cells_sql())
def reconcile_cells(spark, sf_dir):
    from revisa.operators import reconcile

    o = r_frames(spark, sf_dir)[0]
    return reconcile.reconcile_cells(o, _export_prepared(spark, sf_dir), SPEC, RECONCILE_KINDS)
