"""Catalog: vocabularies (fixture V, with R for the correction)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import vocab as vc
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.q_revision import SPEC, r_frames
from revisa.plans.registry import register

# Where new vocabulary values of each column are inserted.
ROUTES = [("segment", "segment_values", "segment_name"), ("kind", "kind_codes", "code,name"), ("Item", "items", "item_name")]
CONSTRAINED = ["segment", "kind"]


def routes(spark):
    return spark.createDataFrame(ROUTES, "col string, table_name string, target_columns string")


def v_sql(body: str, extra=()) -> str:
    ctes = [
        ("nv_o", f"SELECT {S.norm('col')} AS col, {S.norm('value')} AS value, ord FROM vocab_original WHERE {S.norm('value')} IS NOT NULL"),
        ("nv_u", f"SELECT {S.norm('col')} AS col, {S.norm('value')} AS value, ord FROM vocab_updated WHERE {S.norm('value')} IS NOT NULL"),
        *extra,
    ]
    return S.with_fixtures(["vocab_original", "vocab_updated"], body, ctes)


def frames(spark, sf_dir):
    return fx.vocab_original(spark, sf_dir), fx.vocab_updated(spark, sf_dir)


@register("canonical_value", v_sql(f"SELECT col, value, ord, {S.canonical_value('value')} AS canon FROM vocab_updated"))
def canonical_value(spark, sf_dir):
    return frames(spark, sf_dir)[1].select("col", "value", "ord", T.canonical_value("value").alias("canon"))


@register("value_rows", v_sql("SELECT col, value, ord FROM nv_u"))
def value_rows(spark, sf_dir):
    return vc.value_rows(frames(spark, sf_dir)[1])


@register("vocab_distinct", v_sql("SELECT DISTINCT col, value FROM nv_u"))
def vocab_distinct(spark, sf_dir):
    return vc.distinct_values(frames(spark, sf_dir)[1])


_CANON = f"SELECT col, {S.canonical_value('value')} AS canon, arg_min(value, ord) AS value FROM nv_u GROUP BY col, {S.canonical_value('value')}"


@register("vocab_canonical", v_sql(_CANON))
def vocab_canonical(spark, sf_dir):
    return vc.canonical_first(frames(spark, sf_dir)[1])


_ADDED = "SELECT col, value, ord FROM nv_u u WHERE NOT EXISTS (SELECT 1 FROM nv_o o WHERE o.col = u.col AND o.value = u.value)"
_REMOVED = "SELECT col, value, ord FROM nv_o o WHERE NOT EXISTS (SELECT 1 FROM nv_u u WHERE o.col = u.col AND o.value = u.value)"


@register("vocab_added", v_sql(_ADDED))
def vocab_added(spark, sf_dir):
    o, u = frames(spark, sf_dir)
    return vc.added(o, u)


@register("vocab_removed", v_sql(_REMOVED))
def vocab_removed(spark, sf_dir):
    o, u = frames(spark, sf_dir)
    return vc.removed(o, u)


@register(
    "vocab_not_in_reference",
    v_sql(
        "SELECT col, value, ord FROM nv_u WHERE col IN (SELECT col FROM ref) AND NOT EXISTS (SELECT 1 FROM ref r WHERE r.col = nv_u.col AND r.value = nv_u.value)",
        extra=[
            (
                "ref",
                f"SELECT DISTINCT 'segment' AS col, {S.norm('c_mktsegment')} AS value FROM customer WHERE {S.norm('c_mktsegment')} IS NOT NULL "
                "UNION ALL SELECT 'item', concat(p_name, ' ', cast(p_partkey AS string)) FROM part WHERE p_partkey % 5 <> 0",
            )
        ],
    ),
)
def vocab_not_in_reference(spark, sf_dir):
    """Reference lists: the segments of customer, and the names of most parts."""
    ref = fx.table(spark, sf_dir, "customer").select(F.lit("segment").alias("col"), F.col("c_mktsegment").alias("value"))
    name = F.concat(F.col("p_name"), F.lit(" "), F.col("p_partkey").cast("string"))
    ref = ref.unionByName(fx.table(spark, sf_dir, "part").where("p_partkey % 5 <> 0").select(F.lit("item").alias("col"), name.alias("value")))
    return vc.not_in_reference(frames(spark, sf_dir)[1], ref)


def _correct_sql() -> str:
    parts = []
    for c in CONSTRAINED:
        parts.append(f"SELECT ord, {S.q(c)} AS col, {c} AS raw FROM pu")
    cells = "\nUNION ALL\n".join(parts)
    allowed = "SELECT DISTINCT col, value FROM nv_u"
    body = (
        "SELECT x.ord, x.col AS \"column\", CASE WHEN x.v IS NOT NULL AND x.adjust THEN x.corrected ELSE x.raw END AS value, "
        "CASE WHEN x.v IS NULL THEN 'Column ''' || x.col || ''' must not be blank; select a value from ''Column Values''.' "
        "WHEN x.adjust THEN 'Column ''' || x.col || ''' value ''' || x.v || ''' adjusted to ''' || x.corrected || ''' to match ''Column Values''.' "
        "WHEN NOT x.in_list AND x.corrected IS NULL THEN 'Column ''' || x.col || ''' contains ''' || x.v || ''' which is not listed in ''Column Values''.' END AS message, "
        "CASE WHEN x.v IS NULL OR x.adjust THEN 'WARNING' WHEN NOT x.in_list AND x.corrected IS NULL THEN 'ERROR' END AS severity FROM ("
        "SELECT y.*, coalesce((y.in_list AND y.raw <> y.corrected AND y.corrected = y.v) OR (NOT y.in_list AND y.corrected IS NOT NULL), false) AS adjust FROM ("
        "SELECT c.ord, c.col, c.raw, c.v, a.value IS NOT NULL AS in_list, k.value AS corrected FROM "
        f"(SELECT ord, col, raw, {S.norm('raw')} AS v, {S.canonical_value(S.norm('raw'))} AS canon FROM cells) c "
        "LEFT JOIN allowed a ON c.col = a.col AND c.v = a.value LEFT JOIN canon k ON c.col = k.col AND c.canon = k.canon) y) x"
    )
    ctes = [
        ("nv_u", f"SELECT {S.norm('col')} AS col, {S.norm('value')} AS value, ord FROM vocab_updated WHERE {S.norm('value')} IS NOT NULL AND {S.norm('col')} IS NOT NULL"),
        ("pu", S.prepared("rev_updated", SPEC)),
        ("cells", cells),
        ("allowed", allowed),
        ("canon", _CANON),
    ]
    return S.with_fixtures(["rev_original", "rev_updated", "vocab_original", "vocab_updated"], body, ctes)


@register("vocab_correct", _correct_sql())
def vocab_correct(spark, sf_dir):
    u = r_frames(spark, sf_dir)[1]
    return vc.correct(u, frames(spark, sf_dir)[1], CONSTRAINED)


@register(
    "vocab_build",
    S.with_fixtures(
        [],
        f"SELECT 'kind' AS col, 'E' AS value, cast(1 AS bigint) AS ord UNION ALL SELECT 'kind', 'A', 2 "
        f"UNION ALL SELECT 'segment', c_mktsegment, c_custkey FROM customer WHERE {S.norm('c_mktsegment')} IS NOT NULL",
    ).replace("WITH \n", ""),
)
def vocab_build(spark, sf_dir):
    cust = fx.table(spark, sf_dir, "customer")
    return vc.build({"kind": ["E", "A"]}, [("segment", cust, "c_mktsegment", "c_custkey")], spark)


@register("sort_vocab", v_sql(f"SELECT col, value, ord, lower({S.norm('value')}) AS sort_key, row_number() OVER (ORDER BY col, lower({S.norm('value')}), ord) AS position FROM vocab_updated"))
def sort_vocab(spark, sf_dir):
    return vc.sort_vocab(frames(spark, sf_dir)[1])


@register(
    "vocab_insert_order",
    v_sql(
        "SELECT col, value, min(ord) AS first_ord, count(*) AS n_rows, lower(col) AS col_key, lower(value) AS value_key, "
        f"row_number() OVER (ORDER BY lower(col), lower(value), col, value) AS position FROM ({_ADDED}) GROUP BY col, value"
    ),
)
def vocab_insert_order(spark, sf_dir):
    return vc.insert_order(vc.per_value(vc.added(*frames(spark, sf_dir))))


_ROUTES_SQL = " UNION ALL ".join(f"SELECT {S.q(a)} AS col, {S.q(b)} AS table_name, {S.q(c)} AS target_columns" for a, b, c in ROUTES)
_ROUTED = (
    "SELECT a.col, a.value, a.ord, r.table_name, r.target_columns, CASE WHEN r.table_name IS NULL THEN 'skipped' ELSE 'insert' END AS status "
    "FROM added a LEFT JOIN routes r ON lower(a.col) = lower(r.col)"
)


@register("change_vocab_inserts", v_sql(_ROUTED, extra=[("added", _ADDED), ("routes", _ROUTES_SQL)]))
def change_vocab_inserts(spark, sf_dir):
    o, u = frames(spark, sf_dir)
    return vc.route_inserts(vc.added(o, u), routes(spark))


def _render_vocab_sql() -> str:
    nl = "chr(10)"
    lit = "'''' || replace(value, '''', '''''') || ''''"
    stmt = (
        f"'INSERT INTO ' || table_name || ' (' || {nl} || "
        f"'    ' || array_to_string(string_split(target_columns, ','), ',' || {nl} || '    ') || {nl} || ') VALUES (' || {nl} || "
        f"'    ' || array_to_string(list_transform(string_split(target_columns, ','), lambda x: {lit}), ',' || {nl} || '    ') || {nl} || ');'"
    )
    note = "'-- No database mapping configured for column ''' || col || ''' with value ''' || value || '''; skipping.'"
    return v_sql(
        "SELECT col, value, ord, '-- Column ''' || col || ''' value ''' || value || ''' from ''Column Values'' row ' || cast(ord AS varchar) AS statement FROM routed "
        f"WHERE status = 'insert' UNION ALL SELECT col, value, ord, CASE WHEN status = 'insert' THEN {stmt} ELSE {note} END FROM "
        "(SELECT col, value, table_name, target_columns, status, min(ord) AS ord FROM routed GROUP BY ALL)",
        extra=[("added", _ADDED), ("routes", _ROUTES_SQL), ("routed", _ROUTED)],
    )


@register("render_vocab_inserts", _render_vocab_sql())
def render_vocab_inserts(spark, sf_dir):
    o, u = frames(spark, sf_dir)
    return vc.render_inserts(vc.route_inserts(vc.added(o, u), routes(spark)))
