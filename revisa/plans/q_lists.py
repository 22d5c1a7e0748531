"""Catalog: list cells (fixture L) and token reuse (fixture R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.functions import lists as L
from revisa.operators import changes as ch
from revisa.operators import tokens as tk
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.q_revision import SPEC, _unique_sql, r_frames, r_sql
from revisa.plans.registry import register

LOOKUP_URL = "http://example.org/lookup/"


def l_sql(body: str) -> str:
    return S.with_fixtures(["list_pairs"], body)


@register(
    "split_segments",
    l_sql(
        f"SELECT id, {S.entries_text(S.split_segments('old_cell'))} AS old_entries, {S.entries_text(S.split_segments('new_cell'))} AS new_entries, "
        f"cast(len({S.split_segments('old_cell')}) AS bigint) AS n_old, cast(len({S.split_segments('new_cell')}) AS bigint) AS n_new FROM list_pairs"
    ),
)
def split_segments(spark, sf_dir):
    lp = fx.list_pairs(spark, sf_dir)
    o, n = L.split_segments("old_cell"), L.split_segments("new_cell")
    return lp.select(
        "id", L.entries_text(o).alias("old_entries"), L.entries_text(n).alias("new_entries"), F.size(o).cast("bigint").alias("n_old"), F.size(n).cast("bigint").alias("n_new")
    )


@register(
    "segments_canonical",
    l_sql(
        f"SELECT id, {S.entries_text(S.canonical_entries(S.split_segments('new_cell'), True))} AS canon_new, "
        f"({S.canonical_entries(S.split_segments('old_cell'), True)} = {S.canonical_entries(S.split_segments('new_cell'), True)}) AS eq_with, "
        f"({S.canonical_entries(S.split_segments('old_cell'), False)} = {S.canonical_entries(S.split_segments('new_cell'), False)}) AS eq_without FROM list_pairs"
    ),
)
def segments_canonical(spark, sf_dir):
    lp = fx.list_pairs(spark, sf_dir)
    o, n = L.split_segments("old_cell"), L.split_segments("new_cell")
    return lp.select(
        "id",
        L.entries_text(L.canonical_entries(n, True)).alias("canon_new"),
        (L.canonical_entries(o, True) == L.canonical_entries(n, True)).alias("eq_with"),
        (L.canonical_entries(o, False) == L.canonical_entries(n, False)).alias("eq_without"),
    )


@register("segment_change_class", l_sql(f"SELECT id, {S.classify_change('old_cell', 'new_cell')} AS change_class FROM list_pairs"))
def segment_change_class(spark, sf_dir):
    return L.classify_frame(fx.list_pairs(spark, sf_dir), "old_cell", "new_cell").select("id", "change_class")


@register(
    "segment_tokens",
    l_sql(f"SELECT id, cast(unnest(range(len(t))) AS bigint) AS pos, unnest(t) AS token FROM (SELECT id, {S.tokens('new_cell')} AS t FROM list_pairs)"),
)
def segment_tokens(spark, sf_dir):
    lp = fx.list_pairs(spark, sf_dir)
    return lp.select("id", F.posexplode(L.tokens("new_cell")).alias("pos", "token")).select("id", F.col("pos").cast("bigint").alias("pos"), "token")


@register(
    "token_url",
    l_sql(
        f"SELECT id, CASE WHEN len(t) > 0 THEN '{LOOKUP_URL}' || array_to_string(t, ',') END AS url FROM "
        f"(SELECT id, list_filter(list_transform({S.split_segments('new_cell')}, lambda e: replace(e.token, ' ', '')), lambda x: x <> '') AS t FROM list_pairs)"
    ),
)
def token_url(spark, sf_dir):
    return fx.list_pairs(spark, sf_dir).select("id", L.token_url("new_cell", LOOKUP_URL).alias("url"))


# ---------------------------------------------------------------- on fixture R

LIST = SPEC.list_column


@register(
    "segment_change_issues",
    r_sql(
        f"SELECT rkey, ord, change_class, 'List column ''{LIST}'' changed from ''' || coalesce({S.norm('o_t')}, '') || ''' to ''' || coalesce({S.norm('u_t')}, '') "
        f"|| ''' for key ' || rkey || '.' AS message, 'WARNING' AS severity FROM (SELECT o.rkey, u.ord, o.{LIST} AS o_t, u.{LIST} AS u_t, "
        f"{S.classify_change('o.' + LIST, 'u.' + LIST)} AS change_class FROM po o JOIN ({_unique_sql('pu', 'NOT removed')}) u ON o.rkey = u.rkey "
        f"WHERE NOT {S.values_equal('o.' + LIST, 'u.' + LIST, 'text')}) WHERE change_class = 'meaningful'"
    ),
)
def q_segment_change_issues(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    return ch.list_change_issues(o, u, SPEC)


_TOK = S.tokens(LIST)
_EXISTING = f"SELECT token, min(ord) AS holder FROM (SELECT ord, unnest(list_distinct({_TOK})) AS token FROM pu WHERE rkey IS NOT NULL AND NOT removed) GROUP BY token"
_NEWT = f"SELECT ord, unnest(list_distinct({_TOK})) AS token FROM pu WHERE rkey IS NULL AND NOT removed"
_REUSE_EXISTING = (
    "SELECT n.ord, string_agg(n.token || ' (row ' || cast(e.holder AS varchar) || ')', ', ' ORDER BY n.token) AS reused, count(*) AS n_reused "
    "FROM newt n JOIN existing e ON n.token = e.token GROUP BY n.ord"
)


@register("token_reuse_existing", r_sql(_REUSE_EXISTING, extra=[("existing", _EXISTING), ("newt", _NEWT)]))
def token_reuse_existing(spark, sf_dir):
    return tk.reuse_existing(r_frames(spark, sf_dir)[1], SPEC)


_CAND = (
    f"SELECT ord, list_distinct({_TOK}) AS toks, row_number() OVER (ORDER BY ord) AS rn FROM pu "
    "WHERE rkey IS NULL AND NOT removed AND ord NOT IN (SELECT ord FROM reuse_ex)"
)
_WALK = (
    "SELECT 0 AS rn, cast(NULL AS bigint) AS ord, []::VARCHAR[] AS seen_tok, []::BIGINT[] AS seen_ord, cast(NULL AS varchar) AS status, cast(NULL AS varchar) AS reused "
    "UNION ALL SELECT c.rn, c.ord, "
    "CASE WHEN len(list_filter(c.toks, lambda x: list_contains(w.seen_tok, x))) > 0 THEN w.seen_tok ELSE list_concat(w.seen_tok, c.toks) END, "
    "CASE WHEN len(list_filter(c.toks, lambda x: list_contains(w.seen_tok, x))) > 0 THEN w.seen_ord ELSE list_concat(w.seen_ord, list_transform(c.toks, lambda x: c.ord)) END, "
    "CASE WHEN len(list_filter(c.toks, lambda x: list_contains(w.seen_tok, x))) > 0 THEN 'rejected' ELSE 'accepted' END, "
    "CASE WHEN len(list_filter(c.toks, lambda x: list_contains(w.seen_tok, x))) > 0 THEN array_to_string(list_transform(list_sort(list_filter(c.toks, lambda x: list_contains(w.seen_tok, x))), "
    "lambda x: x || ' (row ' || cast(w.seen_ord[list_position(w.seen_tok, x)] AS varchar) || ')'), ', ') END "
    "FROM walk w JOIN cand c ON c.rn = w.rn + 1"
)


def _reuse_new_sql() -> str:
    body = "SELECT ord, status, reused FROM walk WHERE rn > 0"
    sql = r_sql(body, extra=[("existing", _EXISTING), ("newt", _NEWT), ("reuse_ex", _REUSE_EXISTING), ("cand", _CAND), ("walk", _WALK)])
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@register("token_reuse_new", _reuse_new_sql())
def token_reuse_new(spark, sf_dir):
    return tk.reuse_new(r_frames(spark, sf_dir)[1], SPEC)
