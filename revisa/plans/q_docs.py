"""Catalog: documentation checks (fixture G with R and V) and text helpers at size (T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.functions import lists as L
from revisa.functions import match as M
from revisa.operators import docs as dc
from revisa.operators import issues as iss
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.q_revision import SPEC
from revisa.plans.registry import register

DOC_MARKER = "notes"
RANGE = ("realm", "family", "name")
VALUE_HEADERS = ("kind", "segment")


def _headers(spark, sf_dir):
    cols = list(SPEC.columns)
    return fx.doc_headers(spark, sf_dir, cols[: cols.index(DOC_MARKER)], 1)


def _range_headers(spark, sf_dir):
    return fx.doc_headers(spark, sf_dir, RANGE, 4, "p_partkey % 50 = 7")


def _values(spark, sf_dir):
    return fx.doc_values(spark, sf_dir, VALUE_HEADERS)


def _strip(x):
    return S.strip_ws(x)


def _mt(x):
    return f"lower(regexp_replace({x}, '[\\t-\\r\\x1c-\\x20\\x85\\p{{Z}}\\p{{P}}]', '', 'g'))"


_LIST_TOKENS = "list_filter(list_transform(string_split({x}, ','), lambda t: " + S.strip_ws("t") + "), lambda t: t <> '')"


def _list_tokens(x):
    return _LIST_TOKENS.replace("{x}", x)


_BULLET = r"^[\t-\r\x1c-\x20\x85\p{Z}]*-[\t-\r\x1c-\x20\x85\p{Z}]*(.+?)[\t-\r\x1c-\x20\x85\p{Z}]*$"
_BREAKS = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"


def _bullets(x):
    return (
        f"list_transform(list_filter(string_split_regex({x}, '{_BREAKS}'), lambda l: regexp_matches(l, {S.q(_BULLET)})), "
        f"lambda l: {S.strip_ws(f'regexp_extract(l, {S.q(_BULLET)}, 1)')})"
    )


@register(
    "list_tokens",
    f"SELECT doc_id, cast(unnest(range(len(t))) AS bigint) AS pos, unnest(t) AS token FROM (SELECT doc_id, {_list_tokens('text')} AS t FROM documents)",
)
def list_tokens(spark, sf_dir):
    d = fx.table(spark, sf_dir, "documents")
    return d.select("doc_id", F.posexplode(L.list_tokens("text")).alias("pos", "token")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "token")


_BULLETED = "replace(replace(text, chr(10), chr(10) || ' - '), ', ', chr(10) || '- ' || chr(10))"


@register(
    "bullets",
    f"SELECT doc_id, cast(unnest(range(len(b))) AS bigint) AS pos, unnest(b) AS bullet FROM (SELECT doc_id, {_bullets(_BULLETED)} AS b FROM documents)",
)
def bullets(spark, sf_dir):
    """Documents whose later lines are items, some of them empty."""
    d = fx.table(spark, sf_dir, "documents").withColumn("text", F.replace(F.replace("text", F.lit("\n"), F.lit("\n - ")), F.lit(", "), F.lit("\n- \n")))
    return d.select("doc_id", F.posexplode(L.bullets("text")).alias("pos", "bullet")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "bullet")


#: Compatibility characters that the fixture writes, and what they are read as.  Fixed values.
COMPATIBLE = (("\ufb01", "fi"), ("\u00b2", "2"), ("\uff21", "A"), ("\u2460", "1"), ("\u212b", "\u00c5"), ("e\u0301", "\u00e9"))


def _compatible_sql() -> str:
    """Match text of documents without compatibility characters, which the fixture then only spells otherwise."""
    return f"SELECT doc_id, {_mt('text')} AS mt FROM documents"


@register("match_text", _compatible_sql())
def match_text(spark, sf_dir):
    """SCL-08 over whole documents that spell what they can in compatibility characters."""
    text = F.col("text")
    for odd, plain in COMPATIBLE:
        text = F.replace(text, F.lit(plain), F.lit(odd))
    return fx.table(spark, sf_dir, "documents").select("doc_id", M.match_text(text).alias("mt"))


_TOK_SQL = (
    "SELECT ord, col, definition, unnest(t) AS token, cast(unnest(range(len(t))) AS bigint) AS pos FROM ("
    f"SELECT ord, {_strip('coalesce(col, ' + S.q('') + ')')} AS col, {_strip('coalesce(definition, ' + S.q('') + ')')} AS definition, "
    f"{_list_tokens(_strip('coalesce(heading, ' + S.q('') + ')'))} AS t FROM defs "
    f"WHERE {_strip('coalesce(col, ' + S.q('') + ')')} <> '' OR {_strip('coalesce(heading, ' + S.q('') + ')')} <> '' OR {_strip('coalesce(definition, ' + S.q('') + ')')} <> '')"
)
_TOKS = f"SELECT *, {_mt('token')} AS mt FROM ({_TOK_SQL}) WHERE {_mt('token')} <> ''"
_SPELL = "SELECT mt, token, cast(min(ord) AS bigint) AS first_ord, cast(arg_min(pos, ord::HUGEINT * 1000000 + pos) AS bigint) AS first_pos FROM toks GROUP BY mt, token"


def g_sql(body: str, extra=()) -> str:
    return S.with_fixtures(["defs"], body, [("toks", _TOKS), ("spell", _SPELL), *extra])


@register("spellings_by_match", g_sql("SELECT * FROM spell"))
def spellings_by_match(spark, sf_dir):
    return dc.spellings(dc.heading_tokens(fx.defs(spark, sf_dir)))


_PART_HEADERS = (
    " UNION ALL SELECT cast(p_partkey + 1000 AS integer), CASE p_partkey % 4 WHEN 1 THEN upper(n) WHEN 2 THEN n || ' x' WHEN 3 THEN replace(n, ' ', '_') ELSE n END "
    "FROM (SELECT *, concat(p_name, ' ', cast(p_partkey AS string)) AS n FROM part) p"
)


def _headers_sql():
    cols = list(SPEC.columns)
    hs = cols[: cols.index(DOC_MARKER)]
    return " UNION ALL ".join(f"SELECT {i} AS pos, {S.q(h)} AS header" for i, h in enumerate(hs, start=1)) + _PART_HEADERS


_CHOOSE = (
    "SELECT h.pos, h.header, arg_min(s.token, CASE WHEN s.token = h.header THEN 0 ELSE 1 END * 1000000000000000000000::HUGEINT + s.first_ord::HUGEINT * 1000000 + s.first_pos) AS matched "
    "FROM hdr h LEFT JOIN {spell} s ON s.mt = {mt} GROUP BY h.pos, h.header"
)


def _cover_sql(missing_prefix, mapped_prefix, spell="spell"):
    choose = _CHOOSE.format(spell=spell, mt=_mt("h.header"))
    return (
        f"SELECT pos, header, matched, matched = header AS exact, CASE WHEN matched IS NULL THEN 'missing' ELSE 'mapped' END AS status, "
        f"CASE WHEN matched IS NULL THEN '{missing_prefix}''' || header || '''' ELSE '{mapped_prefix}''' || header || ''' -> ''' || matched || '''' || "
        f"CASE WHEN matched = header THEN '' ELSE '{dc.NOTE}' END END AS message FROM ({choose})"
    )


_HEADER_COV = _cover_sql("Definitions are missing documentation for header ", "Header map: ")


@register("choose_match", g_sql("SELECT pos, header, matched, matched = header AS exact FROM (" + _CHOOSE.format(spell="spell", mt=_mt("h.header")) + ")", [("hdr", _headers_sql())]))
def choose_match(spark, sf_dir):
    h = _headers(spark, sf_dir).withColumn("mt", M.match_text("header"))
    return dc.choose(h, dc.spellings(dc.heading_tokens(fx.defs(spark, sf_dir)))).select("pos", "header", "matched", "exact")


@register("doc_header_coverage", g_sql(_HEADER_COV, [("hdr", _headers_sql())]))
def doc_header_coverage(spark, sf_dir):
    return dc.header_coverage(_headers(spark, sf_dir), fx.defs(spark, sf_dir))


_RANGE_HDR = " UNION ALL ".join(f"SELECT {i} AS pos, {S.q(h)} AS header" for i, h in enumerate(RANGE, start=4)) + _PART_HEADERS + " WHERE p_partkey % 50 = 7"
_RANGE_SPELL = (
    "SELECT mt, token, cast(min(ord) AS bigint) AS first_ord, cast(arg_min(pos, ord::HUGEINT * 1000000 + pos) AS bigint) AS first_pos FROM toks "
    f"WHERE regexp_matches(col, {S.q(dc.RANGE_ROW)}) AND ord = (SELECT max(ord) FROM toks WHERE regexp_matches(col, {S.q(dc.RANGE_ROW)})) GROUP BY mt, token"
)
_RANGE_COV = _cover_sql("Grouped heading list is missing ", "Range map: ", spell="rspell")


@register("doc_range_coverage", g_sql(_RANGE_COV, [("hdr", _RANGE_HDR), ("rspell", _RANGE_SPELL)]))
def doc_range_coverage(spark, sf_dir):
    return dc.range_coverage(_range_headers(spark, sf_dir), fx.defs(spark, sf_dir))


def _value_cov_sql():
    texts = "SELECT mt, string_agg(definition, chr(10) ORDER BY ord, pos) AS defs_text FROM toks WHERE definition <> '' GROUP BY mt"
    bl = (
        f"SELECT mt, {_mt('bullet')} AS bmt, bullet, min(bpos) AS bpos FROM (SELECT mt, unnest(b) AS bullet, unnest(range(len(b))) AS bpos FROM "
        f"(SELECT mt, {_bullets('defs_text')} AS b FROM texts)) WHERE {_mt('bullet')} <> '' GROUP BY mt, {_mt('bullet')}, bullet"
    )
    nb = "SELECT t.mt, t.defs_text, coalesce((SELECT count(*) FROM bl WHERE bl.mt = t.mt), 0) AS n_bullets FROM texts t"
    vals = (
        f"SELECT header, {_strip('coalesce(value, ' + S.q('') + ')')} AS value, ord, {_mt('header')} AS mt FROM doc_values "
        f"WHERE {_strip('coalesce(value, ' + S.q('') + ')')} <> ''"
    )
    g = (
        f"SELECT v.header, v.value, v.ord, n.defs_text, coalesce(n.n_bullets, 0) AS n_bullets, {_mt('v.value')} AS vmt, "
        "arg_min(b.bullet, CASE WHEN b.bullet = v.value THEN 0 ELSE 1 END * 1000000 + b.bpos) AS matched "
        f"FROM vals v LEFT JOIN nb n ON v.mt = n.mt LEFT JOIN bl b ON b.mt = v.mt AND b.bmt = {_mt('v.value')} "
        f"WHERE {_mt('v.value')} <> '' GROUP BY v.header, v.value, v.ord, n.defs_text, n.n_bullets, {_mt('v.value')}"
    )
    status = (
        "CASE WHEN defs_text IS NULL THEN 'no_definition' WHEN n_bullets > 0 AND matched IS NOT NULL THEN 'mapped' WHEN n_bullets > 0 THEN 'missing' "
        f"WHEN instr({_mt('defs_text')}, vmt) > 0 THEN 'substring' ELSE 'missing' END"
    )
    body = (
        f"SELECT header, value, ord, matched, status, CASE WHEN status = 'no_definition' THEN 'Definitions have no text for controlled-value header ''' || header || '''' "
        "WHEN status = 'missing' THEN 'Definition for ''' || header || ''' is missing value ''' || value || '''' "
        f"WHEN status = 'mapped' THEN 'Value map [' || header || ']: ''' || value || ''' -> ''' || matched || '''' || CASE WHEN matched = value THEN '' ELSE '{dc.NOTE}' END "
        "ELSE 'Value map [' || header || ']: ''' || value || ''' -> definition text match (normalized substring)' END AS message "
        f"FROM (SELECT *, {status} AS status FROM g)"
    )
    return body, [("texts", texts), ("bl", bl), ("nb", nb), ("vals", vals), ("g", g)]


def v_g_sql(body: str, extra=()) -> str:
    vb, vctes = _value_cov_sql()
    ctes = [("toks", _TOKS), ("spell", _SPELL), *vctes, ("vcov", vb), *extra]
    return S.with_fixtures(["defs", "vocab_original", "vocab_updated", "doc_values"], body, ctes)


@register("doc_value_coverage", v_g_sql("SELECT * FROM vcov"))
def doc_value_coverage(spark, sf_dir):
    return dc.value_coverage(_values(spark, sf_dir), fx.defs(spark, sf_dir))


_DOC_CHECK = (
    "SELECT 'documentation' AS \"check\", message, 'ERROR' AS severity FROM hcov WHERE status = 'missing' "
    "UNION ALL SELECT 'documentation', message, 'ERROR' FROM rcov WHERE status = 'missing' "
    "UNION ALL SELECT 'documentation', message, 'ERROR' FROM vcov WHERE status = 'missing' "
    "UNION ALL SELECT DISTINCT 'documentation', message, 'ERROR' FROM vcov WHERE status = 'no_definition'"
)
_DOC_CTES = [("hdr", _headers_sql()), ("hcov", _HEADER_COV), ("rhdr", _RANGE_HDR), ("rspell", _RANGE_SPELL), ("rcov", _RANGE_COV.replace("FROM hdr h", "FROM rhdr h")), ("dchk", _DOC_CHECK)]


def _doc_check(spark, sf_dir):
    defs = fx.defs(spark, sf_dir)
    return dc.doc_issues(
        dc.header_coverage(_headers(spark, sf_dir), defs),
        dc.range_coverage(_range_headers(spark, sf_dir), defs),
        dc.value_coverage(_values(spark, sf_dir), defs),
    )


@register("doc_check", v_g_sql("SELECT * FROM dchk", _DOC_CTES))
def doc_check(spark, sf_dir):
    return _doc_check(spark, sf_dir)


@register("severity_policy", v_g_sql("SELECT \"check\", message, 'WARNING' AS severity FROM dchk", _DOC_CTES))
def severity_policy(spark, sf_dir):
    return iss.severity_policy(_doc_check(spark, sf_dir), keep_going=True)
