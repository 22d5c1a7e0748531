"""DuckDB SQL building blocks for the correctness oracles.

Only the base tables are registered on the oracle side, so every oracle starts with
the fixture views as CTEs (same shapes as :mod:`revisa.plans.fixtures`), followed by
plain SQL for the operator.  The helpers below are the SQL spelling of the Column
functions in :mod:`revisa.functions.text`.
"""

from __future__ import annotations

# The fixture views, in dependency order.
FIXTURE_SQL = {
    "rev_original": """
SELECT c_custkey + 2 AS ord, concat('CU', cast(c_custkey AS string)) AS id,
  cast(c_nationkey AS string) AS sort_major, cast(c_custkey % 100 AS string) AS sort_minor,
  r_name AS realm, n_name AS family, c_name AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'E' ELSE 'A' END AS kind,
  concat('S1: T', cast(c_custkey AS string), '; S2: T', cast(c_custkey + 1000000 AS string)) AS tokens,
  c_mktsegment AS segment, cast(cast(c_acctbal AS decimal(18,2)) AS string) AS balance,
  cast(NULL AS string) AS notes
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "rev_updated": """
SELECT ord, CASE WHEN k % 83 = 4 THEN concat('CU', cast(k + 50000000 AS string)) WHEN k % 89 = 5 THEN concat('XX', id) WHEN k % 11 = 1 THEN concat(' ', lower(id), ' ') ELSE id END AS id,
  CASE WHEN k % 41 = 7 THEN ' Abolish' ELSE sort_major END AS sort_major,
  CASE WHEN k % 67 = 14 THEN concat(sort_minor, '.0') WHEN k % 71 = 15 THEN 'x7' ELSE sort_minor END AS sort_minor,
  realm, CASE WHEN k % 31 = 5 THEN 'NATION_X' ELSE family END AS family,
  CASE WHEN k % 29 = 4 THEN concat(name, ' rev') WHEN k % 37 = 5 THEN concat(name, chr(160)) ELSE name END AS name,
  CASE WHEN k % 73 = 16 THEN 'exemplar' WHEN k % 79 = 17 THEN 'zzz' ELSE kind END AS kind,
  CASE WHEN k % 43 = 10 THEN replace(tokens, 'S1:', 'SEG1:') WHEN k % 53 = 11 THEN replace(tokens, '; ', concat(';', chr(10), '  ')) WHEN k % 59 = 12 THEN replace(tokens, 'T', 'U') WHEN k % 61 = 13 THEN NULL ELSE tokens END AS tokens,
  CASE WHEN k % 17 = 1 THEN lower(segment) WHEN k % 19 = 2 THEN 'SPACE TOOLS' WHEN k % 23 = 3 THEN concat(' ', segment, ' ') WHEN k % 47 = 8 THEN ' ' ELSE segment END AS segment,
  balance, CASE WHEN k % 21 = 0 THEN 'checked' ELSE notes END AS notes
FROM (SELECT ord - 2 AS k, * FROM rev_original) o WHERE k % 13 <> 0
UNION ALL
SELECT ord + 5000000, id, sort_major, sort_minor, realm, family, name, kind, tokens, segment, balance, notes FROM rev_original WHERE (ord - 2) % 97 = 7
UNION ALL
SELECT ord + 6000000, CAST(NULL AS string), sort_major, '1', realm, family, concat('New ', name), kind,
  concat('N', cast(i AS string), CASE WHEN i % 6 = 5 THEN ';Z' ELSE ';N' END, cast(i + 1 AS string), CASE WHEN i % 5 = 4 THEN concat(';t', cast(k AS string)) ELSE '' END), segment, balance, notes
FROM (SELECT ord - 2 AS k, cast(floor((ord - 2 - 6) / 37) AS bigint) AS i, * FROM rev_original WHERE (ord - 2) % 37 = 6) n
UNION ALL
SELECT ord + 7000000, ' ', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'only a note' FROM rev_original WHERE (ord - 2) % 211 = 9""",
    "rev_export": """
SELECT ord, concat('=HYPERLINK("http://example.org/', id, '","', id, '")') AS id, sort_major, concat(sort_minor, '.0') AS sort_minor, realm, family, name,
  CASE WHEN kind = 'E' THEN 'Exemplar' ELSE 'Additional' END AS kind, tokens, segment,
  CASE WHEN (ord - 2) % 103 = 4 THEN '0.00' ELSE balance END AS balance, notes FROM rev_original WHERE (ord - 2) % 101 <> 3
UNION ALL
SELECT ord + 5000000, id, sort_major, sort_minor, realm, family, name, kind, tokens, segment, balance, notes FROM rev_original WHERE (ord - 2) % 107 = 6
UNION ALL
SELECT ord + 6000000, concat('CU', cast(ord + 60000000 AS string)), sort_major, sort_minor, realm, family, name, kind, tokens, segment, balance, notes FROM rev_original WHERE (ord - 2) % 109 = 8""",
    "vocab_original": """
SELECT 'segment' AS col, v AS value, cast(row_number() OVER (ORDER BY v) + 1 AS bigint) AS ord FROM (SELECT DISTINCT c_mktsegment AS v FROM customer) s
UNION ALL SELECT 'kind', 'E', 2 UNION ALL SELECT 'kind', 'A', 3
UNION ALL SELECT 'item', concat(p_name, ' ', cast(p_partkey AS string)), p_partkey + 100 FROM part WHERE p_partkey % 13 <> 0""",
    "vocab_updated": """
SELECT col, CASE WHEN col = 'item' AND (ord - 100) % 11 = 5 THEN upper(value) ELSE value END AS value, ord FROM vocab_original
WHERE value <> 'MACHINERY' AND NOT (col = 'item' AND (ord - 100) % 17 = 0)
UNION ALL SELECT 'item', concat(' ', replace(concat(p_name, ' ', cast(p_partkey AS string)), ' ', '-'), ' '), p_partkey + first
FROM part, (SELECT 500000 AS first, 13 AS step UNION ALL SELECT 900000, 26) f WHERE p_partkey % f.step = 0
UNION ALL SELECT 'segment', 'Space-Tools', 20 UNION ALL SELECT 'segment', 'auto mobile', 21 UNION ALL SELECT 'segment', ' GARDEN ', 22 UNION ALL SELECT 'segment', 'GARDEN', 23 UNION ALL SELECT 'size', 'S', 2""",
    "mask_rules": """
SELECT 'part' AS table_name, 'p_type' AS col, 'ECO%' AS pattern UNION ALL SELECT 'part', 'p_brand', 'Brand#_3' UNION ALL SELECT 'orders', 'o_orderstatus', 'F'""",
    "list_pairs": """
SELECT o_orderkey AS id, old_cell,
  CASE WHEN o_orderkey % 7 = 1 THEN replace(old_cell, '; ', chr(10)) WHEN o_orderkey % 7 = 2 THEN lower(old_cell) WHEN o_orderkey % 7 = 3 THEN replace(old_cell, 'L1:', 'A:') WHEN o_orderkey % 7 = 4 THEN old_cell || '; P0' WHEN o_orderkey % 7 = 5 THEN ';' ELSE old_cell END AS new_cell
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 11 = 1 THEN ' ; ' ELSE concat('L1: P', cast(o_custkey AS string), '; L2: P', cast(o_custkey + 1 AS string), ':x;:y;z:') END AS old_cell FROM orders) t""",
    "node_names": """
SELECT rel * 100000 + p_partkey AS taxnode_id, rel AS release_num, p_partkey AS stable_id,
  concat(p_name, ' ', cast(CASE WHEN rel < 3 THEN p_partkey ELSE p_partkey % 150 END AS string)) AS name
FROM part CROSS JOIN (SELECT 1 AS rel UNION ALL SELECT 2 UNION ALL SELECT 3) r WHERE NOT (rel = 3 AND p_partkey % 10 = 0)
UNION ALL SELECT 900000000 + p_partkey, 3, p_partkey, concat(p_name, ' alt ', cast(p_partkey AS string)) FROM part WHERE p_partkey % 7 = 3""",
    "rev_named": """
SELECT u.ord, u.id, sort_major, sort_minor, realm, family,
  CASE WHEN NOT is_new THEN u.name WHEN k % 31 = 3 THEN NULL WHEN k % 31 = 4 THEN 'abolished' ELSE concat(p_name, ' ', cast(p_partkey AS string)) END AS name,
  kind, tokens, segment, balance, notes
FROM (SELECT *, ord - 6000002 AS k, id IS NULL AND coalesce(name LIKE 'New %', false) AS is_new FROM rev_updated) u LEFT JOIN part ON u.is_new AND p_partkey = u.k % 200""",
    "rev_doubled": """
SELECT * FROM rev_original
UNION ALL SELECT ord + 8000000, id, sort_major, '77', realm, family, concat(name, ' b'), kind, tokens, segment, balance, notes FROM rev_original WHERE (ord - 2) % 7 = 1
UNION ALL SELECT ord + 9000000, id, sort_major, sort_minor, realm, family, name, kind, tokens, NULL, balance, 'third' FROM rev_original WHERE (ord - 2) % 21 = 1""",
    "doc_values": """
SELECT col AS header, value, ord FROM vocab_updated WHERE col IN ('kind', 'segment')
UNION ALL SELECT concat(p_name, ' ', cast(p_partkey AS string), CASE WHEN p_partkey % 11 = 10 THEN ' gone' ELSE '' END),
  CASE p_partkey % 5 WHEN 0 THEN lower(p_type) WHEN 1 THEN p_brand WHEN 2 THEN 'zzz' ELSE p_type END, p_partkey + 100 FROM part""",
    "toc": """
SELECT 1 AS release_num, 'v1' AS version_tag UNION ALL SELECT 2, 'v1' UNION ALL SELECT 3, 'v2'""",
    "grid_old": """
SELECT 'part' AS sheet, p_partkey + 2 AS row, c.col AS col, CASE c.col WHEN 1 THEN p_name WHEN 2 THEN p_brand ELSE cast(p_size AS string) END AS value FROM part CROSS JOIN (SELECT 1 AS col UNION ALL SELECT 2 UNION ALL SELECT 3) c
UNION ALL SELECT 'region', r_regionkey + 2, 1, r_name FROM region""",
    "grid_new": """
SELECT sheet, row, col, CASE WHEN row % 17 = 0 AND col = 1 THEN replace(value, ' ', chr(160)) WHEN row % 19 = 0 AND col = 2 THEN 'ignore this' WHEN row % 23 = 0 THEN concat(value, '!') WHEN row % 29 = 0 AND col = 3 THEN NULL ELSE value END AS value FROM grid_old WHERE sheet = 'part'
UNION ALL SELECT 'nation', n_nationkey + 2, 1, n_name FROM nation""",
    "defs": """
SELECT 2 AS ord, 'A' AS col, 'sort_major' AS heading, 'first sort' AS definition UNION ALL SELECT 3, 'D - R', 'Realm, fam-ily', 'ranks' UNION ALL SELECT 4, 'S', 'name', 'text'
UNION ALL SELECT 5, 'T', 'kind', concat('Type:', chr(10), ' - E', chr(10), '- a ', chr(10), '-', chr(10), 'x') UNION ALL SELECT 6, 'U', 'Segment', 'one of BUILDING, FURNITURE, machinery' UNION ALL SELECT 7, 'W', 'id', 'key'
UNION ALL SELECT p_partkey + 100, CASE WHEN p_partkey % 50 = 7 THEN 'D - R' ELSE 'P' END,
  CASE p_partkey % 3 WHEN 0 THEN concat(upper(n), ', ', n) WHEN 1 THEN replace(n, ' ', '-') ELSE n END,
  CASE WHEN p_partkey % 4 = 0 THEN concat('any ', p_type) ELSE concat('Kind:', chr(10), ' - ', p_type, chr(10), '-', p_brand, ' ') END
FROM (SELECT *, concat(p_name, ' ', cast(p_partkey AS string)) AS n FROM part) p""",
    "big_original": """
SELECT o_orderkey + 2 AS ord, concat('CU', cast(o_orderkey AS string)) AS id, cast(o_custkey AS string) AS owner, o_orderstatus AS status,
  o_orderpriority AS priority, cast(cast(o_totalprice AS decimal(18,2)) AS string) AS price, cast(cast(o_orderdate AS date) AS string) AS day FROM orders""",
    "big_updated": """
SELECT ord, CASE WHEN ord % 997 = 3 THEN NULL ELSE id END AS id, owner, CASE WHEN ord % 13 = 0 THEN lower(status) ELSE status END AS status,
  CASE WHEN ord % 17 = 0 THEN replace(priority, '-', ' - ') ELSE priority END AS priority, CASE WHEN ord % 19 = 0 THEN '0.00' ELSE price END AS price, day
FROM big_original WHERE ord % 23 <> 0""",
}

FIXTURE_DEPS = {
    "rev_updated": ["rev_original"],
    "rev_export": ["rev_original"],
    "rev_named": ["rev_updated"],
    "rev_doubled": ["rev_original"],
    "doc_values": ["vocab_updated"],
    "vocab_updated": ["vocab_original"],
    "grid_new": ["grid_old"],
    "big_updated": ["big_original"],
}

WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
SPACE_LIKE = r"[\t-\r\x1c-\x20\x85\p{Z}\x{00A0}\x{2007}\x{202F}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]"


def with_fixtures(names, body: str, extra_ctes=()) -> str:
    """Prefix ``body`` with the fixture CTEs it needs (and their dependencies)."""
    order: list[str] = []

    def add(n):
        for d in FIXTURE_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = [f"{n} AS ({FIXTURE_SQL[n]}\n)" for n in order] + [f"{n} AS ({q}\n)" for n, q in extra_ctes]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def norm(x: str) -> str:
    return f"nullif({strip_ws(x)}, '')"


def norm_key(x: str) -> str:
    return f"upper({norm(x)})"


def key_numeric(x: str, pattern: str) -> str:
    k = norm_key(x)
    return f"(CASE WHEN regexp_full_match(coalesce({k}, ''), {q(pattern.lstrip('^').rstrip('$'))}) THEN try_cast(regexp_extract({k}, {q(pattern)}, 1) AS bigint) END)"


NUMBER_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def int_like(x: str) -> str:
    t = strip_ws(f"cast({x} AS varchar)")
    d = f"try_cast({t} AS double)"
    return f"(CASE WHEN regexp_matches({t}, {q(NUMBER_TEXT)}) AND {d} % 1 = 0 THEN try_cast({d} AS bigint) END)"


TYPE_CODES = (("E", "EXEM"), ("A", "ADD"))


def type_code(x: str, codes=TYPE_CODES) -> str:
    u = f"upper({norm(x)})"
    exact = " ".join(f"WHEN {u} = {q(c)} THEN {q(c)}" for c, _ in codes)
    begun = " ".join(f"WHEN starts_with({u}, {q(p)}) THEN {q(c)}" for c, p in codes)
    return f"(CASE {exact} {begun} END)"


def taxnode(x: str) -> str:
    u = f"upper({norm(x)})"
    return f"(CASE WHEN regexp_full_match({u}, 'TX(\\d+)') THEN cast(try_cast(regexp_extract({u}, '^TX(\\d+)$', 1) AS bigint) AS varchar) END)"


HYPERLINK = r'^=HYPERLINK\(".*?","(.*)"\)$'


def hyperlink_label(x: str) -> str:
    t = norm(x)
    return f"(CASE WHEN regexp_matches({t}, {q(HYPERLINK)}, 'i') THEN {norm(f'regexp_extract({t}, {q(HYPERLINK)}, 1, {q(chr(105))})')} ELSE {t} END)"


def norm_value(x: str, kind: str, fallback: bool = True) -> str:
    if kind == "type":
        v = type_code(x)
    elif kind == "int":
        v = f"cast({int_like(x)} AS varchar)"
    elif kind == "link":
        return hyperlink_label(x)
    else:
        return norm(x)
    return f"coalesce({v}, {norm(x)})" if fallback else v


def values_equal(a: str, b: str, kind: str, fallback: bool = True) -> str:
    return f"({norm_value(a, kind, fallback)} IS NOT DISTINCT FROM {norm_value(b, kind, fallback)})"


def canonical_value(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def removal_marked(x: str, marker: str = "abolish") -> str:
    return f"coalesce(lower({norm(x)}) = {q(marker)}, false)"


def sql_literal(x: str, kind: str = "text") -> str:
    if kind in ("int", "taxnode"):
        return f"(CASE WHEN {x} IS NULL THEN 'NULL' ELSE cast({x} AS varchar) END)"
    return f"(CASE WHEN {x} IS NULL THEN 'NULL' ELSE '''' || replace(cast({x} AS varchar), '''', '''''') || '''' END)"


def sql_condition(target: str, x: str, kind: str = "text") -> str:
    return f"(CASE WHEN {x} IS NULL THEN {q(target + ' IS NULL')} ELSE {q(target + ' = ')} || {sql_literal(x, kind)} END)"


def convert_checked(x: str, kind: str, column: str, codes=TYPE_CODES) -> tuple[str, str]:
    """(value, error) SQL for a new value."""
    t = norm(x)
    if kind == "int":
        v = f"cast({int_like(x)} AS varchar)"
        e = f"(CASE WHEN {t} IS NOT NULL AND {v} IS NULL THEN {q(f'Column {q(column)} must contain an integer value.')} END)"
    elif kind == "type":
        v = type_code(x, codes)
        allowed = " or ".join(q(c) for c, _ in codes)
        e = f"(CASE WHEN {t} IS NOT NULL AND {v} IS NULL THEN {q(f'Column {q(column)} must contain {allowed}.')} END)"
    elif kind == "taxnode":
        v = taxnode(x)
        e = f"(CASE WHEN {t} IS NOT NULL AND {v} IS NULL THEN {q(f'Column {q(column)} must resemble TX######## to derive taxnode_id.')} END)"
    else:
        v = t
        e = "cast(NULL AS varchar)"
    return v, e


def convert_lenient(x: str, kind: str, codes=TYPE_CODES) -> str:
    if kind == "int":
        return f"cast({int_like(x)} AS varchar)"
    if kind == "type":
        return type_code(x, codes)
    if kind == "taxnode":
        return taxnode(x)
    return norm(x)


def prepared(view: str, spec, alias: str | None = None) -> str:
    """SQL of :func:`revisa.operators.revision.prepare` over a fixture view."""
    cols = ", ".join([spec.ordinal, *spec.columns])
    not_blank = "coalesce(" + ", ".join(norm(c) for c in spec.blank_columns) + ") IS NOT NULL"
    removed = removal_marked(spec.removal_column, spec.removal_marker) if spec.removal_column else "false"
    return f"SELECT {cols}, {norm_key(spec.key)} AS rkey, {removed} AS removed FROM {view} WHERE {not_blank}"


ENTRY_T = "STRUCT(segment VARCHAR, token VARCHAR)[]"


def split_segments(x: str) -> str:
    parts = f"list_filter(list_transform(string_split_regex({norm(x)}, '[;\\n]+'), lambda f: {strip_ws('f')}), lambda p: p <> '')"
    entry = (
        "lambda p: {'segment': CASE WHEN instr(p, ':') > 0 THEN " + norm("split_part(p, ':', 1)") + " END, "
        "'token': CASE WHEN instr(p, ':') > 0 THEN " + strip_ws("substr(p, instr(p, ':') + 1)") + " ELSE p END}"
    )
    return f"coalesce(list_filter(list_transform({parts}, {entry}), lambda e: e.token <> ''), []::{ENTRY_T})"


def canonical_entries(e: str, with_segment: bool) -> str:
    seg = "upper(coalesce(x.segment, ''))" if with_segment else "''"
    return f"list_transform({e}, lambda x: {{'segment': {seg}, 'token': upper(x.token)}})"


def classify_change(old: str, new: str) -> str:
    o, u = split_segments(old), split_segments(new)
    return (
        f"(CASE WHEN len({o}) = 0 AND len({u}) = 0 THEN 'whitespace' WHEN len({o}) = 0 AND {norm(old)} IS NULL THEN 'was_empty' "
        f"WHEN len({u}) = 0 THEN 'meaningful' WHEN {canonical_entries(o, True)} = {canonical_entries(u, True)} THEN 'whitespace' "
        f"WHEN {canonical_entries(o, False)} = {canonical_entries(u, False)} THEN 'segment_name' ELSE 'meaningful' END)"
    )


def entries_text(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda x: coalesce(x.segment, '') || '|' || x.token), ';')"


def tokens(x: str) -> str:
    return f"list_transform({split_segments(x)}, lambda e: upper(e.token))"
