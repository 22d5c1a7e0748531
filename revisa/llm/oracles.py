"""DuckDB SQL of the queries that SQL can express."""

WS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: CRC-32 of a string's UTF-8 bytes: the table of the reflected polynomial, then one step a byte.
CRC = """
CREATE_CRC AS (SELECT list(v ORDER BY i) AS t FROM (
  SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i)))"""


def crc(of: str) -> str:
    """SQL of the unsigned CRC-32 of a string expression; ``t`` is the table's column."""
    octets = f"list_transform(range(strlen({of})), lambda i: ('0x' || substr(hex(encode({of})), (2 * i + 1)::INT, 2))::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"


def merkle(fan: int = 16, levels: int = 8) -> str:
    """SQL of the Merkle manifest for trees of up to ``levels`` levels, unrolled; a level leaves a tree of one node alone."""
    fixed = ", ".join(f"{_field(c)} AS {c}_" for c in ("doc_id", "source", "lang", "n_chars"))
    leaf = "sha256(doc_id_ || source_ || lang_ || n_chars_ || {})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        CRC.replace("CREATE_CRC", "crc").strip(),
        f"f AS (SELECT *, {fixed} FROM documents, crc)",
        f"l AS (SELECT doc_id, source, {leaf.format(_field('text'))} AS leaf, CASE WHEN {crc('doc_id::VARCHAR')} % 5 = 0 THEN {leaf.format(_field(lower))} END AS tampered FROM f)",
        "r AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p0 FROM l)",
        "s0 AS (SELECT source AS g, p0 AS p, leaf AS h FROM r)",
    ]

    def grow(tree: str) -> None:
        for k in range(levels):
            parts.append(
                f"{tree}{k + 1} AS (SELECT g, CASE WHEN n > 1 THEN p // {fan} ELSE p END AS p, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY p)) ELSE any_value(h) END AS h "
                f"FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n, p AS q FROM {tree}{k}) GROUP BY g, CASE WHEN n > 1 THEN p // {fan} ELSE p END)"
            )
            # what stands before and behind a node in its run
            parts.append(
                f"{tree}w{k} AS (SELECT g, p, n > 1 AS more, CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY g, p // {fan} ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') ELSE '' END AS b, "
                f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY g, p // {fan} ORDER BY p ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') ELSE '' END AS a "
                f"FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {tree}{k}))"
            )

    grow("s")
    parts.append(f"t0 AS (SELECT 0 AS g, row_number() OVER (ORDER BY g IS NOT NULL, encode(g)) - 1 AS p, h, g AS source FROM s{levels})")
    grow("t")
    parts.append(f"u0 AS (SELECT r.id, r.doc_id, r.source, leaf, t0.h AS subroot, t0.p AS q, (SELECT h FROM t{levels}) AS root, r.p0 AS p, coalesce(tampered, leaf) AS f, '' AS way FROM r JOIN t0 ON r.source IS NOT DISTINCT FROM t0.source)")
    step = "CASE WHEN more THEN sha256(b || f || a) ELSE f END AS f, way || b || a AS way"
    for k in range(levels):
        parts.append(f"u{k + 1} AS (SELECT id, doc_id, source, leaf, subroot, q, root, CASE WHEN more THEN u.p // {fan} ELSE u.p END AS p, {step} FROM u{k} u JOIN sw{k} w ON u.source IS NOT DISTINCT FROM w.g AND u.p = w.p)")
    parts.append(f"v0 AS (SELECT id, doc_id, leaf, subroot, root, q AS p, f, way FROM u{levels})")
    for k in range(levels):
        parts.append(f"v{k + 1} AS (SELECT id, doc_id, leaf, subroot, root, CASE WHEN more THEN v.p // {fan} ELSE v.p END AS p, {step} FROM v{k} v JOIN tw{k} w ON v.p = w.p)")
    return "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, subroot, root, sha256(way) AS proof_sha256, f AS folded_root, f = root AS verified FROM v{levels}"


ORACLES = {
    "op12_merkle_manifest": merkle(levels=6),
    # near words by what is left when one code point is taken out
    "op11_spelling_variants": f"""
WITH RECURSIVE {CRC.replace("CREATE_CRC", "crc").strip()},
x AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
y AS (SELECT doc_id, run, count(*) AS k FROM x WHERE length(run) >= 6 GROUP BY doc_id, run),
z AS (SELECT run, k, {crc("(coalesce(doc_id::VARCHAR, '') || ':' || run)")} AS h FROM y, crc),
c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, k FROM z),
w AS (SELECT word, sum(k)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
d AS (SELECT word, n, i, substr(word, 1, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, d.n, w.word, w.n FROM d JOIN w ON w.word = d.rest
  UNION SELECT w.word, w.n, d.word, d.n FROM d JOIN w ON w.word = d.rest),
best AS (SELECT word, n, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS other, max(m) AS m FROM pairs GROUP BY word, n),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 5 * w.n THEN other END AS form, CASE WHEN m >= 5 * w.n THEN m END AS form_n FROM w LEFT JOIN best USING (word)),
path AS (SELECT word, word AS here, 0 AS depth FROM f UNION ALL SELECT path.word, f.form, depth + 1 FROM path JOIN f ON f.word = path.here WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(here, depth) AS root FROM path GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM f JOIN ends USING (word)
""",
    "op5_line_dedup": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS pos, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, pos, line, translate(trim(line, {WS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, coalesce(f.first < k.doc_id, false) AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op9_mixing": """
WITH RECURSIVE s AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS u
  FROM documents),
p AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         ([3.0, 1.0, 2.0])[1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS w
  FROM s GROUP BY source),
-- clamped water-filling: sources by cap over weight; those below the level are clamped
o AS (
  SELECT *, 2.0 * source_size AS cap,
         coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source_size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
         sum(w) OVER (ORDER BY 2.0 * source_size / w, source_size ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
         1.5 * (SELECT sum(source_size) FROM p) AS total
  FROM p),
lv AS (SELECT max((total - below) / rest) FILTER ((total - below) / rest <= cap / w) AS level FROM o),
t AS (SELECT source, source_size, least(cap, w * coalesce(level, cap / w)) AS target FROM o, lv),
q AS (
  SELECT s.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(round(target) / t.source_size)::BIGINT ELSE 0 END AS whole,
         sum(size) OVER (PARTITION BY s.source ORDER BY u ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (whole * size + least(size, greatest(0, round(target)::BIGINT - whole * source_size - before)))::BIGINT AS taken
FROM q
""",
    # base32 of the SHA-1: 32 groups of 5 bits, each taken from two neighbouring hexadecimal digits
    "op1_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html FROM pages),
h AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS x FROM p),
b AS (SELECT *, array_to_string([lpad(bin(('0x' || c)::INT), 4, '0') for c in string_split(x, '')], '') AS bits FROM h),
d AS (SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * (substr(bits, (1 + 5 * i)::INT, 1))::INT + 8 * (substr(bits, (2 + 5 * i)::INT, 1))::INT + 4 * (substr(bits, (3 + 5 * i)::INT, 1))::INT
          + 2 * (substr(bits, (4 + 5 * i)::INT, 1))::INT + (substr(bits, (5 + 5 * i)::INT, 1))::INT, 1) for i in range(32)], '') AS payload_digest FROM b),
m AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS top FROM d),
u AS (SELECT *, regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '', 's') AS rest FROM m),
k AS (SELECT *, CASE WHEN strpos(rest, '/') = 0 THEN rest ELSE substr(rest, 1, strpos(rest, '/') - 1) END AS host FROM u)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id < top THEN top END AS refers_to,
       CASE WHEN url IS NULL OR url = '' THEN '-'
            ELSE array_to_string(list_reverse(string_split(lower(regexp_replace(regexp_replace(host, '^.*@', ''), ':.*$', '')), '.')), ',') || ')' || substr(rest, length(host) + 1) END AS url_key
FROM k
""",
    "op3_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + 8 + 8 + 7 AS n FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op8_decontamination": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS g
      FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM q),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
x AS (SELECT p.doc_id, p.s, p.n, q.item_id FROM p JOIN q ON q.n = p.n AND q.g = array_to_string(p.w[p.s:p.s + p.n - 1], ' ')),
hits AS (SELECT doc_id, count(DISTINCT wd) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS wd FROM x) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY encode(i)) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM x) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
""",
}
