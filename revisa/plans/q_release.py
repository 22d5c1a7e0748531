"""Catalog: release building, sinks, snapshots and sources (fixtures R, N, T)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from revisa.operators import changes as ch
from revisa.operators import release as rl
from revisa.operators import vocab as vc
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans import q_changes as qc
from revisa.plans import q_vocab as qv
from revisa.plans.q_revision import SPEC, r_frames
from revisa.plans.registry import register
from revisa.sources import publish as pub
from revisa.sources import tables as src

INT_COLS = ("sort_major", "sort_minor")
PUBLIC_MARKER = "balance"
STAMP = "20261203"


def _key_sql(c):
    t = S.strip_ws(f"coalesce({c}, '')")
    return f"(CASE WHEN {t} = '' THEN cast(0 AS bigint) WHEN regexp_matches({t}, '^[+-]?[0-9]+$') THEN try_cast({t} AS bigint) END)"


@register(
    "sort_release",
    S.with_fixtures(
        ["rev_updated"],
        f"SELECT ord, {_key_sql('sort_major')} AS major_key, {_key_sql('sort_minor')} AS minor_key, "
        f"row_number() OVER (ORDER BY coalesce({_key_sql('sort_major')}, 0), coalesce({_key_sql('sort_minor')}, 0), ord) AS position, nullif(concat_ws('; ', "
        f"CASE WHEN {_key_sql('sort_major')} IS NULL THEN 'Non-integer sort value in ''sort_major'': ' || sort_major END, "
        f"CASE WHEN {_key_sql('sort_minor')} IS NULL THEN 'Non-integer sort value in ''sort_minor'': ' || sort_minor END), '') AS sort_error FROM rev_updated",
    ),
)
def sort_release(spark, sf_dir):
    u = fx.rev_updated(spark, sf_dir)
    return rl.sort_release(u, "sort_major", "sort_minor").select("ord", "major_key", "minor_key", "position", "sort_error")


@register(
    "typed_release",
    S.with_fixtures(
        ["rev_original"],
        "SELECT ord, " + ", ".join(f"{S.int_like(c)} AS {c}" if c in INT_COLS else f"coalesce({c}, '') AS {c}" for c in SPEC.columns) + " FROM rev_original",
    ),
)
def typed_release(spark, sf_dir):
    return rl.typed_release(fx.rev_original(spark, sf_dir), INT_COLS, SPEC.columns, keep=("ord",))


_PUB = [c for c in ["ord", *SPEC.columns]][: ["ord", *SPEC.columns].index(PUBLIC_MARKER)]


@register("public_projection", S.with_fixtures(["rev_original"], f"SELECT {', '.join(_PUB)} FROM rev_original"))
def public_projection(spark, sf_dir):
    return rl.public_projection(fx.rev_original(spark, sf_dir), PUBLIC_MARKER)


@register(
    "public_tables",
    S.with_fixtures(
        ["rev_original", "node_names"],
        f"SELECT 'entries' AS table_name, {len(_PUB)} AS n_columns, count(*) AS n_rows FROM rev_original UNION ALL SELECT 'names', 4, count(*) FROM node_names",
    ),
)
def public_tables(spark, sf_dir):
    """The tables of a public release: the baseline kept for editors and their log stay inside."""
    o = fx.rev_original(spark, sf_dir)
    tables = {"entries": o, "original": o, "names": fx.node_names(spark, sf_dir), "changelog": _changelog(spark, sf_dir)}
    out = None
    for name, df in rl.public_tables(tables, "entries", PUBLIC_MARKER, internal=("original", "changelog")).items():
        row = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), F.lit(len(df.columns)).alias("n_columns"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out


CARRY = ["nation", "region", "documents", "changelog"]


def _digest_sql(columns, source: str, name: str, status: str | None = None) -> str:
    """Number and digest of the rows of a table (see :mod:`revisa.sources.digest`)."""
    row = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in columns)
    sums = " || '-' || ".join(f"coalesce(sum(('0x' || substr(h, {at}, 15))::BIGINT::HUGEINT), 0)::VARCHAR" for at in (1, 16))
    told = f", '{status}' AS status" if status else ""
    return f"SELECT '{name}' AS table_name{told}, count(*) AS n_rows, {sums} AS digest FROM (SELECT md5({row}) AS h FROM {source})"


_TABLE_COLS = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "documents": ["doc_id", "text", "lang", "source", "n_chars"],
}


@register(
    "carry_forward",
    " UNION ALL ".join(_digest_sql(c, t, t, "copied") for t, c in _TABLE_COLS.items()) + " UNION ALL SELECT 'changelog', 'missing', NULL, NULL",
)
def carry_forward(spark, sf_dir):
    prev = {t: fx.table(spark, sf_dir, t) for t in _TABLE_COLS}
    return rl.carry_forward(prev, CARRY, _scratch(spark))[1]


def _changelog(spark, sf_dir):
    nn = fx.node_names(spark, sf_dir)
    return nn.groupBy("release_num").agg(F.count(F.lit(1)).alias("n")).select(
        (F.col("release_num") + 1).cast("bigint").alias("ord"),
        F.concat(F.lit("2026-0"), F.col("release_num").cast("string"), F.lit("-01")).alias("when"),
        F.lit("loader").alias("who"),
        F.concat(F.lit("names: "), F.col("n").cast("string")).alias("what"),
    )


_LOG_SQL = (
    "SELECT cast(release_num + 1 AS bigint) AS ord, '2026-0' || cast(release_num AS varchar) || '-01' AS \"when\", 'loader' AS who, "
    "'names: ' || cast(count(*) AS varchar) AS what FROM node_names GROUP BY release_num"
)


@register(
    "changelog_append",
    S.with_fixtures(
        ["node_names"],
        "SELECT * FROM log UNION ALL SELECT (SELECT max(ord) FROM log) + 1, '2026-12-03', 'revisa', 'names total: ' || cast((SELECT count(*) FROM node_names) AS varchar)",
        [("log", _LOG_SQL)],
    ),
)
def changelog_append(spark, sf_dir):
    log = _changelog(spark, sf_dir)
    total = fx.node_names(spark, sf_dir).count()
    return rl.changelog_append(log, "2026-12-03", "revisa", f"names total: {total}")


def _scratch(spark):
    return src.shared_path(spark, "revisa-out", uuid.uuid4().hex)


def _both_digests(columns) -> str:
    return S.with_fixtures(["rev_original"], " UNION ALL ".join(_digest_sql(columns, "rev_original", n) for n in ("entries", f"entries_{STAMP}")))


@register("snapshot_counts", _both_digests(["ord", *SPEC.columns]))
def snapshot_counts(spark, sf_dir):
    return src.snapshot(fx.rev_original(spark, sf_dir), _scratch(spark), "entries", STAMP)[1]


RESTORED = ["ord", "id", "sort_major", "name"]


@register("restore_counts", _both_digests(RESTORED))
def restore_counts(spark, sf_dir):
    base = _scratch(spark)
    src.snapshot(fx.rev_original(spark, sf_dir), base, "entries", STAMP)
    return src.restore(spark, base, f"entries_{STAMP}", RESTORED, "entries")


@register("map_columns", S.with_fixtures(["rev_original"], "SELECT ord, " + ", ".join(f"{c} AS {t}" for c, t in SPEC.updatable) + " FROM rev_original"))
def map_columns(spark, sf_dir):
    return rl.map_columns(fx.rev_original(spark, sf_dir), SPEC.updatable, keep=("ord",))


WIDTH_COLS = ("doc_id", "text", "lang", "source", "n_chars")
_BREAKS_SQL = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c-\\x1e\\x{85}\\x{2028}\\x{2029}]"


@register(
    "column_width_profile",
    S.with_fixtures(
        [],
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", cast(coalesce(max(list_max(list_transform(string_split_regex(cast({c} AS varchar), '{_BREAKS_SQL}'), lambda s: length(s)))), 0) AS bigint) AS max_line FROM documents"
            for c in WIDTH_COLS
        ),
    )
    .replace("WITH \n", "SELECT \"column\", max_line, cast(least(80, greatest(8, max_line + 2)) AS bigint) AS width FROM (", 1)
    + ")",
)
def column_width_profile(spark, sf_dir):
    return rl.column_widths(fx.table(spark, sf_dir, "documents"), WIDTH_COLS)


def _rendered(spark, sf_dir):
    o, u = r_frames(spark, sf_dir)
    vo, vu = qv.frames(spark, sf_dir)
    voc = vc.render_inserts(vc.route_inserts(vc.added(vo, vu), qv.routes(spark)))
    return {
        "column_value_inserts": voc,
        "deletes": ch.render_deletes(ch.change_deletes(u, SPEC), SPEC),
        "updates": ch.render_updates(ch.update_entries(o, u, SPEC), SPEC),
        "inserts": ch.render_inserts(ch.change_inserts(u, SPEC), SPEC),
    }


def _stages_sql() -> str:
    parts = [
        ("0, 'column_value_inserts'", qv._render_vocab_sql(), "ord"),
        ("1, 'deletes'", qc._render_deletes_sql(), "ord"),
        ("2, 'updates'", qc._render_updates_sql(), "ord"),
        ("3, 'inserts'", qc._render_inserts_sql(), "ord"),
    ]
    sel = []
    for i, (lab, sql, o) in enumerate(parts):
        n, label = lab.split(", ")
        alias = " AS stage" if i == 0 else ""
        alias2 = " AS label" if i == 0 else ""
        sel.append(f"SELECT {n}{alias}, {label}{alias2}, cast({o} AS bigint) AS ord, statement FROM ({sql}) s{i}")
    return " UNION ALL ".join(sel)


def _published(spark, sf_dir) -> str:
    path = _scratch(spark)
    pub.publish(rl.change_set_stages(_rendered(spark, sf_dir)), path)
    return path


@register("change_set_stages", _stages_sql())
def change_set_stages(spark, sf_dir):
    """The change set, published and read back."""
    return pub.read_statements(spark, _published(spark, sf_dir))


@register(
    "stage_order",
    "SELECT name, stage_num, n_rows, row_number() OVER (ORDER BY stage_num) AS position FROM (SELECT 'stage_' || cast(k AS varchar) || '_' || l AS name, cast(k AS bigint) AS stage_num, "
    "count(stage) AS n_rows FROM (VALUES (0, 'column_value_inserts.sql'), (1, 'deletes.sql'), (2, 'updates.sql'), (3, 'inserts.sql')) v(k, l) LEFT JOIN ("
    + _stages_sql()
    + ") s ON s.stage = v.k GROUP BY k, l)",
)
def stage_order(spark, sf_dir):
    """The stage files of a published set, in the order to apply them, from its manifest alone."""
    manifest = pub.read_manifest(spark, _published(spark, sf_dir))
    return rl.stage_order(manifest.select("name")).join(manifest.select("name", "n_rows"), "name")


DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]


_TRICKY = "CASE WHEN doc_id % 7 = 3 THEN 'say \"' || source || '\", \\ and' || chr(13) || chr(10) || '\"' || lang || '\"' || chr(10) ELSE source END"


@register("src_flatfile_roundtrip", "SELECT " + ", ".join(f"cast({_TRICKY if c == 'source' else c} AS varchar) AS {c}" for c in DOC_COLS) + " FROM documents")
def src_flatfile_roundtrip(spark, sf_dir):
    path = _scratch(spark) + "/documents.txt"
    src.write_dump(_tricky(fx.table(spark, sf_dir, "documents")), path)
    return src.read_dump(spark, path, DOC_COLS, escape='"')


def _tricky(documents):
    """Documents with quotes, backslashes and line breaks in some fields."""
    quoted = F.concat(F.lit('say "'), F.col("source"), F.lit('", \\ and\r\n"'), F.col("lang"), F.lit('"\n'))
    return documents.withColumn("source", F.when(F.col("doc_id") % 7 == 3, quoted).otherwise(F.col("source")))


R_COLS = ["ord", *SPEC.columns]


@register(
    "src_tabular_by_suffix",
    S.with_fixtures(
        ["rev_original"],
        " UNION ALL ".join(f"SELECT '{sfx}' AS suffix, " + ", ".join(f"cast({c} AS varchar) AS {c}" for c in R_COLS) + " FROM rev_original" for sfx in ("csv", "txt")),
    ),
)
def src_tabular_by_suffix(spark, sf_dir):
    base = _scratch(spark)
    o = fx.rev_original(spark, sf_dir)
    out = None
    for sfx, sep in (("csv", ","), ("txt", "\t")):
        path = f"{base}/entries.{sfx}"
        o.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", "\\").csv(path)
        df = src.read_by_suffix(spark, path, R_COLS).select(F.lit(sfx).alias("suffix"), *R_COLS)
        out = df if out is None else out.unionByName(df)
    return out
