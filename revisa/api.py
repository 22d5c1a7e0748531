"""One call for the whole update workflow: check an edited table against its baseline and
produce the issue table, the change set and its rendered statements.

Everything returned is a DataFrame.  The check runs once: its prepared inputs and its issues
are written to the session's shared folder, since errors put a warning into every output.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import changes as ch
from revisa.operators import issues as iss
from revisa.operators import release as rl
from revisa.operators import revision as rv
from revisa.operators import vocab as vc
from revisa.spec import RevisionSpec


@dataclass
class Revision:
    issues: DataFrame
    updates: DataFrame
    inserts: DataFrame
    deletes: DataFrame
    vocabulary_inserts: DataFrame | None
    statements: DataFrame

    def has_errors(self) -> bool:
        return bool(iss.has_errors(self.issues).first()[0])


def revise(
    original: DataFrame,
    edited: DataFrame,
    spec: RevisionSpec,
    vocab_original: DataFrame | None = None,
    vocab_updated: DataFrame | None = None,
    constrained=(),
    routes: DataFrame | None = None,
    strict_list: bool = False,
    keep_going: bool = True,
    reference: DataFrame | None = None,
    export: DataFrame | None = None,
    export_kinds: dict | None = None,
) -> Revision:
    """Check ``edited`` against ``original`` (raw tables with an ordinal column) and build the
    change set from the vocabulary-corrected edit.

    ``keep_going=False`` stops at the first check stage with an ERROR
    (:class:`revisa.operators.issues.ProcessingHalted`).  ``reference`` (col, value) and
    ``export`` (an external copy of the baseline, with the ordinal column) add their checks.
    """
    from revisa.operators import schema as sc
    from revisa.sources.tables import written_once

    spark = original.sparkSession
    header_issues = []
    for sheet, df in (("original", original), ("edited", edited)):
        actual = [c for c in df.columns if c != spec.ordinal]
        for m in sc.header_position_check(spec.columns, actual):
            header_issues.append(("headers", sheet, None, m, "ERROR"))
    missing = [c for c in [spec.ordinal, *spec.columns] if c not in original.columns or c not in edited.columns]
    if missing:
        # Q20: a missing column is an issue, not a crash; nothing else can be checked
        issues = spark.createDataFrame(header_issues, iss.SCHEMA)
        empty = spark.createDataFrame([], "ord bigint, statement string")
        return Revision(issues=issues, updates=empty, inserts=empty, deletes=empty, vocabulary_inserts=None, statements=empty)
    o, e = rv.prepare(original, spec), rv.prepare(edited, spec)
    x = None
    if export is not None:
        x = export.select(F.col(spec.ordinal).alias("ord"), *spec.columns, T.norm_key(T.hyperlink_label(spec.key)).alias(rv.KEY))
    check = iss.RevisionCheck(
        o, e, spec, vocab_updated, constrained, strict_list, vocab_original=vocab_original, reference=reference, export=x, export_kinds=export_kinds
    )
    issues = spark.createDataFrame(header_issues, iss.SCHEMA)
    for name, df in check.stages():
        if not keep_going and not df.where(F.col("severity") == "ERROR").isEmpty():
            raise iss.ProcessingHalted(f"stage {name} has errors")
        issues = issues.unionByName(df)
    issues = written_once(issues, "issues")
    errors = bool(iss.has_errors(issues).first()[0])
    entries = check.entries()
    inserts = ch.change_inserts(check.edited, spec)
    deletes = ch.change_deletes(check.edited, spec)
    rendered = {
        "deletes": ch.render_deletes(deletes, spec),
        "updates": ch.render_updates(entries, spec),
        "inserts": ch.render_inserts(inserts, spec),
    }
    vocab_inserts = None
    if vocab_original is not None and vocab_updated is not None and routes is not None:
        vocab_inserts = vc.route_inserts(vc.added(vocab_original, vocab_updated), routes)
        rendered["column_value_inserts"] = vc.render_inserts(vocab_inserts)
    return Revision(
        issues=issues,
        updates=entries,
        inserts=inserts,
        deletes=deletes,
        vocabulary_inserts=vocab_inserts,
        statements=rl.change_set_stages(rendered, errors),
    )


@dataclass
class TableDiff:
    cells: DataFrame
    table_differences: DataFrame
    report: DataFrame
    verdict: DataFrame


def diff_tables(
    old: dict,
    new: dict,
    pairs: list[tuple[str, str]] | None = None,
    ignore: list[str] = (),
    ignore_whitespace_only: bool = False,
    by_cell: bool = False,
    counts_only: bool = False,
    ord_col: str = "ord",
) -> TableDiff:
    """The diff tool in one call: two named sets of tables (``{name: DataFrame}`` with an
    ordinal column) compared position by position.

    ``ignore`` rules are ``TABLE_REGEX:VALUE_REGEX``; the report is per row (default), per
    cell, or rows-with-differences counts per table.
    """
    from functools import reduce

    from revisa.operators import tablediff as td

    rules = td.parse_ignore_rules(ignore)
    og = reduce(lambda a, b: a.unionByName(b), [td.to_grid(df, name, ord_col) for name, df in old.items()])
    ng = reduce(lambda a, b: a.unionByName(b), [td.to_grid(df, name, ord_col) for name, df in new.items()])
    p = [(a, b) for a, b in (pairs or [(name, name) for name in old]) if a in old and b in new]
    cells = td.cell_diff(og, ng, p, ignore_whitespace_only)
    if rules:
        cells = td.drop_ignored(cells, td.ignored_rows(ng, p, rules))
    sets = td.table_set_diff(og, ng)
    if counts_only:
        report = td.row_counts(cells)
    elif by_cell:
        report = td.by_cell(cells)
    else:
        report = td.by_row(cells)
    return TableDiff(cells=cells, table_differences=sets, report=report, verdict=td.verdict(cells, sets))


@dataclass
class Release:
    editor: DataFrame
    original: DataFrame
    public: DataFrame
    vocabularies: DataFrame
    issues: DataFrame
    changelog: DataFrame | None
    public_tables: dict


def build_release(
    tables: dict,
    release_table: str,
    spec: RevisionSpec,
    sort_columns: tuple[str, str],
    mask_rules=(),
    literal_vocab: dict | None = None,
    vocab_columns=(),
    public_marker: str | None = None,
    key_link_base: str | None = None,
    defs: DataFrame | None = None,
    doc_marker: str | None = None,
    doc_range: tuple[str, ...] = (),
    doc_values: DataFrame | None = None,
    changelog: DataFrame | None = None,
    provenance: tuple[str, str, str] | None = None,
    keep_going: bool = True,
    internal=(),
) -> Release:
    """The export side in one call.

    Masks every table by its rules (FLT-02), sorts the release table by its two integer
    columns (SRT-03, non-integers reported), checks its columns against the spec (SCH-02),
    builds the vocabularies from literal lists and table columns (SET-05, sorted SRT-01),
    checks the documentation when definitions are given (CHK-05; WARNING when keep-going;
    ``doc_range`` names the columns the grouped heading list must cover, JN-17; a missing
    marker or definition column is an issue, every mapping found an INFO line),
    types the release (SNK-01), links the key (SCL-06), trims the public copy and leaves the
    ``internal`` tables out of the public set (SNK-07), and appends the provenance row to the
    changelog (SNK-09).  ``mask_rules`` may be a table of rules: those that cannot be applied
    become issues.
    """
    from functools import reduce

    from revisa.functions import text as T
    from revisa.operators import docs as dc
    from revisa.operators import mask as mk
    from revisa.operators import schema as sc

    spark = next(iter(tables.values())).sparkSession
    rule_issues = None
    if isinstance(mask_rules, DataFrame):
        rule_issues = mk.rule_issues(mask_rules, {name: df.columns for name, df in tables.items()})
        mask_rules = mk.read_rules(mask_rules, strict=False) if mask_rules.columns == mk.RULE_HEADER else []
    masked = {name: mk.mask_table(df, name, list(mask_rules)) for name, df in tables.items()}
    major, minor = sort_columns
    keyed = rl.sort_keys(masked[release_table], major, minor)
    issue_parts = [
        keyed.where(F.col("sort_error").isNotNull()).select(
            F.lit("sort").alias("check"), F.col("sort_error").alias("message"), F.lit("ERROR").alias("severity")
        )
    ]
    release = keyed.orderBy(F.coalesce("major_key", F.lit(0)), F.coalesce("minor_key", F.lit(0)), "ord").drop("major_key", "minor_key", "sort_error")
    diff = sc.schema_diff(spec.columns, [c for c in release.columns if c != spec.ordinal])
    msgs = [f"Release table is missing column '{c}'" for c in diff["missing"]] + [f"Release table has unexpected column '{c}'" for c in diff["unexpected"]]
    if msgs:
        issue_parts.append(spark.createDataFrame([("schema", m, "ERROR") for m in msgs], "check string, message string, severity string"))
    if rule_issues is not None:
        issue_parts.append(rule_issues)
    vocab_tables = [(col, masked[t], c, o) for col, (t, c, o) in dict(vocab_columns).items()] if vocab_columns else []
    vocabularies = vc.sort_vocab(vc.build(literal_vocab or {}, vocab_tables, spark)) if (literal_vocab or vocab_tables) else None
    if defs is not None and doc_marker is not None:
        doc = dc.check_documentation([c for c in release.columns if c != spec.ordinal], doc_marker, defs, doc_values, doc_range)
        issue_parts.append(iss.severity_policy(doc, keep_going).select("check", "message", "severity"))
    editor = rl.typed_release(release, [c for c in sort_columns], [c for c in release.columns if c != spec.ordinal], keep=(spec.ordinal,))
    if key_link_base:
        raw_key = T.strip_ws(F.coalesce(F.col(spec.key), F.lit("")))
        added = editor.agg(F.sum(F.when((raw_key != "") & ~raw_key.startswith("=HYPERLINK("), 1).otherwise(0)).alias("n"))
        issue_parts.append(added.select(F.lit("links").alias("check"), F.concat(F.lit("Added "), F.coalesce(F.col("n"), F.lit(0)).cast("string"), F.lit(" key links")).alias("message"), F.lit("INFO").alias("severity")))
        editor = editor.withColumn(spec.key, T.hyperlink_build(spec.key, key_link_base))
    for name, df in tables.items():
        if any(t == name for t, _, _ in mask_rules):
            counts = mk.matched_counts(df, name, list(mask_rules))
            issue_parts.append(counts.select(
                F.lit("mask").alias("check"),
                F.concat(F.lit("Mask "), F.col("table_name"), F.lit("."), F.col("col"), F.lit(" LIKE '"), F.col("pattern"), F.lit("' matched "), F.col("n_matched").cast("string"), F.lit(" row(s)")).alias("message"),
                F.lit("INFO").alias("severity"),
            ))
    issues = reduce(lambda a, b: a.unionByName(b), issue_parts)
    public = rl.public_projection(editor, public_marker) if public_marker else editor
    public_tables = rl.public_tables({**masked, release_table: public}, release_table, public_marker or "", internal)
    log = rl.changelog_append(changelog, *provenance) if changelog is not None and provenance else changelog
    return Release(editor=editor, original=release, public=public, vocabularies=vocabularies, issues=issues, changelog=log, public_tables=public_tables)
