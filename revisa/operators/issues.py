"""Issue table: every check's findings in one fixed schema, plus the whole revision check.

Schema: ``check, worksheet, row, message, severity`` (``row`` is the row ordinal).
Every check is a lazy DataFrame; the union is the issue log (SET-06).  With
``fail_fast`` the checks run stage by stage and stop at the first stage with an ERROR.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import changes as ch
from revisa.operators import reconcile as rc
from revisa.operators import revision as rv
from revisa.operators import skew
from revisa.operators import tokens as tk
from revisa.operators import vocab as vc
from revisa.spec import RevisionSpec

COLUMNS = ["check", "worksheet", "row", "message", "severity"]
SCHEMA = "check string, worksheet string, row bigint, message string, severity string"
EDITED, ORIGINAL, VOCAB, VOCAB_ORIGINAL, EXPORT = "edited", "original", "vocabulary", "vocabulary_original", "export"


class ProcessingHalted(Exception):
    """Raised by a fail-fast check run at the first ERROR."""


def _issues(df: DataFrame, check: str, sheet: str, row: Column, message: Column, severity="ERROR") -> DataFrame:
    sev = severity if isinstance(severity, Column) else F.lit(severity)
    return df.select(F.lit(check).alias("check"), F.lit(sheet).alias("worksheet"), row.cast("bigint").alias("row"), message.alias("message"), sev.alias("severity"))


def _m(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def vocabulary_revision(vocab_original: DataFrame, vocab: DataFrame) -> DataFrame:
    """JN-08 / JN-09 issues: values only one of the two vocabularies has, at their first row."""
    parts = [
        (vc.added(vocab_original, vocab), VOCAB, "' does not appear in the original vocabulary."),
        (vc.removed(vocab_original, vocab), VOCAB_ORIGINAL, "' is missing from the vocabulary."),
    ]
    return rv.union_all(
        [_issues(vc.per_value(d), "vocabulary_revision", sheet, F.col("first_ord"), _m("Value '", F.col("value"), "' in column '", F.col("col"), end)) for d, sheet, end in parts]
    )


def reference_lists(vocab_original: DataFrame, reference: DataFrame) -> DataFrame:
    """JN-07 issues: rows of the original vocabulary outside the reference list of their column, and columns it lacks."""
    outside = vc.not_in_reference(vocab_original, reference)
    listed = reference.select(T.norm("col").alias("col")).where(F.col("col").isNotNull()).distinct()
    lacking = listed.join(vocab_original.select(T.norm("col").alias("col")).distinct(), "col", "left_anti")
    return _issues(
        outside, "reference_lists", VOCAB_ORIGINAL, F.col("ord"), _m("Value '", F.col("value"), "' in column '", F.col("col"), "' is not present in the reference list.")
    ).unionByName(_issues(lacking, "reference_lists", VOCAB_ORIGINAL, F.lit(None), _m("Column '", F.col("col"), "' missing from the original vocabulary.")))


def reconciliation(original: DataFrame, export: DataFrame, spec: RevisionSpec, kinds: dict) -> DataFrame:
    """AGG-02, JN-03 and JN-04 issues: later copies in the export, keys of one side only, cells that differ."""
    key = F.col(rv.KEY)
    keys = rc.reconcile_keys(original, export)
    cells = rc.reconcile_cells(original, export, spec, kinds)
    shown = [F.coalesce(c, F.lit("")) for c in ("original_value", "export_value")]
    differs = _m("Column '", F.col("column"), "' for key ", key, " does not match the export (original='", shown[0], "', export='", shown[1], "').")
    return rv.union_all(
        [
            _issues(rv.duplicate_later_rows(export), "reconcile", EXPORT, F.col("ord"), _m("Key ", key, " appears multiple times in the export.")),
            _issues(keys.where("status = 'export_only'"), "reconcile", EXPORT, F.col("x_ord"), _m("Key ", key, " missing from the original table.")),
            _issues(keys.where("status = 'original_only'"), "reconcile", ORIGINAL, F.col("o_ord"), _m("Key ", key, " missing from the export.")),
            _issues(cells, "reconcile", ORIGINAL, F.col("ord"), differs),
        ]
    )


def corrected_edit(edited: DataFrame, vocab: DataFrame | None, constrained, kept=lambda df: df) -> tuple[DataFrame | None, DataFrame]:
    """JN-10: the correction's issues (None without a vocabulary) and the corrected frame every later check reads (Q5).

    ``kept`` writes the frame that both come from, so that the edit is corrected once.
    """
    constrained = [c for c in constrained if c in edited.columns]
    if vocab is None or not constrained:
        return None, kept(edited)
    wide = kept(vc.correct_wide(edited, vocab, constrained))
    cells = F.explode(F.array(*[F.col("_fix_" + c) for c in constrained]))
    found = wide.select("ord", cells.alias("f")).where(F.col("f.message").isNotNull())
    return _issues(found, "vocabulary", EDITED, F.col("ord"), F.col("f.message"), F.col("f.severity")), vc.apply_corrections(wide, edited.columns, constrained)


class RevisionCheck:
    """CHK-01: the whole check of an edited table against its baseline, and what it shares with the change set.

    Tables are prepared frames (:func:`revisa.operators.revision.prepare`).  ``vocab_original``
    adds the vocabulary revision, ``reference`` (col, value) the reference lists, ``export``
    (with a prepared key) the reconciliation.  With ``materialize`` what several stages read
    is written once as Parquet in the shared folder: the prepared tables (the edit with its
    corrections, the export with its key), the vocabularies, one row per key with its counts
    on both sides, and the compared pairs.  The pair is joined once; each check on it is an
    expression that gives an array of findings.
    """

    def __init__(
        self,
        original: DataFrame,
        edited: DataFrame,
        spec: RevisionSpec,
        vocab: DataFrame | None = None,
        constrained=(),
        strict_list: bool = False,
        materialize: bool = True,
        vocab_original: DataFrame | None = None,
        reference: DataFrame | None = None,
        export: DataFrame | None = None,
        export_kinds: dict | None = None,
    ):
        self._original, self._edited, self.spec = original, edited, spec
        self._vocab, self.constrained, self.strict_list, self.materialize = vocab, constrained, strict_list, materialize
        self._vocab_original, self.reference, self._export, self.export_kinds = vocab_original, reference, export, export_kinds or {}

    def _kept(self, df: DataFrame | None, name: str) -> DataFrame | None:
        from revisa.sources.tables import written_once

        return written_once(df, name) if self.materialize and df is not None else df

    @cached_property
    def vocab(self) -> DataFrame | None:
        return self._kept(self._vocab, "check-vocabulary")

    @cached_property
    def vocab_original(self) -> DataFrame | None:
        return self._kept(self._vocab_original, "check-vocabulary-original")

    @cached_property
    def export(self) -> DataFrame | None:
        return self._kept(self._export, "check-export")

    @cached_property
    def corrected(self) -> tuple[DataFrame | None, DataFrame]:
        return corrected_edit(self._edited, self.vocab, self.constrained, lambda df: self._kept(df, "check-edited"))

    @cached_property
    def original(self) -> DataFrame:
        return self._kept(self._original, "check-original")

    @cached_property
    def edited(self) -> DataFrame:
        """The edit with its vocabulary columns corrected, which every later check reads."""
        return self.corrected[1]

    @cached_property
    def keys(self) -> DataFrame:
        """(rkey, n_o, first_o, n_e, n_live, first_e): each key of either table once, so this full join has no hot key."""
        k = rv.KEY
        o = self.original.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("n_o"), F.min("ord").alias("first_o"))
        live = F.sum((~F.col(rv.REMOVED)).cast("bigint")).alias("n_live")
        e = self.edited.where(F.col(k).isNotNull()).groupBy(k).agg(F.count(F.lit(1)).alias("n_e"), live, F.min("ord").alias("first_e"))
        return self._kept(o.join(e, k, "full"), "check-keys")

    @cached_property
    def pairs(self) -> DataFrame:
        """(rkey, key_num, ord, o_ord, ch, valid, found) of the original rows that meet the one live edited row of their key and show a change."""
        spec, k = self.spec, rv.KEY
        cols = list(dict.fromkeys([c for c, _ in spec.updatable] + [c for c in spec.read_only if c != spec.key] + ([spec.list_column] if spec.list_column else [])))
        odd = self.keys.where((F.col("n_live") > 1) | (F.col("n_e") > F.col("n_live"))).select(k, "n_live", "n_e")
        e = rv.live(self.edited).where(F.col(k).isNotNull()).select(k, F.col("ord"), *[F.col(c).alias("u_" + c) for c in cols])
        e = e.join(odd, k, "left").where(F.coalesce("n_live", F.lit(1)) == 1).withColumn("only", F.coalesce("n_e", F.lit(1)) == 1).drop("n_live", "n_e")
        o = self.original.where(F.col(k).isNotNull()).select(k, F.col("ord").alias("o_ord"), *[F.col(c).alias("o_" + c) for c in cols])
        hot = skew.hot_keys(self.keys.where("n_live = 1").withColumn("n_o", F.coalesce("n_o", F.lit(0))), k, "n_o")
        pair = skew.join_unique(o, e, k, hot)
        fixed = [k, "ord", "o_ord", "only", *[F.col(p + c) for p in ("o_", "u_") for c in cols]]
        pair = rv.project_once(pair, fixed, ch=ch.changed_cells(spec), key_num=T.key_numeric(F.col(k), spec.key_pattern))
        pair = rv.project_once(pair, [k, "key_num", "ord", "o_ord", "ch"], valid=F.forall("ch", lambda x: x["error"].isNull()), found=self._findings())
        return self._kept(pair.where((F.size("ch") > 0) | (F.size("found") > 0)), "check-pairs")

    def _findings(self) -> Column:
        """Every finding on a joined pair: an array of (stage, check, message, severity)."""
        spec, key = self.spec, F.col(rv.KEY)

        def finding(stage, check, message, severity="ERROR"):
            return F.struct(F.lit(stage).alias("stage"), F.lit(check).alias("check"), message.alias("message"), F.lit(severity).alias("severity"))

        single = []
        for c in spec.read_only:
            if c != spec.key:
                same = T.values_equal(F.col("o_" + c), F.col("u_" + c), spec.kind(c), spec.fallback(), spec.type_codes)
                single.append(F.when(F.col("only") & ~same, finding("read_only", "read_only", _m(f"Read-only column '{c}' changed for key ", key, "."))))
        numberless = (F.size("ch") > 0) & F.forall("ch", lambda x: x["error"].isNull()) & F.col("key_num").isNull()
        single.append(F.when(numberless, finding("change_set", "updates", _m("Key '", key, "' cannot be converted to numeric form."))))
        if spec.list_column:
            told, message = ch.list_finding(spec, self.strict_list)
            single.append(F.when(told, finding("change_set", "list_changes", message, "WARNING")))
        bad = F.transform(F.filter("ch", lambda x: x["error"].isNotNull()), lambda x: finding("change_set", "updates", x["error"]))
        return F.concat(F.filter(F.array(*single), lambda x: x.isNotNull()), bad)

    def _pair_issues(self, stage: str) -> DataFrame:
        rows = self.pairs.select("ord", F.explode(F.filter("found", lambda x: x["stage"] == stage)).alias("f"))
        return rows.select(F.col("f.check").alias("check"), F.lit(EDITED).alias("worksheet"), F.col("ord").cast("bigint").alias("row"), F.col("f.message").alias("message"), F.col("f.severity").alias("severity"))

    def entries(self) -> DataFrame:
        """CHG-01 from the same join: accepted update entries."""
        return self.pairs.where((F.size("ch") > 0) & F.col("valid") & F.col("key_num").isNotNull()).select(rv.KEY, "key_num", "ord", "o_ord", "ch")

    def _key_issues(self) -> DataFrame:
        k = F.col(rv.KEY)
        fmt = []
        for side, df, n in ((EDITED, self.edited, "n_e"), (ORIGINAL, self.original, "n_o")):
            fmt.append(_issues(rv.key_format(df, self.spec), "key_format", side, F.col("ord"), _m("Invalid key format: ", F.col("raw_key"))))
            repeated = self.keys.where(F.col(n) > 1).select(rv.KEY, F.col(n).alias("n_rows"))
            # every row of the key is named
            d = skew.join_unique(df.where(k.isNotNull()).select(rv.KEY, "ord"), repeated, rv.KEY, skew.hot_keys(repeated, rv.KEY, "n_rows"))
            fmt.append(_issues(d, "duplicate_keys", side, F.col("ord"), _m("Key ", k, " appears multiple times (", F.col("n_rows").cast("string"), " rows).")))
        fmt.append(_issues(self.keys.where("n_o is null"), "keys_added", EDITED, F.col("first_e"), _m("Key ", k, " not present in original table.")))
        fmt.append(_issues(self.keys.where("n_e is null"), "keys_missing", ORIGINAL, F.col("first_o"), _m("Key ", k, " missing from edited table.")))
        return rv.union_all(fmt)

    def stages(self):
        """The checks in their fixed order, one ``(name, issues DataFrame)`` at a time.

        A generator: a stage is built when it is asked for, so whoever stops at a stage runs
        nothing of the later ones (the token rounds, say).
        """
        spec, k = self.spec, rv.KEY
        if self._vocab is not None and self._vocab_original is not None:
            yield "vocabulary_revision", vocabulary_revision(self.vocab_original, self.vocab)
        if self._vocab_original is not None and self.reference is not None:
            yield "reference_lists", reference_lists(self.vocab_original, self.reference)
        if self.corrected[0] is not None:
            yield "vocabulary", self.corrected[0]
        yield "blank_keys", _issues(self.original.where(F.col(k).isNull()), "blank_keys", ORIGINAL, F.col("ord"), F.lit("Original table contains a blank key."))
        yield "keys", self._key_issues()
        if self._export is not None:
            yield "reconcile", reconciliation(self.original, self.export, spec, self.export_kinds)
        yield "read_only", self._pair_issues("read_only")
        if spec.list_column:
            ex = tk.reuse_existing(self.edited, spec)
            nw = tk.reuse_new(self.edited, spec).where(F.col("status") == "rejected")
            yield (
                "token_reuse",
                _issues(ex, "token_reuse", EDITED, F.col("ord"), _m("New record reuses existing token(s): ", F.col("reused"))).unionByName(
                    _issues(nw, "token_reuse", EDITED, F.col("ord"), _m("New record reuses token(s) from other new rows: ", F.col("reused")))
                ),
            )
        chg = [
            _issues(ch.delete_issues(self.edited, spec), "deletes", EDITED, F.col("ord"), F.col("message")),
            self._pair_issues("change_set"),
            _issues(ch.insert_issues(self.edited, spec), "inserts", EDITED, F.col("ord"), F.col("message")),
        ]
        yield "change_set", rv.union_all(chg)

    def has_errors(self) -> bool:
        """FLT-13 / CHK-02: whether any stage has an ERROR; stops at the first, and later stages are never built."""
        return any(not df.where(F.col("severity") == "ERROR").limit(1).isEmpty() for _, df in self.stages())


def check_revision(
    original, edited, spec, vocab=None, constrained=(), fail_fast: bool = False, strict_list: bool = False, verbose: bool = False, materialize: bool = True, **lists
) -> DataFrame:
    """CHK-01 (+ CHK-02, CHK-04): all issues of the revision check (see :class:`RevisionCheck`)."""
    return all_issues(RevisionCheck(original, edited, spec, vocab, constrained, strict_list, materialize, **lists), fail_fast, verbose)


def all_issues(check: RevisionCheck, fail_fast: bool = False, verbose: bool = False) -> DataFrame:
    """The issues of every stage.

    ``fail_fast`` evaluates the stages in order and raises :class:`ProcessingHalted` at
    the first stage that has an ERROR (one ``isEmpty`` probe per stage).  ``verbose``
    adds one ``SUCCESS`` row for every stage that found nothing (also one probe each).
    """
    out = None
    for name, df in check.stages():
        if fail_fast and not df.where(F.col("severity") == "ERROR").isEmpty():
            raise ProcessingHalted(f"stage {name} has errors")
        out = df if out is None else out.unionByName(df)
        if verbose and df.isEmpty():
            ok = df.sparkSession.createDataFrame([(name, "", None, f"Check '{name}' passed.", "SUCCESS")], SCHEMA)
            out = out.unionByName(ok)
    return out


def has_errors(issues: DataFrame) -> DataFrame:
    """FLT-13 over issues that exist already: one row: does any ERROR exist."""
    return issues.agg(F.coalesce(F.max(F.col("severity") == "ERROR"), F.lit(False)).alias("has_errors"))


def severity_policy(issues: DataFrame, keep_going: bool, checks=("documentation",)) -> DataFrame:
    """CHK-03: with keep-going, errors of the listed checks become WARNINGs."""
    if not keep_going:
        return issues
    return issues.withColumn("severity", F.when(F.col("check").isin(list(checks)) & (F.col("severity") == "ERROR"), F.lit("WARNING")).otherwise(F.col("severity")))


def report(issues: DataFrame, original: DataFrame, edited: DataFrame, spec: RevisionSpec, run: dict | None = None) -> DataFrame:
    """SNK-04 / JN-12: issues with the edited row's key, context values and changed flags.

    A context value counts as changed on a new row when it is non-blank, else when it
    differs (FLT-08) from the first original row of the key.  Rows of other worksheets
    get no context.
    """
    ctx = list(spec.context_columns)
    o = rv.first_rows(original, spec, ctx).select(rv.KEY, *[F.col(c).alias("o_" + c) for c in ctx])
    e = edited.select(F.col("ord").alias("row"), rv.KEY, *ctx)
    new = e.where(F.col(rv.KEY).isNull())  # not joined: all new rows would meet in one task
    new = new.select("*", *[F.lit(None).cast(o.schema["o_" + c].dataType).alias("o_" + c) for c in ctx])
    e = e.where(F.col(rv.KEY).isNotNull()).join(o, rv.KEY, "left").unionByName(new)
    flags = [
        F.when(F.col(rv.KEY).isNull(), T.norm(c).isNotNull()).otherwise(~T.values_equal(F.col("o_" + c), F.col(c), spec.kind(c), codes=spec.type_codes)).alias("chg_" + c)
        for c in ctx
    ]
    e = e.select("row", rv.KEY, *[F.col(c).alias("ctx_" + c) for c in ctx], *flags).withColumn("worksheet", F.lit(EDITED))
    out = issues.join(e, ["worksheet", "row"], "left")
    # run provenance columns (e.g. command, version, run_date) as literals
    for name, value in (run or {}).items():
        out = out.withColumn(name, F.lit(value).cast("string"))
    return out
