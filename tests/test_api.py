"""The one-call workflow on fixture R at sf0.001."""

import pytest
from pyspark.sql import functions as F

from revisa import api
from revisa.operators import issues as iss
from revisa.plans import fixtures as fx
from revisa.plans import q_vocab as qv

from conftest import SF


def test_revise(spark):
    o = fx.rev_original(spark, SF)
    u = fx.rev_updated(spark, SF, o)
    r = api.revise(o, u, fx.R_SPEC, fx.vocab_original(spark, SF), fx.vocab_updated(spark, SF), qv.CONSTRAINED, qv.routes(spark))
    assert r.has_errors()
    checks = {row["check"] for row in r.issues.select("check").distinct().collect()}
    assert {"vocabulary", "keys", "key_format", "keys_added", "keys_missing", "read_only"} & checks
    assert {"vocabulary_revision"} <= checks
    assert all(row["statement"].startswith("-- WARNING") for row in r.statements.collect())
    stages = {row["stage"] for row in r.statements.select("stage").distinct().collect()}
    assert stages == {0, 1, 2, 3}
    assert r.updates.count() > 0 and r.inserts.count() > 0 and r.deletes.count() > 0
    # updates are built from the corrected edit: 'SPACE TOOLS' arrives as the vocabulary's
    # spelling; a value the vocabulary lacks stays as typed and is reported as an ERROR
    seg = {v[0] for v in r.updates.select(F.explode("ch").alias("a")).where(F.col("a.target") == "segment_name").select("a.new_value").collect()}
    assert "Space-Tools" in seg and "SPACE TOOLS" not in seg
    unlisted = r.issues.where(F.col("message").contains("which is not listed")).count()
    assert unlisted > 0
    with pytest.raises(iss.ProcessingHalted):
        api.revise(o, u, fx.R_SPEC, keep_going=False)


def test_diff_tables(spark):
    old = {"t": spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "ord bigint, c1 string, c2 string"),
           "gone": spark.createDataFrame([(1, "z")], "ord bigint, c1 string")}
    new = {"t": spark.createDataFrame([(1, "a", "x "), (2, "B", "y"), (3, "c", None)], "ord bigint, c1 string, c2 string")}
    d = api.diff_tables(old, new)
    rows = {r["row"]: r["text"] for r in d.report.collect()}
    assert rows == {2: "Row 2: B: x -> x ", 3: "Row 3: A: b -> B", 4: "Row 4: A: <empty> -> c"}
    assert [tuple(r) for r in d.table_differences.collect()] == [("gone", "old_only")]
    assert d.verdict.first()["has_differences"]
    d2 = api.diff_tables(old, new, ignore_whitespace_only=True, ignore=["t:^c$"], counts_only=True)
    assert [tuple(r) for r in d2.report.collect()] == [("t", 1)]
    same = api.diff_tables(new, new)
    assert same.verdict.first()["message"] == "No differences found."


def test_build_release(spark):
    o = fx.rev_original(spark, SF)
    cust = fx.table(spark, SF, "customer")
    rules = [("entries", "segment", "MACH%")]
    r = api.build_release(
        {"entries": o, "customer": cust},
        "entries",
        fx.R_SPEC,
        ("sort_major", "sort_minor"),
        mask_rules=rules,
        literal_vocab={"kind": ["E", "A"]},
        vocab_columns={"segment": ("customer", "c_mktsegment", "c_custkey")},
        public_marker="balance",
        key_link_base="http://example.org/id/",
        defs=fx.defs(spark, SF),
        doc_marker="notes",
    )
    assert r.editor.where(F.col("segment") == "MACHINERY").isEmpty()
    assert r.editor.count() == o.where(F.col("segment") != "MACHINERY").count()
    assert dict(r.editor.dtypes)["sort_major"] == "bigint"
    assert r.editor.where(~F.col("id").startswith("=HYPERLINK(")).isEmpty()
    assert "balance" not in r.public.columns and "segment" in r.public.columns
    assert r.vocabularies.where(F.col("col") == "kind").count() == 2
    docs = {row["severity"] for row in r.issues.where(F.col("check") == "documentation").collect()}
    assert docs == {"WARNING", "INFO"}
    majors = [row["sort_major"] for row in r.editor.select("sort_major").collect()]
    assert majors == sorted(majors)


def test_revise_missing_column_is_an_issue(spark):
    o = fx.rev_original(spark, SF)
    u = fx.rev_updated(spark, SF, o).drop("segment")
    r = api.revise(o, u, fx.R_SPEC)
    msgs = [row["message"] for row in r.issues.collect()]
    assert msgs and all(row["check"] == "headers" for row in r.issues.collect())
    assert any("mismatch" in m or "missing" in m for m in msgs)
    assert r.updates.isEmpty() and r.statements.isEmpty()


def test_build_release_info_counts(spark):
    o = fx.rev_original(spark, SF)
    r = api.build_release({"entries": o}, "entries", fx.R_SPEC, ("sort_major", "sort_minor"), mask_rules=[("entries", "segment", "MACH%")], key_link_base="http://example.org/id/")
    info = {row["check"]: row["message"] for row in r.issues.where(F.col("severity") == "INFO").collect()}
    n_mach = o.where(F.col("segment").startswith("MACH")).count()
    assert info["mask"].endswith(f"matched {n_mach} row(s)")
    assert info["links"] == f"Added {o.count() - n_mach} key links"


def test_build_release_reports_what_it_cannot_check(spark):
    o = fx.rev_original(spark, SF).limit(50)
    rules = spark.createDataFrame([("entries", "segment", "MACH%"), ("entries", " ", "x"), ("entries", "gone", "y")], "table_name string, col string, pattern string")
    base = {"tables": {"entries": o, "log": o}, "release_table": "entries", "spec": fx.R_SPEC, "sort_columns": ("sort_major", "sort_minor")}
    r = api.build_release(**base, mask_rules=rules, defs=fx.defs(spark, SF), doc_marker="no such column", internal=("log",), public_marker="balance")
    errors = sorted((row["check"], row["message"]) for row in r.issues.where("severity <> 'INFO'").collect())
    assert errors == [
        ("documentation", "Release is missing the 'no such column' header needed for the documentation check"),
        ("mask", "Mask rule entries. LIKE 'x' must provide table_name, col and pattern"),
        ("mask", "Mask rule entries.gone LIKE 'y' names a column that the table lacks"),
    ]
    assert r.editor.where("segment = 'MACHINERY'").isEmpty() and list(r.public_tables) == ["entries"] and "balance" not in r.public_tables["entries"].columns
    r = api.build_release(**base, defs=fx.defs(spark, SF).drop("definition"), doc_marker="notes")
    assert [row["message"] for row in r.issues.where("check = 'documentation'").collect()] == ["Definitions are missing required column(s): definition"]
    r = api.build_release(**base, mask_rules=rules.withColumnRenamed("col", "column"), defs=fx.defs(spark, SF), doc_marker="notes")
    told = {(row["check"], row["severity"]): row["message"] for row in r.issues.collect()}
    assert "must have header columns" in told["mask", "ERROR"] and "->" in told["documentation", "INFO"]
