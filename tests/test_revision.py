"""End-to-end properties on fixture R at sf0.001."""

from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators import changes as ch
from revisa.operators import revision as rv
from revisa.plans import fixtures as fx

from conftest import SF

SPEC = fx.R_SPEC


def frames(spark):
    o = fx.rev_original(spark, SF)
    return rv.prepare(o, SPEC), rv.prepare(fx.rev_updated(spark, SF, o), SPEC)


def test_apply_round_trip(spark):
    """apply(change set, stored original) = normalised edited on updatable columns of accepted rows."""
    o, u = frames(spark)
    entries = ch.update_entries(o, u, SPEC)
    applied = ch.apply_updates(ch.stored_table(o, SPEC), entries, SPEC)
    assert applied.where(F.col("update_status") == "guard_miss").isEmpty()
    accepted = entries.select("key_num", F.col("ord").alias("u_ord"))
    exp = u.join(accepted, u.ord == accepted.u_ord).select(
        "key_num", *[T.convert_lenient(c, SPEC.kind(c)).alias(t) for c, t in SPEC.updatable]
    )
    got = applied.join(accepted.select(F.col("key_num").alias("record_id")), "record_id").select(
        F.col("record_id").alias("key_num"), *[F.col(t).cast("string").alias(t) for _, t in SPEC.updatable]
    )
    assert sorted(map(tuple, exp.collect())) == sorted(map(tuple, got.collect()))


def test_no_changes_against_itself(spark):
    o, _ = frames(spark)
    assert rv.updatable_changes(o, o, SPEC).isEmpty()
    assert rv.row_change_summary(o, o, SPEC).where(F.col("n_changes") > 0).isEmpty()


def test_guard_miss_reported(spark):
    o, u = frames(spark)
    entries = ch.update_entries(o, u, SPEC)
    stored = ch.stored_table(o, SPEC).withColumn("entry_name", F.lit("changed elsewhere")).withColumn("minor_sort", F.lit(-1).cast("bigint"))
    stored = stored.withColumn("entry_type", F.lit("?")).withColumn("accessions", F.lit("?")).withColumn("segment_name", F.lit("?")).withColumn("notes", F.lit("?"))
    applied = ch.apply_updates(stored, entries, SPEC)
    assert applied.where(F.col("update_status") == "applied").isEmpty()
    assert not applied.where(F.col("update_status") == "guard_miss").isEmpty()


def test_masking_idempotent(spark):
    from revisa.operators import mask as mk

    rules = mk.read_rules(fx.mask_rules(spark))
    p = fx.table(spark, SF, "part")
    once = mk.mask_table(p, "part", rules)
    assert once.count() == mk.mask_table(once, "part", rules).count()


def test_mask_null_semantics(spark):
    from revisa.operators import mask as mk

    df = spark.createDataFrame([(1, None), (2, "ECO X"), (3, "STD"), (4, "")], "k int, t string")
    flat = sorted(r.k for r in mk.mask_table(df, "p", [("p", "t", "ECO%")]).collect())
    db = sorted(r.k for r in mk.mask_table(df, "p", [("p", "t", "ECO%")], null_as_empty=False).collect())
    assert flat == [1, 3, 4] and db == [3, 4]
    # a rule that matches '' masks null cells too in flat-file semantics
    assert sorted(r.k for r in mk.mask_table(df, "p", [("p", "t", "%")]).collect()) == []
    # the keep predicate agrees with NOT(match) row by row
    pred = mk.mask_predicate([("p", "t", "ECO%")], "p", df.columns)
    assert sorted(r.k for r in df.where(~pred).collect()) == flat


def test_guard_all_and_stage_warning(spark):
    from revisa.operators import release as rl

    o, u = frames(spark)
    entries = ch.update_entries(o, u, SPEC)
    stored = ch.stored_table(o, SPEC).withColumn("notes", F.lit("moved on"))
    any_ = ch.apply_updates(stored, entries, SPEC, guard="any")
    all_ = ch.apply_updates(stored, entries, SPEC, guard="all")
    n_any = any_.where(F.col("update_status") == "applied").count()
    n_all = all_.where(F.col("update_status") == "applied").count()
    assert n_all <= n_any and n_any > 0
    rendered = {"updates": ch.render_updates(entries, SPEC)}
    warned = rl.change_set_stages(rendered, has_errors=True).first()["statement"]
    assert warned.startswith(rl.WARNING_LINE)
    assert not rl.change_set_stages(rendered).first()["statement"].startswith("-- WARNING")


def test_strict_reference_comparison(spark):
    """Q9: with the reference's comparison, two different unreadable codes compare equal."""
    import dataclasses

    o = spark.createDataFrame([(2, "CU1", "zzz")], "ord bigint, id string, kind string")
    u = spark.createDataFrame([(2, "CU1", "yyy")], "ord bigint, id string, kind string")
    spec = dataclasses.replace(fx.R_SPEC, columns=("id", "kind"), blank_check=("id", "kind"), removal_column=None, read_only=(), updatable=(("kind", "entry_type"),))
    po, pu = rv.prepare(o, spec), rv.prepare(u, spec)
    assert rv.updatable_changes(po, pu, spec).count() == 1
    strict = dataclasses.replace(spec, strict_reference=True)
    assert rv.updatable_changes(po, pu, strict).count() == 0


def test_any_ordinal_name(spark):
    import dataclasses

    spec = dataclasses.replace(SPEC, ordinal="row_no")
    o = fx.rev_original(spark, SF).withColumnRenamed("ord", "row_no")
    u = fx.rev_updated(spark, SF).withColumnRenamed("ord", "row_no")
    po, pu = rv.prepare(o, spec), rv.prepare(u, spec)
    base_o, base_u = frames(spark)
    assert rv.updatable_changes(po, pu, spec).count() == rv.updatable_changes(base_o, base_u, SPEC).count()
    assert rv.row_change_summary(po, pu, spec).count() == rv.row_change_summary(base_o, base_u, SPEC).count()


def test_report_run_columns_and_release_number(spark):
    from revisa.operators import issues as iss
    from revisa.operators import resolve as rs

    o, u = frames(spark)
    issues = iss.check_revision(o, u, SPEC, materialize=False).limit(5)
    rep = iss.report(issues, o, u, SPEC, run={"command": "revise edited.parquet", "version": "abc123", "run_date": "2026-12-03"})
    row = rep.first()
    assert (row["command"], row["version"], row["run_date"]) == ("revise edited.parquet", "abc123", "2026-12-03")
    # Q18: the release number is compared as a number, not as a suffix
    assert rs.release_matches(41, "REL 41") and not rs.release_matches(41, "REL 141")


def test_key_frame_equals_prepared_keys(spark):
    import dataclasses

    o = fx.rev_updated(spark, SF)
    full = rv.prepare(o, SPEC).where(F.col(rv.KEY).isNotNull()).select("ord", rv.KEY)
    fast = rv.key_frame(o, SPEC)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, fast.collect()))
    other = dataclasses.replace(SPEC, blank_check=("name", "segment"))
    full2 = rv.prepare(o, other).where(F.col(rv.KEY).isNotNull()).select("ord", rv.KEY)
    assert sorted(map(tuple, full2.collect())) == sorted(map(tuple, rv.key_frame(o, other).collect()))
