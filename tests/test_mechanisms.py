"""Mechanisms behind the operators: ordered folds, hot keys, components, split records, positions, digests, publishing."""

import csv
import glob
import hashlib
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from revisa.operators import components as cp
from revisa.operators import issues as iss
from revisa.operators import positions as ps
from revisa.operators import revision as rv
from revisa.operators import skew
from revisa.operators import tokens as tk
from revisa.operators.fold import fold_entries
from revisa.sources import digest as dg
from revisa.sources import publish as pub
from revisa.sources import records as rec
from revisa.sources import tables as src
from tests_support import sequential_claims

TARGETS = {"a": False, "b": True}
ENTRY = "key_num long, ord long, o_ord long, ch array<struct<target: string, old_value: string, new_value: string>>"


def folder():
    return tempfile.mkdtemp(prefix="revisa-test-")


def in_sequence(rows, entries, guard):
    """Every entry against every row of its key, one after another."""
    out = []
    for key, a, b in rows:
        state, told = {"a": a, "b": b}, None
        for k, _, _, ch in sorted(entries, key=lambda e: (e[2], e[1])):
            if k != key:
                continue
            typed = [(t, *(int(v) if TARGETS[t] and v is not None else v for v in (old, new))) for t, old, new in ch]
            hit = (all if guard == "all" else any)(state[t] == old for t, old, _ in typed)
            told = "applied" if hit or told == "applied" else "guard_miss"
            if hit:
                state |= {t: new for t, _, new in typed}
        out.append((key, state["a"], state["b"], told))
    return sorted(out, key=str)


@pytest.mark.parametrize("guard", ["any", "all"])
@pytest.mark.parametrize("held", [10_000, 3])
def test_fold_applies_entries_in_order(spark, guard, held):
    rnd = random.Random(3)
    pick = lambda: rnd.choice(["x", "y", "z", None])
    number = lambda: rnd.choice([1, 2, None])
    rows = [(rnd.randint(1, 6), pick(), number()) for _ in range(60)]
    text = lambda v: None if v is None else str(v)
    entries = [
        (rnd.randint(1, 5), i % 3, i, [("a", pick(), pick())] * (i % 3 > 0) + [("b", text(number()), text(number()))] * (i % 3 != 1)) for i in range(50)
    ]
    stored = spark.createDataFrame(rows, "record_id long, a string, b long").repartition(3)
    got = fold_entries(stored, spark.createDataFrame(entries, ENTRY).repartition(2), "record_id", TARGETS, guard, held)
    assert sorted((tuple(r) for r in got.collect()), key=str) == in_sequence(rows, entries, guard)


def test_fold_of_a_key_with_very_many_entries(spark):
    n = 100_000
    entries = spark.range(n).select(
        F.lit(1).cast("long").alias("key_num"), F.lit(0).cast("long").alias("ord"), F.col("id").alias("o_ord"),
        F.array(F.struct(F.lit("b").alias("target"), F.col("id").cast("string").alias("old_value"), (F.col("id") + 1).cast("string").alias("new_value"))).alias("ch"),
    ).repartition(8)
    stored = spark.createDataFrame([(1, "x", 0), (1, "x", 50_000), (1, "x", -1)], "record_id long, a string, b long")
    got = sorted(tuple(r) for r in fold_entries(stored, entries, "record_id", TARGETS).collect())
    assert got == [(1, "x", -1, "guard_miss"), (1, "x", n, "applied"), (1, "x", n, "applied")]


def test_hot_keys_are_found_and_joined_alike(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 50}") for i in range(900)] + [(1000, None)], "i long, key string")
    lookup = spark.createDataFrame([("hot", 1), *((f"k{i}", i) for i in range(0, 50, 2))], "key string, v long")
    hot = skew.hot_keys(skew.row_counts(rows, "key"), "key", "_n", share=10, least=5)
    assert hot == ["hot"]
    assert skew.hot_keys(skew.row_counts(rows.where("i < 0"), "key"), "key", "_n") == []
    for how in ("inner", "left"):
        got, want = skew.join_unique(rows, lookup, "key", hot, how), rows.join(lookup, "key", how)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_rows_stay_spread(spark):
    """A key with a third of the rows: no task gets them all, as its rows are not shuffled."""
    rows = spark.range(0, 30_000, numPartitions=6).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"))
    lookup = spark.range(-1, 30_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    hot = skew.hot_keys(skew.row_counts(rows, "key"), "key", "_n", least=100)
    sizes = skew.join_unique(rows, lookup, "key", hot).where("key = -1").groupBy(F.spark_partition_id()).count().collect()
    assert hot == [-1] and len(sizes) == 6 and max(r["count"] for r in sizes) < 2_000


def brute_components(links):
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return {n: r for n, r in root.items() if n != r}


@pytest.mark.parametrize("held", [1_000_000, 4])
def test_components(spark, monkeypatch, held):
    monkeypatch.setattr(cp, "contracted", lambda links, f=cp.contracted: f(links, held))
    rnd = random.Random(held)
    links = [(rnd.randint(0, 80), rnd.randint(0, 80)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(300, 330)]
    links = [x for x in links if x[0] != x[1]]
    got = cp.components(spark.createDataFrame(links, "a long, b long").repartition(5))
    assert {r["node"]: r["root"] for r in got.collect()} == brute_components(links)


def claim_rows(seed):
    rnd = random.Random(seed)
    rows = [(i + 1, sorted({f"T{rnd.randint(0, 60)}" for _ in range(rnd.randint(0, 3))} | ({"HOT"} if i % 3 == 0 else set()))) for i in range(120)]
    return rows + [(1000 + i, [f"C{i}", f"C{i + 1}"]) for i in range(40)]


@pytest.mark.parametrize("walked", [tk.WALKED_PAIRS, 50, 0])
def test_claims_walked_and_in_rounds_agree(spark, walked):
    rows = claim_rows(9)
    cands = spark.createDataFrame([(o,) for o, _ in rows], "ord long")
    pairs = spark.createDataFrame([(o, t) for o, ts in rows for t in ts], "ord long, token string")
    got = {r["ord"]: (r["accepted"], r["reused"]) for r in tk.greedy_claims(cands, pairs, walked).collect()}
    want = sequential_claims(rows)
    assert {o: a for o, (a, _) in got.items()} == want
    holder = {t: o for o, ts in rows if want[o] for t in ts}
    for o, ts in rows:
        told = ", ".join(f"{t} (row {holder[t]})" for t in sorted(ts) if holder.get(t, o) < o) if not want[o] else None
        assert got[o][1] == told


def test_long_chain_of_claims_takes_few_jobs(spark):
    rows = [(i, [f"C{i}", f"C{i + 1}"]) for i in range(1000)]
    cands = spark.createDataFrame([(o,) for o, _ in rows], "ord long")
    pairs = spark.createDataFrame([(o, t) for o, ts in rows for t in ts], "ord long, token string")
    spark.sparkContext.setJobGroup("chain", "chain of claims")
    got = {r["ord"]: r["accepted"] for r in tk.greedy_claims(cands, pairs).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("chain")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == {i: i % 2 == 0 for i in range(1000)}
    assert len(jobs) < 40  # every shuffle of an adaptive query is a job; rounds alone would take over 500


def character_machine(line, inside, sep, escape):
    state, i = "quoted" if inside else "start", 0
    while i < len(line):
        c = line[i]
        if state == "quoted":
            if escape and c == escape:
                i += 1
            elif c == '"':
                if line[i + 1 : i + 2] == '"':
                    i += 1
                else:
                    state = "plain"
        elif c == sep:
            state = "start"
        elif state == "start" and c == '"':
            state = "quoted"
        else:
            state = "plain"
            i += bool(escape) and c == escape
        i += 1
    return state == "quoted"


def test_quote_state_of_lines():
    rnd = random.Random(1)
    for escape in (None, "\\"):
        quotes = rec.Quotes(",", escape)
        for _ in range(5000):
            line = "".join(rnd.choice('a",\\ b"') for _ in range(rnd.randint(0, 9)))
            for inside in (False, True):
                assert quotes.ends_inside(line, inside) == character_machine(line, inside, ",", escape), (line, inside)


def dump_of(seed, n, escape):
    """A dump with line breaks, quotes and separators inside fields, and stray quotes in plain ones."""
    rnd = random.Random(seed)
    rows, text = [], "a,b,c\n"
    for i in range(n):
        row = [str(i), "".join(rnd.choice(['"', "\n", ",", "x", " ", "\r\n", "é"]) for _ in range(rnd.choice([1, 3, 60]))), rnd.choice(['5" pipe', "plain", "y z"])]
        rows.append(tuple(row))
        quoted = row[1].replace('"', '""' if escape is None else escape + '"')
        text += f'{row[0]},"{quoted}",{row[2]}\n' + ("\n" if i % 10 == 0 else "")
    return rows, text


@pytest.mark.parametrize("size", ["64", "300", "128m"])
@pytest.mark.parametrize("escape", [None, "\\"])
def test_dump_cut_anywhere_reads_alike(spark, size, escape):
    rows, text = dump_of(int(size[:2]), 80, escape)
    path = os.path.join(folder(), "t.csv")
    with open(path, "w", newline="") as f:
        f.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        found = src.read_dump(spark, path, ["a", "b", "c"], sep=",", escape=escape or '"', python_escapes=True if escape else False)
        got = sorted((tuple(r) for r in found.collect()), key=lambda r: int(r[0]))
        parts = rec.lines(spark, path).select("_block").distinct().count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with open(path, newline="") as f:
        want = [tuple(r) for r in list(csv.reader(f, escapechar=escape)) if r][1:]
    assert want == rows and got == want
    assert (parts > 5) == (size != "128m")


def test_positions_and_running_sums(spark):
    rnd = random.Random(2)
    values = [rnd.choice([None, *range(20)]) for _ in range(300)]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v long").repartition(7)
    got = ps.positioned(rows, [F.col("v").asc_nulls_last(), F.col("i").desc()]).collect()
    want = sorted(range(300), key=lambda i: (values[i] is None, values[i] or 0, -i))
    assert [r["i"] for r in sorted(got, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in got) == list(range(1, 301))
    sums = {r["i"]: r["s"] for r in ps.running_sum(rows.select("i", F.coalesce("v", F.lit(0)).alias("v")), [F.col("i")], "v", "s").collect()}
    total = 0
    for i, v in enumerate(values):
        assert sums[i] == total
        total += v or 0
    assert ps.positioned(rows.where("i < 0"), [F.col("i")]).count() == 0


def test_ordinals_over_several_files(spark):
    d = folder()
    for k in (2, 0, 1):
        spark.range(k * 100, k * 100 + 37 + k).coalesce(1).write.parquet(f"{d}/t/p={k}")
    got = src.with_ordinal(spark, f"{d}/t").orderBy("ord").select("ord", "id").collect()
    assert [r["ord"] for r in got] == list(range(2, 2 + 37 * 3 + 3))
    assert [r["id"] for r in got] == [*range(37), *range(100, 138), *range(200, 239)]


def test_digest_counts_rows_in_any_order(spark):
    rows = [("a", 1), ("a", 1), (None, 2), ("", None), ("é", 3)]
    df = spark.createDataFrame(rows, "s string, n long")

    def digest(frame):
        seen, obs = dg.observed(frame)
        seen.write.format("noop").mode("overwrite").save()
        return obs.get["rows"], dg.digest_text(obs.get)

    def plain(rows):
        texts = ["".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r) for r in rows]
        hashes = [hashlib.md5(t.encode()).hexdigest() for t in texts]
        return "-".join(str(sum(int(h[at : at + 15], 16) for h in hashes)) for at in (0, 15))

    assert digest(df) == digest(df.repartition(4, "n")) == (5, plain(rows))
    assert digest(df.distinct()) == (4, plain(set(rows)))
    assert digest(df.where("n > 9")) == (0, "0-0")


STATEMENTS = [(2, 5, "UPDATE a;"), (2, 3, "UPDATE b;"), (1, 9, "DELETE c;")]


def stage_text(spark, path, name):
    files = sorted(glob.glob(os.path.join(pub.current_set(spark, path), name, "part-*")))
    return "".join(open(f).read() for f in files)


def test_publish_writes_stages_and_manifest(spark):
    path = os.path.join(folder(), "out")
    st = spark.createDataFrame(STATEMENTS, "stage int, ord long, statement string")
    told = {r["label"]: r for r in pub.publish(st, path, header_lines=["-- Generated by test"]).collect()}
    assert {k: r["n_rows"] for k, r in told.items()} == {"column_value_inserts": 0, "deletes": 1, "updates": 2, "inserts": 0}
    assert stage_text(spark, path, "stage_2_updates.sql").splitlines() == ["-- Generated by test", "UPDATE b;", "", "UPDATE a;", ""]
    assert stage_text(spark, path, "stage_3_inserts.sql").splitlines() == ["-- Generated by test", "-- No inserts required."]
    assert sorted((r["stage"], r["ord"], r["statement"]) for r in pub.read_statements(spark, path).collect()) == sorted(STATEMENTS)


def test_publish_that_fails_leaves_the_old_set(spark, monkeypatch):
    path = os.path.join(folder(), "out")
    st = spark.createDataFrame(STATEMENTS, "stage int, ord long, statement string")
    pub.publish(st, path)
    before = pub.current_set(spark, path)
    bad = st.withColumn("statement", F.when(F.col("stage") == 1, F.raise_error(F.lit("broken"))).otherwise(F.col("statement")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        pub.publish(bad, path)
    monkeypatch.setattr(pub, "_make_current", lambda *a: (_ for _ in ()).throw(RuntimeError("no rename")))
    with pytest.raises(RuntimeError, match="no rename"):
        pub.publish(st.where("stage = 1"), path)
    assert pub.current_set(spark, path) == before and pub.read_statements(spark, path).count() == 3
    monkeypatch.undo()
    pub.publish(st.where("stage = 1"), path)
    assert pub.read_statements(spark, path).count() == 1
    assert pub.drop_old_sets(spark, path) >= 2 and pub.read_statements(spark, path).count() == 1


def test_restore_puts_a_broken_swap_back(spark):
    base = folder()
    spark.range(3).write.parquet(f"{base}/entries")
    spark.range(5).write.parquet(f"{base}/entries_20260101")
    os.rename(f"{base}/entries", f"{base}/entries.old")  # a swap broken off between its renames
    told = {r["table_name"]: r["n_rows"] for r in src.restore(spark, base, "entries_20260101", ["id"], "entries").collect()}
    assert told == {"entries": 5, "entries_20260101": 5} and not os.path.exists(f"{base}/entries.old")


def test_error_probe_stops_at_the_first_error():
    """Later stages are not even built."""
    built = []

    class Stage:
        def __init__(self, bad):
            self.bad = bad

        where = limit = lambda self, *_: self

        def isEmpty(self):
            return not self.bad

    class Check(iss.RevisionCheck):
        def stages(self):
            for name, bad in (("a", False), ("b", True), ("c", True)):
                built.append(name)
                yield name, Stage(bad)

    assert Check(None, None, None).has_errors() and built == ["a", "b"]


def test_delta_columns_keep_new_rows_out_of_the_join(spark):
    from revisa.plans import fixtures as fx

    columns = fx.R_COLUMNS
    row = lambda i, key, name: (i, key, *[None] * 4, name, *[None] * 5)
    schema = "ord long, " + ", ".join(f"{c} string" for c in columns)
    spec = fx.R_SPEC
    o = rv.prepare(spark.createDataFrame([row(2, "CU1", "a"), row(3, "CU1", "b")], schema), spec)
    e = rv.prepare(spark.createDataFrame([row(2, "cu1", "x"), row(3, "CU1", "y"), row(4, None, "new"), row(5, "CU9", "z")], schema), spec)
    got = {r["ord"]: (r["n_changes"], r["changes"]) for r in rv.delta_columns(o, e, spec).collect()}
    assert got == {2: (1, "name:a"), 3: (1, "name:a"), 4: (1, "new isolate"), 5: (None, None)}
