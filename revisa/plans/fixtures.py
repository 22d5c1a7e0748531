"""Revision fixtures derived from the given test tables, as DataFrame code.

Each builder reads the base tables of ``sf_dir`` and derives a baseline / edited pair
(or a vocabulary, rule, list-cell, grid or documentation table) whose size grows with
the data.  The same shapes are written as SQL CTEs in :mod:`revisa.plans.oracle_sql`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.spec import RevisionSpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over all cores where the files give fewer tasks than that; a compact file of many rows is one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _case(*pairs, otherwise) -> Column:
    """``CASE WHEN c1 THEN v1 ... ELSE otherwise END``."""
    expr = None
    for cond, val in pairs:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(otherwise)


def _union(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ---------------------------------------------------------------- fixture R

R_COLUMNS = ("id", "sort_major", "sort_minor", "realm", "family", "name", "kind", "tokens", "segment", "balance", "notes")

R_SPEC = RevisionSpec(
    key="id",
    columns=R_COLUMNS,
    key_pattern=r"^CU(\d+)$",
    read_only=("realm", "family", "balance", "sort_major"),
    updatable=(
        ("sort_minor", "minor_sort"),
        ("name", "entry_name"),
        ("kind", "entry_type"),
        ("tokens", "accessions"),
        ("segment", "segment_name"),
        ("notes", "notes"),
    ),
    insertable=(
        ("major_sort", "sort_major"),
        ("minor_sort", "sort_minor"),
        ("entry_name", "name"),
        ("entry_type", "kind"),
        ("accessions", "tokens"),
        ("segment_name", "segment"),
        ("notes", "notes"),
    ),
    kinds=(("sort_major", "int"), ("sort_minor", "int"), ("kind", "type")),
    blank_check=tuple(c for c in R_COLUMNS if c != "notes"),
    removal_column="sort_major",
    list_column="tokens",
    name_column="name",
    context_columns=("name", "kind", "tokens", "segment"),
    target_table="entries",
)


def rev_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spread(table(spark, sf_dir, "customer"))
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            (k + 2).alias("ord"),
            F.concat(F.lit("CU"), _s(k)).alias("id"),
            _s("c_nationkey").alias("sort_major"),
            _s(k % 100).alias("sort_minor"),
            F.col("r_name").alias("realm"),
            F.col("n_name").alias("family"),
            F.col("c_name").alias("name"),
            F.when(k % 3 == 0, F.lit("E")).otherwise(F.lit("A")).alias("kind"),
            F.concat(F.lit("S1: T"), _s(k), F.lit("; S2: T"), _s(k + 1000000)).alias("tokens"),
            F.col("c_mktsegment").alias("segment"),
            _s(F.col("c_acctbal").cast("decimal(18,2)")).alias("balance"),
            F.lit(None).cast("string").alias("notes"),
        )
    )


def rev_updated(spark: SparkSession, sf_dir: str, original: DataFrame | None = None) -> DataFrame:
    o = original if original is not None else rev_original(spark, sf_dir)
    k = F.col("ord") - 2
    c = F.col
    edited = o.where(k % 13 != 0).select(
        "ord",
        _case(
            (k % 83 == 4, F.concat(F.lit("CU"), _s(k + 50000000))),
            (k % 89 == 5, F.concat(F.lit("XX"), c("id"))),
            (k % 11 == 1, F.concat(F.lit(" "), F.lower(c("id")), F.lit(" "))),
            otherwise=c("id"),
        ).alias("id"),
        F.when(k % 41 == 7, F.lit(" Abolish")).otherwise(c("sort_major")).alias("sort_major"),
        _case(
            (k % 67 == 14, F.concat(c("sort_minor"), F.lit(".0"))),
            (k % 71 == 15, F.lit("x7")),
            otherwise=c("sort_minor"),
        ).alias("sort_minor"),
        "realm",
        F.when(k % 31 == 5, F.lit("NATION_X")).otherwise(c("family")).alias("family"),
        _case(
            (k % 29 == 4, F.concat(c("name"), F.lit(" rev"))),
            (k % 37 == 5, F.concat(c("name"), F.lit("\u00a0"))),
            otherwise=c("name"),
        ).alias("name"),
        _case((k % 73 == 16, F.lit("exemplar")), (k % 79 == 17, F.lit("zzz")), otherwise=c("kind")).alias("kind"),
        _case(
            (k % 43 == 10, F.replace(c("tokens"), F.lit("S1:"), F.lit("SEG1:"))),
            (k % 53 == 11, F.replace(c("tokens"), F.lit("; "), F.lit(";\n  "))),
            (k % 59 == 12, F.replace(c("tokens"), F.lit("T"), F.lit("U"))),
            (k % 61 == 13, F.lit(None).cast("string")),
            otherwise=c("tokens"),
        ).alias("tokens"),
        _case(
            (k % 17 == 1, F.lower(c("segment"))),
            (k % 19 == 2, F.lit("SPACE TOOLS")),
            (k % 23 == 3, F.concat(F.lit(" "), c("segment"), F.lit(" "))),
            (k % 47 == 8, F.lit(" ")),
            otherwise=c("segment"),
        ).alias("segment"),
        "balance",
        F.when(k % 21 == 0, F.lit("checked")).otherwise(c("notes")).alias("notes"),
    )
    copies = o.where(k % 97 == 7).withColumn("ord", c("ord") + 5000000)
    i = F.floor((k - 6) / 37).cast("bigint")
    new_rows = (
        o.where(k % 37 == 6)
        .withColumn("i", i)
        .select(
            (c("ord") + 6000000).alias("ord"),
            F.lit(None).cast("string").alias("id"),
            "sort_major",
            F.lit("1").alias("sort_minor"),
            "realm",
            "family",
            F.concat(F.lit("New "), c("name")).alias("name"),
            "kind",
            F.concat(
                F.lit("N"),
                _s("i"),
                F.when(c("i") % 6 == 5, F.lit(";Z")).otherwise(F.lit(";N")),
                _s(c("i") + 1),
                F.when(c("i") % 5 == 4, F.concat(F.lit(";t"), _s(k))).otherwise(F.lit("")),
            ).alias("tokens"),
            "segment",
            "balance",
            "notes",
        )
    )
    blank = o.where(k % 211 == 9).select(
        (c("ord") + 7000000).alias("ord"),
        F.lit(" ").alias("id"),
        *[F.lit(None).cast("string").alias(x) for x in R_COLUMNS[1:-1]],
        F.lit("only a note").alias("notes"),
    )
    return _union(edited, copies, new_rows, blank)


def rev_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline with second and third originals of some keys, which differ from the first."""
    o = rev_original(spark, sf_dir)
    k = F.col("ord") - 2
    second = o.where(k % 7 == 1).withColumn("ord", F.col("ord") + 8000000).withColumn("name", F.concat("name", F.lit(" b"))).withColumn("sort_minor", F.lit("77"))
    third = o.where(k % 21 == 1).withColumn("ord", F.col("ord") + 9000000).withColumn("notes", F.lit("third")).withColumn("segment", F.lit(None).cast("string"))
    return _union(o, second, third)


def rev_export(spark: SparkSession, sf_dir: str, original: DataFrame | None = None) -> DataFrame:
    o = original if original is not None else rev_original(spark, sf_dir)
    k = F.col("ord") - 2
    c = F.col
    main = o.where(k % 101 != 3).select(
        "ord",
        F.concat(F.lit('=HYPERLINK("http://example.org/'), c("id"), F.lit('","'), c("id"), F.lit('")')).alias("id"),
        "sort_major",
        F.concat(c("sort_minor"), F.lit(".0")).alias("sort_minor"),
        "realm",
        "family",
        "name",
        F.when(c("kind") == "E", F.lit("Exemplar")).otherwise(F.lit("Additional")).alias("kind"),
        "tokens",
        "segment",
        F.when(k % 103 == 4, F.lit("0.00")).otherwise(c("balance")).alias("balance"),
        "notes",
    )
    copies = o.where(k % 107 == 6).withColumn("ord", c("ord") + 5000000)
    extra = o.where(k % 109 == 8).select(
        (c("ord") + 6000000).alias("ord"),
        F.concat(F.lit("CU"), _s(c("ord") + 60000000)).alias("id"),
        *R_COLUMNS[1:],
    )
    return _union(main, copies, extra)


# ---------------------------------------------------------------- fixture V

def vocab_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    seg = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("value")).distinct()
    # The segment list is a distinct set of a low-cardinality column: a handful of rows,
    # so one ordered window over it is bounded.
    seg = seg.select(
        F.lit("segment").alias("col"), "value", (F.row_number().over(Window.orderBy("value")) + 1).cast("bigint").alias("ord")
    )
    lit_rows = spark.createDataFrame([("kind", "E", 2), ("kind", "A", 3)], "col string, value string, ord bigint")
    return seg.unionByName(lit_rows).unionByName(_items(spark, sf_dir, "p_partkey % 13 <> 0", F.col("name"), 100))


def _items(spark: SparkSession, sf_dir: str, where: str, value: Column, first: int) -> DataFrame:
    """A vocabulary column that grows with the data: one value for each part."""
    p = table(spark, sf_dir, "part").where(where).withColumn("name", F.concat(F.col("p_name"), F.lit(" "), _s("p_partkey")))
    return p.select(F.lit("item").alias("col"), value.alias("value"), (F.col("p_partkey") + first).cast("bigint").alias("ord"))


def vocab_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    item, key = F.col("col") == "item", F.col("ord") - 100
    base = vocab_original(spark, sf_dir).where((F.col("value") != "MACHINERY") & ~(item & (key % 17 == 0)))
    base = base.withColumn("value", F.when(item & (key % 11 == 5), F.upper("value")).otherwise(F.col("value")))
    new = F.concat(F.lit(" "), F.replace(F.col("name"), F.lit(" "), F.lit("-")), F.lit(" "))
    for where, first in (("p_partkey % 13 = 0", 500000), ("p_partkey % 26 = 0", 900000)):
        base = base.unionByName(_items(spark, sf_dir, where, new, first))
    extra = spark.createDataFrame(
        [("segment", "Space-Tools", 20), ("segment", "auto mobile", 21), ("segment", " GARDEN ", 22), ("segment", "GARDEN", 23), ("size", "S", 2)],
        "col string, value string, ord bigint",
    )
    return base.unionByName(extra)


# ---------------------------------------------------------------- fixture M

def mask_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("part", "p_type", "ECO%"), ("part", "p_brand", "Brand#_3"), ("orders", "o_orderstatus", "F")],
        "table_name string, col string, pattern string",
    )


# ---------------------------------------------------------------- fixture L

def list_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    old = _case(
        (key % 11 == 0, F.lit(None).cast("string")),
        (key % 11 == 1, F.lit(" ; ")),
        otherwise=F.concat(F.lit("L1: P"), _s("o_custkey"), F.lit("; L2: P"), _s(F.col("o_custkey") + 1), F.lit(":x;:y;z:")),
    )
    t = o.select(key.alias("o_orderkey"), old.alias("old_cell"))
    m = key % 7
    old_c = F.col("old_cell")
    new = _case(
        (m == 1, F.replace(old_c, F.lit("; "), F.lit("\n"))),
        (m == 2, F.lower(old_c)),
        (m == 3, F.replace(old_c, F.lit("L1:"), F.lit("A:"))),
        (m == 4, F.concat(old_c, F.lit("; P0"))),
        (m == 5, F.lit(";")),
        otherwise=old_c,
    )
    return t.select(key.alias("id"), "old_cell", new.alias("new_cell"))


# ---------------------------------------------------------------- fixture N

def node_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of three releases; in the last one some ids are gone, some have two rows."""
    p = table(spark, sf_dir, "part")
    rel = F.col("rel")
    key = F.col("p_partkey")
    names = (
        p.select("p_partkey", "p_name", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("rel"))
        .where(~((rel == 3) & (key % 10 == 0)))
        .select(
            (rel * 100000 + key).alias("taxnode_id"),
            rel.alias("release_num"),
            key.alias("stable_id"),
            F.concat(F.col("p_name"), F.lit(" "), _s(F.when(rel < 3, key).otherwise(key % 150))).alias("name"),
        )
    )
    second = p.where(key % 7 == 3).select(
        (key + 900000000).alias("taxnode_id"), F.lit(3).alias("release_num"), key.alias("stable_id"), F.concat(F.col("p_name"), F.lit(" alt "), _s(key)).alias("name")
    )
    return names.unionByName(second)


def rev_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The edit, its new rows named after parts: known, gone and doubled ids, no name, and the removal name."""
    u = rev_updated(spark, sf_dir)
    k = F.col("ord") - 6000002
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_k"), F.concat(F.col("p_name"), F.lit(" "), _s("p_partkey")).alias("_part"))
    is_new = F.col("id").isNull() & F.col("name").startswith("New ")
    j = u.withColumn("_i", F.when(is_new, k % 200)).join(p, F.col("_i") == F.col("_k"), "left")
    name = _case((~is_new, F.col("name")), (k % 31 == 3, F.lit(None).cast("string")), (k % 31 == 4, F.lit("abolished")), otherwise=F.col("_part"))
    return j.withColumn("name", name).drop("_i", "_k", "_part")


def toc(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "v1"), (2, "v1"), (3, "v2")], "release_num int, version_tag string")


# ---------------------------------------------------------------- fixture S

def grid_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    col = F.col("col")
    part = p.select("p_partkey", "p_name", "p_brand", "p_size", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("col")).select(
        F.lit("part").alias("sheet"),
        (F.col("p_partkey") + 2).alias("row"),
        col,
        _case((col == 1, F.col("p_name")), (col == 2, F.col("p_brand")), otherwise=_s("p_size")).alias("value"),
    )
    reg = table(spark, sf_dir, "region").select(
        F.lit("region").alias("sheet"), (F.col("r_regionkey") + 2).cast("bigint").alias("row"), F.lit(1).alias("col"), F.col("r_name").alias("value")
    )
    return part.unionByName(reg)


def grid_new(spark: SparkSession, sf_dir: str, old: DataFrame | None = None) -> DataFrame:
    g = old if old is not None else grid_old(spark, sf_dir)
    row, col, val = F.col("row"), F.col("col"), F.col("value")
    part = g.where(F.col("sheet") == "part").select(
        "sheet",
        "row",
        "col",
        _case(
            ((row % 17 == 0) & (col == 1), F.replace(val, F.lit(" "), F.lit("\u00a0"))),
            ((row % 19 == 0) & (col == 2), F.lit("ignore this")),
            (row % 23 == 0, F.concat(val, F.lit("!"))),
            ((row % 29 == 0) & (col == 3), F.lit(None).cast("string")),
            otherwise=val,
        ).alias("value"),
    )
    nat = table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("sheet"), (F.col("n_nationkey") + 2).cast("bigint").alias("row"), F.lit(1).alias("col"), F.col("n_name").alias("value")
    )
    return part.unionByName(nat)


# ---------------------------------------------------------------- fixture G

def defs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions of the fixed headers, and one per part."""
    rows = [
        (2, "A", "sort_major", "first sort"),
        (3, "D - R", "Realm, fam-ily", "ranks"),
        (4, "S", "name", "text"),
        (5, "T", "kind", "Type:\n - E\n- a \n-\nx"),
        (6, "U", "Segment", "one of BUILDING, FURNITURE, machinery"),
        (7, "W", "id", "key"),
    ]
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.concat(F.col("p_name"), F.lit(" "), _s(k))
    bullets = F.concat(F.lit("Kind:\n - "), F.col("p_type"), F.lit("\n-"), F.col("p_brand"), F.lit(" "))
    each = p.select(
        (k + 100).cast("bigint").alias("ord"),
        F.when(k % 50 == 7, F.lit("D - R")).otherwise(F.lit("P")).alias("col"),
        _case((k % 3 == 0, F.concat(F.upper(name), F.lit(", "), name)), (k % 3 == 1, F.replace(name, F.lit(" "), F.lit("-"))), otherwise=name).alias("heading"),
        F.when(k % 4 == 0, F.concat(F.lit("any "), F.col("p_type"))).otherwise(bullets).alias("definition"),
    )
    return spark.createDataFrame(rows, "ord bigint, col string, heading string, definition string").unionByName(each)


def doc_headers(spark: SparkSession, sf_dir: str, fixed, first: int, picked: str = "true") -> DataFrame:
    """(pos, header): the fixed headers, then the parts' names in several spellings, some unknown."""
    p = table(spark, sf_dir, "part").where(picked)
    k = F.col("p_partkey")
    name = F.concat(F.col("p_name"), F.lit(" "), _s(k))
    each = p.select((k + 1000).cast("int").alias("pos"), _case((k % 4 == 1, F.upper(name)), (k % 4 == 2, F.concat(name, F.lit(" x"))), (k % 4 == 3, F.replace(name, F.lit(" "), F.lit("_"))), otherwise=name).alias("header"))
    return spark.createDataFrame(list(enumerate(fixed, start=first)), "pos int, header string").unionByName(each)


def doc_values(spark: SparkSession, sf_dir: str, headers) -> DataFrame:
    """(header, value, ord): the vocabulary's values of some headers, then a value for each part."""
    v = vocab_updated(spark, sf_dir).where(F.col("col").isin(list(headers))).select(F.col("col").alias("header"), "value", "ord")
    k = F.col("p_partkey")
    value = _case((k % 5 == 0, F.lower("p_type")), (k % 5 == 1, F.col("p_brand")), (k % 5 == 2, F.lit("zzz")), otherwise=F.col("p_type"))
    header = F.concat(F.col("p_name"), F.lit(" "), _s(k), F.when(k % 11 == 10, F.lit(" gone")).otherwise(F.lit("")))
    return v.unionByName(table(spark, sf_dir, "part").select(header.alias("header"), value.alias("value"), (k + 100).cast("bigint").alias("ord")))


# ---------------------------------------------------------------- fixture B

B_COLUMNS = ("id", "owner", "status", "priority", "price", "day")

B_SPEC = RevisionSpec(
    key="id",
    columns=B_COLUMNS,
    key_pattern=r"^CU(\d+)$",
    read_only=("owner", "day"),
    updatable=(("status", "status"), ("priority", "priority"), ("price", "price")),
    insertable=(("owner", "owner"), ("status", "status"), ("priority", "priority"), ("price", "price"), ("day", "day")),
    blank_check=B_COLUMNS,
    target_table="orders_curated",
)


def big_original(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        (F.col("o_orderkey") + 2).alias("ord"),
        F.concat(F.lit("CU"), _s("o_orderkey")).alias("id"),
        _s("o_custkey").alias("owner"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        _s(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
        _s(F.col("o_orderdate").cast("date")).alias("day"),
    )


def big_updated(spark: SparkSession, sf_dir: str, original: DataFrame | None = None) -> DataFrame:
    b = original if original is not None else big_original(spark, sf_dir)
    o = F.col("ord")
    return b.where(o % 23 != 0).select(
        "ord",
        F.when(o % 997 == 3, F.lit(None).cast("string")).otherwise(F.col("id")).alias("id"),
        "owner",
        F.when(o % 13 == 0, F.lower("status")).otherwise(F.col("status")).alias("status"),
        F.when(o % 17 == 0, F.replace(F.col("priority"), F.lit("-"), F.lit(" - "))).otherwise(F.col("priority")).alias("priority"),
        F.when(o % 19 == 0, F.lit("0.00")).otherwise(F.col("price")).alias("price"),
        "day",
    )
