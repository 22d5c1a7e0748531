"""Catalog: masking rules on part and orders (fixture M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from revisa.operators import mask as mk
from revisa.plans import fixtures as fx
from revisa.plans import oracle_sql as S
from revisa.plans.registry import register

MASKED = {"part": "p_partkey", "orders": "o_orderkey"}


def m_sql(body: str, extra=()) -> str:
    return S.with_fixtures(["mask_rules"], body, list(extra))


def _rules(spark):
    return mk.read_rules(fx.mask_rules(spark))


def _sql_pred(table: str, null_as_empty: bool) -> str:
    preds = []
    for t, c, p in RULES:
        if t == table:
            cell = f"coalesce({c}, '')" if null_as_empty else c
            preds.append(f"{cell} LIKE {S.q(p)}")
    return " OR ".join(preds)


# The rules of fixture M, as the oracle spells them.
RULES = [("part", "p_type", "ECO%"), ("part", "p_brand", "Brand#_3"), ("orders", "o_orderstatus", "F")]


@register("like_match", m_sql("SELECT p_partkey, p_type LIKE 'ECO%' AS m_type, p_brand LIKE 'Brand#_3' AS m_brand FROM part"))
def like_match(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    return p.select("p_partkey", mk.like("p_type", "ECO%").alias("m_type"), mk.like("p_brand", "Brand#_3").alias("m_brand"))


#: Cells that the fixture blanks: a column and the rows by key.
HOLES = {"part": ("p_brand", "p_partkey % 9 = 4"), "orders": ("o_orderstatus", "o_orderkey % 11 = 5")}


def _holed(df, table):
    column, where = HOLES[table]
    return df.withColumn(column, F.when(~F.expr(where), F.col(column)))


def _masked(spark, sf_dir, null_as_empty):
    rules = _rules(spark)
    out = None
    for t, key in MASKED.items():
        df = mk.mask_table(_holed(fx.table(spark, sf_dir, t), t), t, rules, null_as_empty).select(F.lit(t).alias("table_name"), F.col(key).alias("row_key"))
        out = df if out is None else out.unionByName(df)
    return out


def _masked_sql(null_as_empty):
    return m_sql(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, {k} AS row_key FROM (SELECT * REPLACE (CASE WHEN NOT ({HOLES[t][1]}) THEN {HOLES[t][0]} END AS {HOLES[t][0]}) FROM {t}) WHERE NOT ({_sql_pred(t, null_as_empty)})" for t, k in MASKED.items())
    )


@register("mask_rows", _masked_sql(True))
def mask_rows(spark, sf_dir):
    return _masked(spark, sf_dir, True)


@register("mask_rows_sql_nulls", _masked_sql(False))
def mask_rows_sql_nulls(spark, sf_dir):
    return _masked(spark, sf_dir, False)


#: Rules that cannot be applied, and why.
BAD_RULES = [("part", " ", "x%", "blank_field"), ("orders", "o_orderstatus", None, "blank_field"), ("orders", "no_such", "y%", "unknown_column"), ("nowhere", "p_type", "z", "unknown_column")]


@register(
    "mask_rules_valid",
    m_sql(
        "SELECT r.table_name, r.col, r.pattern, 'ok' AS status, c.n_matched FROM mask_rules r JOIN ("
        + " UNION ALL ".join(
            f"SELECT {S.q(t)} AS table_name, {S.q(c)} AS col, {S.q(p)} AS pattern, cast(sum(CASE WHEN coalesce({c}, '') LIKE {S.q(p)} THEN 1 ELSE 0 END) AS bigint) AS n_matched FROM {t}"
            for t, c, p in RULES
        )
        + ") c ON r.table_name = c.table_name AND r.col = c.col AND r.pattern = c.pattern UNION ALL "
        + " UNION ALL ".join(f"SELECT {S.q(t)}, {S.q(c)}, {'NULL' if p is None else S.q(p)}, {S.q(status)}, NULL" for t, c, p, status in BAD_RULES)
    ),
)
def mask_rules_valid(spark, sf_dir):
    bad = spark.createDataFrame([r[:3] for r in BAD_RULES], "table_name string, col string, pattern string")
    rules_df = fx.mask_rules(spark).unionByName(bad)
    rules = mk.read_rules(rules_df, strict=False)
    tables = {t: fx.table(spark, sf_dir, t) for t in MASKED}
    status = mk.rule_status(rules_df, {t: df.columns for t, df in tables.items()})
    counts = None
    for t, df in tables.items():
        m = mk.matched_counts(df, t, rules)
        counts = m if counts is None else counts.unionByName(m)
    return status.join(counts, ["table_name", "col", "pattern"], "left")
