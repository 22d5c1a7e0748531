"""Release building: sort, type, trim for the public, carry tables forward, changelog,
column widths, and the staged change-set output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators.positions import positioned

INT_TEXT = r"^[+-]?[0-9]+$"


def sort_keys(df: DataFrame, major: str, minor: str) -> DataFrame:
    """SRT-03: integer sort keys, blank = 0; a non-integer value is reported (``sort_error``)."""

    def key(c):
        t = T.strip_ws(F.coalesce(F.col(c), F.lit("")))
        return F.when(t == "", F.lit(0).cast("bigint")).when(t.rlike(INT_TEXT), t.try_cast("bigint"))

    err = F.concat_ws(
        "; ",
        *[F.when(key(c).isNull(), F.concat(F.lit(f"Non-integer sort value in '{c}': "), F.col(c))) for c in (major, minor)],
    )
    return df.select("*", key(major).alias("major_key"), key(minor).alias("minor_key"), F.nullif(err, F.lit("")).alias("sort_error"))


def sort_release(df: DataFrame, major: str, minor: str) -> DataFrame:
    """SRT-03: the release table with its ``position`` in (major, minor, row) order."""
    keyed = sort_keys(df, major, minor)
    return positioned(keyed, [F.coalesce("major_key", F.lit(0)), F.coalesce("minor_key", F.lit(0)), F.col("ord")])


def typed_release(df: DataFrame, int_columns, columns, keep=()) -> DataFrame:
    """SNK-01: integer columns as bigint, the rest text with absent = '' (``keep`` columns as is)."""
    return df.select(*keep, *[T.int_like(c).alias(c) if c in int_columns else F.coalesce(F.col(c), F.lit("")).alias(c) for c in columns])


def map_columns(df: DataFrame, mapping, keep=()) -> DataFrame:
    """SCH-07: data columns renamed to their stored names, ``(column, target)`` pairs."""
    return df.select(*keep, *[F.col(c).alias(t) for c, t in mapping])


def public_projection(df: DataFrame, marker: str) -> DataFrame:
    """SNK-07: drop the marker column and every column after it."""
    cols = df.columns
    return df.select(*cols[: cols.index(marker)]) if marker in cols else df


def public_tables(tables: dict, release_table: str, marker: str, internal=()) -> dict:
    """SNK-07: the public set of tables: the release trimmed at its marker, internal tables left out."""
    return {n: public_projection(df, marker) if n == release_table else df for n, df in tables.items() if n not in set(internal)}


def carry_forward(previous: dict, names, base: str) -> tuple[dict, DataFrame]:
    """SNK-08 (Q1 decided: every present table is copied): the tables copied below ``base``, and a
    status row per name: ``copied`` with number and digest of the copied rows, or ``missing``."""
    from revisa.sources.tables import copied

    spark = next(iter(previous.values())).sparkSession
    rows, tables = [], {}
    for n in names:
        if n in previous:
            path = f"{base.rstrip('/')}/{n}"
            told = copied(previous[n], path, n, n).first()
            tables[n] = spark.read.schema(previous[n].schema).parquet(path)
            rows.append((n, "copied", told["n_rows"], told["digest"]))
        else:
            rows.append((n, "missing", None, None))
    return tables, spark.createDataFrame(rows, "table_name string, status string, n_rows bigint, digest string")


def changelog_append(log: DataFrame, when: str, who: str, what: str) -> DataFrame:
    """SNK-09: one provenance row after the last filled row (``ord`` = last filled + 1).

    The last filled position is one aggregate value read on the driver."""
    filled = log.where(F.coalesce(T.norm("when"), T.norm("who"), T.norm("what")).isNotNull())
    last = filled.agg(F.max("ord")).first()[0] or 1
    row = log.sparkSession.createDataFrame([(int(last) + 1, when, who, what)], "ord bigint, when string, who string, what string")
    return log.select("ord", "when", "who", "what").unionByName(row)


def column_widths(df: DataFrame, columns, low: int = 8, high: int = 80, pad: int = 2, mode: str = "lines") -> DataFrame:
    """AGG-13: display width per column, one aggregate over the table unpivoted to
    ``(column, max_line, width)``.

    ``mode='lines'``: longest line (+pad), clamped to [low, high] (the release sheets).
    ``mode='text'``: longest whole value or the header name, +pad, unclamped (the issue table).
    """
    from revisa.functions.lists import LINE_BREAKS

    if mode == "text":
        aggs = [F.max(F.length(F.col(c).cast("string"))).alias(c) for c in columns]
    else:
        aggs = [F.max(F.array_max(F.transform(F.split(F.col(c).cast("string"), LINE_BREAKS), lambda s: F.length(s)))).alias(c) for c in columns]
    wide = df.agg(*aggs)
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("max_line")) for c in columns]))
    out = wide.select(stack.alias("s")).select("s.*")
    if mode == "text":
        return out.withColumn("width", (F.greatest(F.col("max_line"), F.length("column").cast("bigint")) + pad).cast("bigint"))
    return out.withColumn("width", F.least(F.lit(high), F.greatest(F.lit(low), F.col("max_line") + pad)).cast("bigint"))


STAGES = ((0, "column_value_inserts"), (1, "deletes"), (2, "updates"), (3, "inserts"))


def change_set_stages(rendered: dict, has_errors: bool = False) -> DataFrame:
    """SNK-05 + CHG-10: rendered statements with their stage number and label.

    ``rendered`` maps a stage label to a DataFrame with ``ord`` and ``statement``; when
    the check reported errors (one boolean from :func:`revisa.operators.issues.has_errors`)
    every statement carries a warning line."""
    parts = []
    for n, label in STAGES:
        if label in rendered:
            parts.append(rendered[label].select(F.lit(n).alias("stage"), F.lit(label).alias("label"), F.col("ord").cast("bigint").alias("ord"), "statement"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if has_errors:
        out = out.withColumn("statement", F.concat(F.lit(WARNING_LINE + "\n"), F.col("statement")))
    return out


WARNING_LINE = "-- WARNING: errors were reported; review the issue table before applying."


def stage_order(names: DataFrame) -> DataFrame:
    """SNK-06: stage files in natural order with their ``position``; only ``<prefix>_<n>...sql`` names count."""
    n = F.regexp_extract("name", r"^stage_(\d+).*\.sql$", 1)
    found = names.where(F.col("name").rlike(r"^stage_\d+.*\.sql$")).select("name", n.cast("bigint").alias("stage_num"))
    return positioned(found, [F.col("stage_num"), F.col("name")]).orderBy("position")
