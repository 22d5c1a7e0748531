"""Controlled vocabularies as long tables ``(col, value, ord)``.

Vocabulary tables are normally small, but nothing here assumes it: every operator is an
aggregate or a join whose strategy Catalyst picks from size statistics (a broadcast only
happens under ``spark.sql.autoBroadcastJoinThreshold``, which is a checked size).
Rows of a value stay in long form, one row each; nothing is collected into lists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators.positions import positioned

# Issue texts of the vocabulary check.
MSG_BLANK = "Column '{col}' must not be blank; select a value from 'Column Values'."
MSG_ADJUSTED = "Column '{col}' value '{value}' adjusted to '{corrected}' to match 'Column Values'."
MSG_NOT_LISTED = "Column '{col}' contains '{value}' which is not listed in 'Column Values'."


def normalised(vocab: DataFrame) -> DataFrame:
    """Blank values dropped, values trimmed: ``(col, value, ord)``."""
    return vocab.select(T.norm("col").alias("col"), T.norm("value").alias("value"), "ord").where(F.col("value").isNotNull() & F.col("col").isNotNull())


def value_rows(vocab: DataFrame) -> DataFrame:
    """AGG-03: every row of every value, per column: ``(col, value, ord)``."""
    return normalised(vocab).select("col", "value", "ord")


def per_value(rows: DataFrame) -> DataFrame:
    """One row per value of :func:`value_rows`: its first row and its number of rows."""
    return rows.groupBy("col", "value").agg(F.min("ord").alias("first_ord"), F.count(F.lit(1)).alias("n_rows"))


def distinct_values(vocab: DataFrame) -> DataFrame:
    """AGG-04: distinct non-blank values per column."""
    return normalised(vocab).select("col", "value").distinct()


def canonical_first(vocab: DataFrame) -> DataFrame:
    """AGG-05: first value (by row) of each canonical form, per column."""
    n = normalised(vocab).withColumn("canon", T.canonical_value("value"))
    return n.groupBy("col", "canon").agg(F.min(F.struct("ord", "value")).alias("f")).select("col", "canon", F.col("f.value").alias("value"))


def added(original: DataFrame, updated: DataFrame) -> DataFrame:
    """JN-08: all rows of the values the updated vocabulary has and the original one lacks (per column)."""
    return value_rows(updated).join(distinct_values(original), ["col", "value"], "left_anti")


def removed(original: DataFrame, updated: DataFrame) -> DataFrame:
    """JN-09: all rows of the values the original vocabulary has and the updated one lacks."""
    return value_rows(original).join(distinct_values(updated), ["col", "value"], "left_anti")


def not_in_reference(values: DataFrame, reference: DataFrame) -> DataFrame:
    """JN-07: vocabulary rows whose value is not in the reference set of their column.

    ``reference`` is ``(col, value)``; columns without a reference set are not checked.
    """
    ref = reference.select(T.norm("col").alias("col"), T.norm("value").alias("value")).where(F.col("value").isNotNull()).distinct()
    checked = normalised(values).join(ref.select("col").distinct(), "col", "left_semi")
    return checked.join(ref, ["col", "value"], "left_anti")


def correct_wide(edited: DataFrame, vocab: DataFrame, columns) -> DataFrame:
    """JN-10 in place: each constrained column is corrected inside its own row.

    Per constrained column, one left join to that column's allowed values and one to its
    canonical forms (vocabulary-sized; Catalyst broadcasts them under the size threshold,
    otherwise they are ordinary shuffled joins).  Rows never leave their row: no explode,
    pivot or join back.  Adds ``_fix_<col>`` = ``struct(value, message, severity)``; the
    case table follows the reference (SURVEY §7.3).
    """
    voc = normalised(vocab)
    allowed = voc.select("col", "value").distinct()
    canon = canonical_first(vocab)
    out = edited
    for c in [c for c in columns if c in edited.columns]:
        a = allowed.where(F.col("col") == c).select(F.col("value").alias("_a"), F.lit(True).alias("_in"))
        k = canon.where(F.col("col") == c).select(F.col("canon").alias("_k"), F.col("value").alias("_corr"))
        out = out.withColumn("_v", T.norm(c)).withColumn("_cn", T.canonical_value("_v"))
        out = out.join(a, out["_v"] == a["_a"], "left").join(k, out["_cn"] == k["_k"], "left")
        in_list = F.coalesce(F.col("_in"), F.lit(False))
        corr, v, raw = F.col("_corr"), F.col("_v"), F.col(c)
        adjust = (in_list & (raw != corr) & (corr == v)) | (~in_list & corr.isNotNull())
        msg = (
            F.when(v.isNull(), F.lit(MSG_BLANK.format(col=c)))
            .when(adjust, F.concat(F.lit(f"Column '{c}' value '"), v, F.lit("' adjusted to '"), corr, F.lit("' to match 'Column Values'.")))
            .when(~in_list & corr.isNull(), F.concat(F.lit(f"Column '{c}' contains '"), v, F.lit("' which is not listed in 'Column Values'.")))
        )
        sev = F.when(v.isNull() | adjust, F.lit("WARNING")).when(msg.isNotNull(), F.lit("ERROR"))
        fix = F.struct(F.when(v.isNotNull() & adjust, corr).otherwise(raw).alias("value"), msg.alias("message"), sev.alias("severity"))
        out = out.withColumn("_fix_" + c, fix).drop("_v", "_cn", "_a", "_in", "_k", "_corr")
    return out


def correct(edited: DataFrame, vocab: DataFrame, columns) -> DataFrame:
    """JN-10 report: ``(ord, column, value, message, severity)`` per row and constrained
    column (``value`` after correction; ``message`` null when there is nothing to say)."""
    constrained = [c for c in columns if c in edited.columns]
    w = correct_wide(edited, vocab, constrained)
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col("_fix_" + c).alias("f")) for c in constrained]))
    return w.select("ord", cells.alias("x")).select("ord", "x.column", "x.f.value", "x.f.message", "x.f.severity")


def apply_corrections(wide: DataFrame, edited_columns, columns) -> DataFrame:
    """Q5: the corrected frame later checks read (from :func:`correct_wide`)."""
    return wide.select(*[F.col("_fix_" + c + ".value").alias(c) if c in columns else F.col(c) for c in edited_columns])


def not_in_list(df: DataFrame, vocab: DataFrame, columns, exact: bool = True) -> DataFrame:
    """JN-21 / JN-22: cells whose text is not in their column's list: ``(ord, column, value)``.

    ``exact`` compares the raw text (the highlight rule of the editor copy); otherwise
    trimmed values (the allowed-value check).  Blank cells are not reported.
    """
    cols = [c for c in columns if c in df.columns]
    cells = df.select("ord", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])).alias("x")).select(
        "ord", "x.column", "x.value"
    )
    cells = cells.where(T.norm("value").isNotNull())
    if exact:
        lists = vocab.select(F.col("col").alias("column"), "value").distinct()
    else:
        lists = normalised(vocab).select(F.col("col").alias("column"), "value").distinct()
        cells = cells.withColumn("value", T.norm("value"))
    return cells.join(lists, ["column", "value"], "left_anti").select("ord", "column", "value")


def build(literal_lists: dict, table_columns: list[tuple[str, DataFrame, str, str]], spark) -> DataFrame:
    """SET-05: one vocabulary from literal lists and table columns, blanks dropped, not de-duplicated.

    ``table_columns``: ``(col, df, value_column, order_column)``.
    """
    parts = []
    if literal_lists:
        rows = [(col, v, i) for col, vals in literal_lists.items() for i, v in enumerate(vals, start=1)]
        parts.append(spark.createDataFrame(rows, "col string, value string, ord bigint"))
    for col, df, vcol, ocol in table_columns:
        parts.append(df.select(F.lit(col).alias("col"), F.col(vcol).cast("string").alias("value"), F.col(ocol).cast("bigint").alias("ord")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(T.norm("value").isNotNull())


def sort_vocab(vocab: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """SRT-01 / SRT-02: ``position`` by column, trimmed value (case-insensitive by default) and row."""
    key = T.norm("value") if case_sensitive else F.lower(T.norm("value"))
    return positioned(vocab.withColumn("sort_key", key), [F.col("col"), F.col("sort_key"), F.col("ord")]).orderBy("position")


def insert_order(values: DataFrame) -> DataFrame:
    """SRT-04: new values with their ``position`` by column and value, without regard to case."""
    keyed = values.withColumn("col_key", F.lower("col")).withColumn("value_key", F.lower("value"))
    return positioned(keyed, [F.col("col_key"), F.col("value_key"), F.col("col"), F.col("value")]).orderBy("position")


def route_inserts(new_values: DataFrame, routes: DataFrame) -> DataFrame:
    """CHG-05: route the rows of new vocabulary values to a table and its columns by column name.

    ``routes``: ``(col, table_name, target_columns)`` with ``target_columns`` a comma list;
    unrouted values get status ``skipped``.
    """
    r = routes.select(F.lower("col").alias("_lc"), "table_name", "target_columns")
    j = new_values.withColumn("_lc", F.lower("col")).join(r, "_lc", "left").drop("_lc")
    return j.withColumn("status", F.when(F.col("table_name").isNull(), F.lit("skipped")).otherwise(F.lit("insert")))


def render_inserts(routed: DataFrame) -> DataFrame:
    """CHG-09 for vocabulary inserts: ``(col, value, ord, statement)``.

    A comment for every source row of a routed value, and per value one INSERT (``ord``: its
    first row) or, unrouted, one note.  The rows are never collected into one text.
    """
    named = F.concat(F.lit("-- Column '"), T.flatten_newlines("col"), F.lit("' value '"), T.flatten_newlines("value"), F.lit("' from 'Column Values' row "), F.col("ord").cast("string"))
    comments = routed.where(F.col("status") == "insert").select("col", "value", "ord", named.alias("statement"))
    cols = F.split("target_columns", ",")
    lit = F.concat(F.lit("'"), F.replace(F.col("value"), F.lit("'"), F.lit("''")), F.lit("'"))
    stmt = F.concat_ws(
        "\n",
        F.concat(F.lit("INSERT INTO "), F.col("table_name"), F.lit(" (")),
        F.concat(F.lit("    "), F.array_join(cols, ",\n    ")),
        F.lit(") VALUES ("),
        F.concat(F.lit("    "), F.array_join(F.transform(cols, lambda _: lit), ",\n    ")),
        F.lit(");"),
    )
    note = F.concat(F.lit("-- No database mapping configured for column '"), T.flatten_newlines("col"), F.lit("' with value '"), T.flatten_newlines("value"), F.lit("'; skipping."))
    once = routed.groupBy("col", "value", "table_name", "target_columns", "status").agg(F.min("ord").alias("ord"))
    return comments.unionByName(once.select("col", "value", "ord", F.when(F.col("status") == "insert", stmt).otherwise(note).alias("statement")))
