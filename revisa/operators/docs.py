"""Documentation checks: every data header, grouped header and controlled value must be
documented in a definitions table ``(ord, col, heading, definition)``.

Headings are comma lists; matching is on match text (SCL-08) with the exact spelling
preferred.  Definitions are guard-sized (one row per documented column), values come
from vocabulary tables; everything stays a DataFrame join or aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import lists as L
from revisa.functions import match as M
from revisa.functions import text as T

RANGE_ROW = r"^D[\t-\r\x1c-\x20\x85\p{Z}]*-[\t-\r\x1c-\x20\x85\p{Z}]*R$"
NOTE = " (normalized match; text differs)"


def heading_tokens(defs: DataFrame) -> DataFrame:
    """(ord, pos, token, mt, definition, col) for every heading token of non-blank rows."""
    d = defs.select(
        "ord",
        T.strip_ws(F.coalesce("col", F.lit(""))).alias("col"),
        T.strip_ws(F.coalesce("heading", F.lit(""))).alias("heading"),
        T.strip_ws(F.coalesce("definition", F.lit(""))).alias("definition"),
    ).where((F.col("col") != "") | (F.col("heading") != "") | (F.col("definition") != ""))
    t = d.select("ord", "col", "definition", F.posexplode(L.list_tokens("heading")).alias("pos", "token"))
    return t.withColumn("mt", M.match_text("token")).where(F.col("mt") != "")


def spellings(tokens: DataFrame) -> DataFrame:
    """AGG-07: distinct spellings per match text with their first position."""
    return tokens.groupBy("mt", "token").agg(F.min(F.struct("ord", "pos")).alias("first")).select(
        "mt", "token", F.col("first.ord").alias("first_ord"), F.col("first.pos").cast("bigint").alias("first_pos")
    )


def choose(names: DataFrame, spell: DataFrame, name_col: str = "header") -> DataFrame:
    """AGG-06: per name, the exact spelling if present, else the first one (null: none)."""
    j = names.join(spell, "mt", "left")
    pref = F.struct(F.when(F.col("token") == F.col(name_col), 0).otherwise(1), F.col("first_ord"), F.col("first_pos"))
    g = j.groupBy(*[c for c in names.columns]).agg(F.min_by("token", F.when(F.col("token").isNotNull(), pref)).alias("matched"))
    return g.withColumn("exact", F.col("matched") == F.col(name_col))


def _status(df: DataFrame, missing_msg, mapped_msg) -> DataFrame:
    return df.withColumn("status", F.when(F.col("matched").isNull(), F.lit("missing")).otherwise(F.lit("mapped"))).withColumn(
        "message", F.when(F.col("matched").isNull(), missing_msg).otherwise(mapped_msg)
    )


def header_coverage(headers: DataFrame, defs: DataFrame) -> DataFrame:
    """JN-16: headers ``(pos, header)`` → matched heading or a missing issue."""
    h = headers.withColumn("mt", M.match_text("header"))
    c = choose(h, spellings(heading_tokens(defs)))
    note = F.when(F.col("exact"), F.lit("")).otherwise(F.lit(NOTE))
    return _status(
        c,
        F.concat(F.lit("Definitions are missing documentation for header '"), F.col("header"), F.lit("'")),
        F.concat(F.lit("Header map: '"), F.col("header"), F.lit("' -> '"), F.col("matched"), F.lit("'"), note),
    ).select("pos", "header", "matched", "exact", "status", "message")


def range_coverage(headers: DataFrame, defs: DataFrame) -> DataFrame:
    """JN-17: headers of the grouped range must be in the heading list of the grouped row
    (the last such row wins); no grouped row at all is one issue."""
    t = heading_tokens(defs).where(F.col("col").rlike(RANGE_ROW))
    last = t.agg(F.max("ord").alias("ord"))
    t = t.join(last, "ord", "left_semi")
    h = headers.withColumn("mt", M.match_text("header"))
    c = choose(h, spellings(t))
    note = F.when(F.col("exact"), F.lit("")).otherwise(F.lit(NOTE))
    out = _status(
        c,
        F.concat(F.lit("Grouped heading list is missing '"), F.col("header"), F.lit("'")),
        F.concat(F.lit("Range map: '"), F.col("header"), F.lit("' -> '"), F.col("matched"), F.lit("'"), note),
    ).select("pos", "header", "matched", "exact", "status", "message")
    grouped = defs.where(T.strip_ws(F.coalesce("col", F.lit(""))).rlike(RANGE_ROW)).agg(F.count(F.lit(1)).alias("n"))
    lacking = grouped.where("n = 0").select(
        *[F.lit(None).cast(out.schema[c].dataType).alias(c) for c in ("pos", "header", "matched", "exact")],
        F.lit("missing").alias("status"),
        F.lit("Definitions are missing the grouped range row").alias("message"),
    )
    return out.where(grouped.scalar() > 0).unionByName(lacking)


def value_coverage(values: DataFrame, defs: DataFrame) -> DataFrame:
    """JN-18: controlled values ``(header, value, ord)`` must match a bullet of the header's
    definitions; with no bullets, be a substring of the definitions' match text."""
    tok = heading_tokens(defs).where(F.col("definition") != "")
    texts = tok.groupBy("mt").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "pos", "definition"))), lambda x: x["definition"]), "\n").alias("defs_text"))
    bl = texts.select("mt", "defs_text", F.posexplode(L.bullets("defs_text")).alias("bpos", "bullet"))
    bl = bl.withColumn("bmt", M.match_text("bullet")).where(F.col("bmt") != "")
    # every bullet counts, also one whose match text is empty: it matches no value
    n_bullets = texts.select("mt", "defs_text", F.size(L.bullets("defs_text")).alias("n_bullets"))
    v = values.select("header", T.strip_ws(F.coalesce("value", F.lit(""))).alias("value"), "ord").where(F.col("value") != "")
    v = v.withColumn("mt", M.match_text("header")).withColumn("vmt", M.match_text("value")).where(F.col("vmt") != "")
    v = v.join(n_bullets, "mt", "left")
    cand = bl.groupBy("mt", "bmt", "bullet").agg(F.min("bpos").alias("bpos"))
    j = v.join(cand, (v.mt == cand.mt) & (v.vmt == cand.bmt), "left").drop(cand.mt)
    pref = F.struct(F.when(F.col("bullet") == F.col("value"), 0).otherwise(1), F.col("bpos"))
    g = j.groupBy("header", "value", "ord", "vmt", "defs_text", "n_bullets").agg(F.min_by("bullet", F.when(F.col("bullet").isNotNull(), pref)).alias("matched"))
    sub = F.instr(M.match_text("defs_text"), F.col("vmt")) > 0
    status = (
        F.when(F.col("defs_text").isNull(), F.lit("no_definition"))
        .when((F.col("n_bullets") > 0) & F.col("matched").isNotNull(), F.lit("mapped"))
        .when(F.col("n_bullets") > 0, F.lit("missing"))
        .when(sub, F.lit("substring"))
        .otherwise(F.lit("missing"))
    )
    msg = (
        F.when(status == "no_definition", F.concat(F.lit("Definitions have no text for controlled-value header '"), F.col("header"), F.lit("'")))
        .when(status == "missing", F.concat(F.lit("Definition for '"), F.col("header"), F.lit("' is missing value '"), F.col("value"), F.lit("'")))
        .when(status == "mapped", F.concat(F.lit("Value map ["), F.col("header"), F.lit("]: '"), F.col("value"), F.lit("' -> '"), F.col("matched"), F.lit("'"), F.when(F.col("matched") == F.col("value"), F.lit("")).otherwise(F.lit(NOTE))))
        .otherwise(F.concat(F.lit("Value map ["), F.col("header"), F.lit("]: '"), F.col("value"), F.lit("' -> definition text match (normalized substring)")))
    )
    return g.select("header", "value", "ord", "matched", status.alias("status"), msg.alias("message"))


def doc_issues(header_cov: DataFrame, range_cov: DataFrame, value_cov: DataFrame) -> DataFrame:
    """CHK-05: the documentation issues (ERROR) of the three checks in one table."""
    parts = [
        header_cov.where(F.col("status") == "missing").select(F.col("message")),
        range_cov.where(F.col("status") == "missing").select(F.col("message")),
        value_cov.where(F.col("status") == "missing").select(F.col("message")),
        value_cov.where(F.col("status") == "no_definition").select(F.col("message")).distinct(),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return out.select(F.lit("documentation").alias("check"), "message", F.lit("ERROR").alias("severity"))


DEFINITION_COLUMNS = ("col", "heading", "definition")


def check_documentation(columns: list[str], marker: str, defs: DataFrame, values: DataFrame | None = None, grouped=()) -> DataFrame:
    """CHK-05: every documentation finding (check, message, severity), and a line (INFO) for each mapping found.

    A release without the marker column, or definitions without their columns, cannot be
    checked: that is the one issue then.
    """
    spark = defs.sparkSession
    lacking = [c for c in DEFINITION_COLUMNS if c not in defs.columns]
    told = None
    if marker not in columns:
        told = f"Release is missing the '{marker}' header needed for the documentation check"
    elif lacking:
        told = f"Definitions are missing required column(s): {', '.join(lacking)}"
    if told is not None:
        return spark.createDataFrame([("documentation", told, "ERROR")], "check string, message string, severity string")
    headers = spark.createDataFrame(list(enumerate(columns[: columns.index(marker)], start=1)), "pos int, header string")
    headers = header_coverage(headers, defs)
    found = [headers]
    if grouped:
        found.append(range_coverage(spark.createDataFrame(list(enumerate(grouped, start=1)), "pos int, header string"), defs))
    none = headers.limit(0)
    vc = value_coverage(values, defs) if values is not None else none
    out = doc_issues(headers, found[1] if grouped else none, vc)
    for part in [*found, vc] if values is not None else found:
        mapped = part.where(F.col("status").isin("mapped", "substring")).select(F.lit("documentation").alias("check"), "message", F.lit("INFO").alias("severity"))
        out = out.unionByName(mapped)
    return out
