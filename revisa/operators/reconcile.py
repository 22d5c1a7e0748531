"""JN-03 / JN-04: reconcile the baseline with an external export of the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revisa.functions import text as T
from revisa.operators.revision import KEY, first_rows
from revisa.spec import RevisionSpec


def reconcile_keys(original: DataFrame, export: DataFrame) -> DataFrame:
    """Keys only in the export, only in the original, or in both (first row of each side)."""
    o = original.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min("ord").alias("o_ord"))
    x = export.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.min("ord").alias("x_ord"))
    j = o.join(x, KEY, "full")
    status = F.when(F.col("o_ord").isNull(), F.lit("export_only")).when(F.col("x_ord").isNull(), F.lit("original_only")).otherwise(F.lit("both"))
    return j.select(KEY, status.alias("status"), "o_ord", "x_ord")


def reconcile_cells(original: DataFrame, export: DataFrame, spec: RevisionSpec, kinds: dict) -> DataFrame:
    """Cells that differ on shared keys after the column's normaliser (first row per key on both sides)."""
    cols = list(spec.columns)
    o = first_rows(original, spec, cols)
    x = first_rows(export, spec, cols)
    j = o.select(KEY, F.col("ord").alias("o_ord"), *[F.col(c).alias("o_" + c) for c in cols]).join(
        x.select(KEY, *[F.col(c).alias("x_" + c) for c in cols]), KEY, "inner"
    )
    items = []
    for c in cols:
        k = kinds.get(c, "text")
        a, b = T.norm_value(F.col("o_" + c), k), T.norm_value(F.col("x_" + c), k)
        items.append(F.when(~T.values_equal(F.col("o_" + c), F.col("x_" + c), k), F.struct(F.lit(c).alias("column"), a.alias("original_value"), b.alias("export_value"))))
    diffs = F.filter(F.array(*items), lambda d: d.isNotNull())
    return j.select(KEY, F.col("o_ord").alias("ord"), F.explode(diffs).alias("d")).select(
        KEY, "ord", "d.column", "d.original_value", "d.export_value"
    )

