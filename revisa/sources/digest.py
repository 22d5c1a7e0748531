"""Order-independent digest of a table's rows, observed while they are written.

A row is its values as text, each with its length before it, or a dash for null.  Two numbers of
60 bits are taken from its MD5, and each is summed over all rows, so that the digest of a table
does not depend on order or partitions, counts repeated rows, and is gathered in the job that
writes them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

SUM = "decimal(38,0)"


def row_hash(columns) -> Column:
    values = [F.col(f"`{c}`").cast("string") for c in columns]
    return F.md5(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]))


def _halves(columns) -> tuple[Column, Column]:
    h = row_hash(columns)
    return tuple(F.conv(F.substring(h, at, 15), 16, 10).cast(SUM) for at in (1, 16))


def digest_aggregates(columns, where: Column | None = None, suffix: str = "") -> list[Column]:
    """Aggregates that give a digest: rows, and both sums."""
    one, two = _halves(columns)
    some = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    return [F.count(some(F.lit(1))).alias("rows" + suffix), F.sum(some(one)).alias("one" + suffix), F.sum(some(two)).alias("two" + suffix)]


def digest_text(got: dict, suffix: str = "") -> str:
    return f"{got['one' + suffix] or 0}-{got['two' + suffix] or 0}"


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and an observation that has their number and digest once they are written."""
    seen = Observation()
    return df.observe(seen, *digest_aggregates(df.columns)), seen


def digest_rows(spark, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "table_name string, n_rows bigint, digest string")
