"""Sources and sinks: delimited dumps, Parquet, JDBC, snapshots.

Readers always use an explicit all-string schema (no type inference: a whole-number
float never turns into an int, a date never into a timestamp).
"""

from __future__ import annotations

import csv
import io
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from revisa.sources import digest as dg
from revisa.sources import records as rec
from revisa.sources.shared import shared_path, written_once  # noqa: F401


# The text tokens a pandas reader treats as missing by default
# (the reference's update path reads with those defaults; its export path does not).
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def string_schema(columns) -> Ty.StructType:
    return Ty.StructType([Ty.StructField(c, Ty.StringType()) for c in columns])


def read_dump(
    spark: SparkSession, path: str, columns, sep: str = "\t", escape: str = "\\", null_tokens=None, python_escapes: bool = False
) -> DataFrame:
    """SRC-01: headed, delimited UTF-8 dump as all strings (quoted newlines allowed).

    A missing path gives an empty frame (the caller records a WARNING issue).  Large files
    are read by many tasks, also where quoted fields hold line breaks
    (:mod:`revisa.sources.records`).  ``python_escapes`` reads fields the way a Python ``csv``
    reader with ``escapechar='\\'`` does: a backslash before any character is dropped (Spark
    keeps it outside quotes).  A blank field is absent (null) either way.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return spark.createDataFrame([], string_schema(columns))
    found = rec.records(spark, path, sep, escape).where("not _header")
    df = _python_fields(found, columns, sep, escape) if python_escapes else _spark_fields(found, columns, sep, escape)
    if null_tokens is not None:
        tokens = [null_tokens] if isinstance(null_tokens, str) else list(null_tokens)
        df = df.select(*[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) for c in df.columns])
    return df


def _spark_fields(found: DataFrame, columns, sep: str, escape: str) -> DataFrame:
    ddl = ", ".join(f"`{c}` string" for c in columns)
    options = {"sep": sep, "escape": escape, "multiLine": "true"}
    return found.select(F.from_csv("text", ddl, options).alias("r")).select(*[F.col("r")[c].alias(c) for c in columns])


def _python_fields(found: DataFrame, columns, sep: str, escape: str) -> DataFrame:
    n = len(columns)

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                fields = next(csv.reader(io.StringIO(text, newline=""), delimiter=sep, escapechar=escape), [])
                rows.append([*(f or None for f in fields[:n]), *[None] * (n - len(fields))])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * n, names=list(columns))

    return found.select("text").mapInArrow(run, string_schema(columns))


def read_by_suffix(spark: SparkSession, path: str, columns) -> DataFrame:
    """SRC-04: ``.csv`` is comma-separated, ``.txt`` tab-separated; any other suffix fails."""
    low = path.lower().rstrip("/")
    if low.endswith(".csv"):
        sep = ","
    elif low.endswith(".txt"):
        sep = "\t"
    else:
        raise ValueError(f"Unsupported file format for {path}")
    return read_dump(spark, path, columns, sep=sep)


def write_dump(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Write a headed delimited dump (quotes doubled, quoted fields may span lines)."""
    whole = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # the writer trims by default
    df.write.mode("overwrite").options(header=True, sep=sep, escape='"', quoteAll=True, **whole).csv(path)


def read_written_dump(spark: SparkSession, path: str, columns, sep: str = "\t") -> DataFrame:
    """Read back what :func:`write_dump` wrote (quotes doubled)."""
    return read_dump(spark, path, columns, sep=sep, escape='"')


def open_table(spark: SparkSession, locator: str, name: str, columns=None, jdbc_properties: dict | None = None) -> DataFrame:
    """SRC-03: choose the reader by locator: a JDBC URL, a directory of Parquet tables or of
    ``<name>.txt`` dumps; anything else is an error."""
    if locator.startswith("jdbc:"):
        return spark.read.jdbc(locator, name, properties=jdbc_properties or {})
    if locator.startswith(("mysql://", "mariadb://")):
        raise ValueError("use a jdbc: URL for database sources")
    path = locator.rstrip("/") + "/" + name
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm(locator).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(jvm(path + ".parquet")):
        return spark.read.parquet(path + ".parquet")
    if fs.exists(jvm(path + ".txt")):
        if columns is None:
            header = spark.read.option("header", True).option("sep", "\t").csv(path + ".txt").columns
            columns = header
        return read_dump(spark, path + ".txt", columns)
    raise ValueError(f"Unsupported data source for table {name}: {locator}")


SAFE_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")


def safe_identifier(name: str) -> str:
    """SCH-06: only ``[A-Za-z0-9_]+`` may be spliced into SQL text."""
    if not SAFE_IDENTIFIER.fullmatch(name or ""):
        raise ValueError(f"Unsafe identifier: {name!r}")
    return name


def snapshot(df: DataFrame, base: str, table: str, stamp: str) -> tuple[str, DataFrame]:
    """SNK-10: write ``<table>_<yyyyMMdd>``; returns its path, and for the table and the copy the
    number and digest of the rows, observed in the job that writes them."""
    name = f"{safe_identifier(table)}_{stamp}"
    if not re.fullmatch(r"\d{8}", stamp):
        raise ValueError("snapshot stamp must be yyyyMMdd")
    path = f"{base.rstrip('/')}/{name}"
    return path, copied(df, path, table, name)


def copied(df: DataFrame, path: str, table: str, name: str) -> DataFrame:
    """Replace the table at ``path`` by the rows of ``df``; AGG-12: (table_name, n_rows, digest) of source and copy.

    Both are observed in the write; the copy's own row count is read from its file footers
    (no column is read) and must agree.
    """
    spark = df.sparkSession
    rows, seen = dg.observed(df)
    rows.write.mode("overwrite").parquet(path)
    got = seen.get
    there = spark.read.schema(df.schema).parquet(path).count()
    if there != got["rows"]:
        raise RuntimeError(f"{path} has {there} rows of {got['rows']}")
    return dg.digest_rows(spark, [(n, got["rows"], dg.digest_text(got)) for n in (table, name)])


BACKUP_NAME = re.compile(r".+_\d{8}")


def restore(spark: SparkSession, base: str, backup: str, columns, target: str) -> DataFrame:
    """SNK-11: the backup name must end in ``_yyyyMMdd``; the target table is replaced by
    the backup's rows in a fixed projection; returns row counts and digest of both.

    The rows are first written whole to a staging folder beside the target, then swapped in
    by renames, so a failed write leaves the target as it was."""
    if not BACKUP_NAME.fullmatch(backup):
        raise ValueError(f"Backup table name must end with _YYYYMMDD: {backup}")
    src = spark.read.parquet(f"{base.rstrip('/')}/{backup}").select(*columns)
    target_path = f"{base.rstrip('/')}/{safe_identifier(target)}"
    staging = f"{target_path}.staging"
    told = copied(src, staging, backup, target)
    _swap_in(spark, staging, target_path)
    return told


def _swap_in(spark: SparkSession, staging: str, target: str) -> None:
    """Replace folder ``target`` by ``staging``: the old one steps aside and goes last.

    A swap that was broken off after the old folder had stepped aside left its only copy
    there; it is put back first.
    """
    jvm = spark.sparkContext._jvm
    new, now, aside = [jvm.org.apache.hadoop.fs.Path(p) for p in (staging, target, f"{target}.old")]
    fs = new.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(aside):
        if fs.exists(now):
            fs.delete(aside, True)
        elif not fs.rename(aside, now):
            raise RuntimeError(f"cannot put {target} back")
    if fs.exists(now) and not fs.rename(now, aside):
        raise RuntimeError(f"cannot move {target} aside")
    if not fs.rename(new, now):
        fs.rename(aside, now)
        raise RuntimeError(f"cannot move the restored rows to {target}")
    fs.delete(aside, True)


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """SNK-01 / SNK-02 / AGG-12: replace the table at ``path`` (overwrite = clear first) and
    return the number of rows written, observed in the same job (no second pass)."""
    from pyspark.sql import Observation

    obs = Observation("write_rows")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def observed_read(df: DataFrame, name: str = "read_rows"):
    """AGG-12: wrap a read so the first action over it also reports its row count
    (``observation.get['rows']`` after that action)."""
    from pyspark.sql import Observation

    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def with_ordinal(spark: SparkSession, path: str, name: str = "ord", base: int = 2) -> DataFrame:
    """WIN-03: a Parquet table with its row position as an ordinal column.

    Position = rows in earlier files (files ordered by path) + the row's index in its
    file (``_metadata.row_index``) + ``base`` (2 = the sheet row of the first data row).
    The rows of a file are counted from its metadata alone (no column is read), the counts
    are summed up by a distributed scan, and the rows look their file's offset up in that
    small table, which Spark broadcasts only below its size threshold.
    """
    from revisa.operators.positions import running_sum

    df = spark.read.parquet(path)
    per_file = df.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    offsets = written_once(running_sum(per_file, [F.col("_file")], "_n", "_off").select("_file", "_off"), "file-offsets")
    meta = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_idx"))
    out = meta.join(offsets, "_file").withColumn(name, (F.col("_off") + F.col("_idx") + base).cast("bigint"))
    return out.drop("_file", "_idx", "_off")
