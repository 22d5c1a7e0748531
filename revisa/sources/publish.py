"""Change sets as text, published whole or not at all.

A set is written to a folder of its own below the target: the statements once as a table,
then a folder of ordered text files for each stage, then a manifest with each stage's number
of statements and digest, observed while the statements were written.  Only then is it
made current by renaming one small file, so a write that fails half way leaves the old set,
and a reader sees one set or the other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revisa.sources import digest as dg

CURRENT = "CURRENT"
MANIFEST = "stage int, label string, name string, n_rows bigint, digest string"
LABELS = {0: "column_value_inserts", 1: "deletes", 2: "updates", 3: "inserts"}


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    return jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileContext.getFileContext(jvm.org.apache.hadoop.fs.Path(path).toUri(), spark.sparkContext._jsc.hadoopConfiguration())


def publish(statements: DataFrame, path: str, header_lines=(), labels: dict[int, str] | None = None) -> DataFrame:
    """SNK-05: write (stage, ord, statement) as the current set of ``path``; returns its manifest.

    Each stage starts with the header lines; an empty stage gets a single "no changes" comment.
    A stage's files are in (ord) order by a range-partitioned sort: read them in name order.
    """
    spark, labels = statements.sparkSession, labels or LABELS
    base, name = path.rstrip("/"), f"set-{uuid.uuid4().hex}"
    stages = [(int(k), v, f"stage_{k}_{v}.sql") for k, v in sorted(labels.items())]
    body = statements.select(F.col("stage").cast("int").alias("stage"), F.col("ord").cast("bigint").alias("ord"), "statement")
    seen = Observation()
    found = [a for k, _, _ in stages for a in dg.digest_aggregates(["ord", "statement"], F.col("stage") == k, f"_{k}")]
    body.observe(seen, *found).write.parquet(f"{base}/{name}/statements")
    got = seen.get
    body = spark.read.schema(body.schema).parquet(f"{base}/{name}/statements")
    header = "\n".join(header_lines)
    for k, label, file in stages:
        heads = [(-2, header)] if header else []
        heads += [] if got[f"rows_{k}"] else [(-1, f"-- No {label.replace('_', ' ')} required.")]
        rows = body.where(F.col("stage") == k).select("ord", F.concat("statement", F.lit("\n")).alias("value"))
        rows = spark.createDataFrame(heads, "ord bigint, value string").unionByName(rows)
        rows.repartitionByRange("ord").sortWithinPartitions("ord").select("value").write.text(f"{base}/{name}/{file}")
    manifest = spark.createDataFrame([(*s, got[f"rows_{s[0]}"], dg.digest_text(got, f"_{s[0]}")) for s in stages], MANIFEST)
    manifest.coalesce(1).write.parquet(f"{base}/{name}/manifest")
    _make_current(spark, base, name)
    return read_manifest(spark, path)


def _make_current(spark: SparkSession, base: str, name: str) -> None:
    path, files = _files(spark, base)
    pointer = f"{base}/{name}/{CURRENT}"
    jvm = spark.sparkContext._jvm
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE)
    out = files.create(path(pointer), flags, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.CreateOpts, 0))
    out.write(bytearray(name.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(path(pointer), path(f"{base}/{CURRENT}"), options)


def current_set(spark: SparkSession, path: str) -> str:
    """The folder of the current set; raises where nothing has been published."""
    base = path.rstrip("/")
    name = spark.read.text(f"{base}/{CURRENT}").first()["value"]
    return f"{base}/{name}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{current_set(spark, path)}/manifest")


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """(stage, label, ord, statement) of the current set."""
    rows = spark.read.parquet(f"{current_set(spark, path)}/statements")
    stages = read_manifest(spark, path).select("stage", "label")
    return rows.join(F.broadcast(stages), "stage").select("stage", "label", "ord", "statement")  # a row for each stage


def drop_old_sets(spark: SparkSession, path: str) -> int:
    """Delete every set but the current one (also what failed writes have left); returns how many."""
    base = path.rstrip("/")
    kept = current_set(spark, path).rsplit("/", 1)[1]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = [s.getPath() for s in fs.listStatus(hadoop) if s.isDirectory() and s.getPath().getName().startswith("set-") and s.getPath().getName() != kept]
    for p in gone:
        fs.delete(p, True)
    return len(gone)
