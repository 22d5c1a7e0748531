"""Helpers shared by the operators: shared-folder tables, Arrow batches in bounded pieces, label samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisa.session import checkpoint_dir

#: Text bytes a task works on at once.  A longer single text is one piece by itself.
PIECE_BYTES = 4 << 20
#: Most labelled rows a classifier is fitted on; beyond it a hash sample of about this size.
MAX_LABELS = 1_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The rows written once as Parquet in the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(col):
    """A-Z to a-z, every other character unchanged."""
    return F.translate(col, UPPER, LOWER)


def crc32_mod(col, n: int):
    """crc32 of the id as text, mod n; null for a null id."""
    return F.crc32(col.cast("string").cast("binary")) % n


def labelled(labels: DataFrame, column: str, keep) -> DataFrame:
    """(doc_id, label) of the labelled rows that ``keep`` admits.

    Several rows of one id count as their largest label; null ids and labels are left out.
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull()).where(keep)
    return rows.groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))


def label_sample(labels: DataFrame, column: str, keep, max_labels: int = MAX_LABELS) -> DataFrame:
    """At most about ``max_labels`` rows of ``labelled``, which makes the result safe to broadcast."""
    rows = labelled(labels, column, keep)
    total = rows.count()
    if total > max_labels:
        share = int(max_labels / total * 1_000_000)
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)
    return rows


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string or binary column; null is empty."""
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = pc.fill_null(col, b"")
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(data) else np.zeros(0, np.uint8)
    return values, offsets - offsets[0]


def release() -> None:
    """What Arrow keeps of tables that are no longer used goes back to the system."""
    pa.default_memory_pool().release_unused()


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece's texts hold about ``max_bytes`` at most, or one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = flat(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
