"""Tables in the session's shared folder: intermediate results that outlive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from revisa.session import checkpoint_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's shared checkpoint folder (never a machine-local one)."""
    return "/".join([checkpoint_dir(spark).rstrip("/"), *parts])


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read back: cuts lineage, keeps column pruning."""
    path = shared_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
