"""JN-19 / AGG-08: resolve names to current ids across releases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_release(toc: DataFrame, release_col: str = "release_num") -> DataFrame:
    """AGG-08: the row with the largest release number (ties: first by ordinal if present)."""
    order = F.struct(F.col(release_col), *([-F.col("ord")] if "ord" in toc.columns else []))
    return toc.agg(F.max_by(F.struct(*[F.col(c) for c in toc.columns]), order).alias("r")).select("r.*")


def release_matches(release_number, table_name: str) -> bool:
    """Q18: the number in a release table name must equal the release number (not a suffix match)."""
    import re

    m = re.search(r"(\d+)$", table_name or "")
    return bool(m) and int(m.group(1)) == int(release_number)


def resolve_current_id(names: DataFrame, node_names: DataFrame, toc: DataFrame) -> DataFrame:
    """Name → ``max(stable_id)`` over all releases → taxon id of that stable id in the latest release.

    The reference writes this as a two-level correlated subquery; here it is an aggregate
    and two equi-joins.  A name whose id has several rows in the latest release is not
    resolved (``taxnode_id`` null, ``n_matches`` > 1) instead of failing the whole job.
    """
    latest = toc.agg(F.max("release_num").alias("release_num"))
    ids = node_names.join(names.select("name").distinct(), "name", "inner").groupBy("name").agg(F.max("stable_id").alias("stable_id"))
    # ``latest`` is one row (an aggregate without grouping), so broadcasting it is bounded.
    current = node_names.join(F.broadcast(latest), "release_num", "inner").select("stable_id", "taxnode_id")
    hits = ids.join(current, "stable_id", "left").groupBy("name").agg(
        F.count("taxnode_id").alias("n_matches"), F.min("taxnode_id").alias("_tx")
    )
    out = names.select("name").distinct().join(hits, "name", "left")
    return out.select(
        "name",
        F.when(F.col("n_matches") == 1, F.col("_tx")).alias("taxnode_id"),
        F.coalesce(F.col("n_matches"), F.lit(0)).cast("bigint").alias("n_matches"),
    )
