"""Joins that stay balanced when one key holds a large part of the rows.

A key is hot when it holds more than a ``HOT_SHARE``-th of the rows; fewer keys than that can,
whatever the data, so their values are read to the driver, by a job over the key alone.  Where
there are none, the join is a plain one.  The lookup side of these joins has at most one row
per key, so the rows that hot keys look up are bounded alike and are broadcast; all other
rows are joined by a shuffle on the key, where no key holds more than that share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: A key with more than this fraction of the rows is hot; the bound on what is broadcast.
HOT_SHARE = 1000
#: A key with fewer rows is no burden for one task.
HOT_ROWS = 100_000


def hot_keys(counts: DataFrame, key: str, n: str, share: int = HOT_SHARE, least: int | None = None) -> list:
    """The keys of ``counts`` (one row per key, ``n`` rows each) that hold more than a ``share``-th of all rows, at least ``least``."""
    seen = Observation()
    all_ = counts.where(F.col(key).isNotNull()).observe(seen, F.sum(n).alias("total"))
    top = all_.select(key, n).orderBy(F.desc(n)).limit(share).collect()
    total, least = seen.get["total"] or 0, HOT_ROWS if least is None else least
    return [r[0] for r in top if r[1] > least and r[1] * share > total]


def row_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, _n) of the rows that have a key."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def join_unique(rows: DataFrame, lookup: DataFrame, key: str, hot: list, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``lookup`` (at most one row per key); rows of the ``hot`` keys meet a broadcast of theirs.

    ``hot`` comes from :func:`hot_keys`, which bounds it; ``how`` is inner or left.  Under left,
    rows without a key should be split off by the caller.
    """
    if not hot:
        return rows.join(lookup, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    warm = rows.where(is_hot).join(F.broadcast(lookup.where(is_hot)), key, how)
    return rows.where(~is_hot).join(lookup.where(~is_hot), key, how).unionByName(warm)
