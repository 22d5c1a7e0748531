"""Registry of named queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with an optional oracle SQL."""

    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every catalog module (each registers its queries on import)."""
    from revisa.plans import (  # noqa: F401
        q_changes,
        q_diff,
        q_docs,
        q_issues,
        q_lists,
        q_masks,
        q_release,
        q_revision,
        q_vocab,
    )
