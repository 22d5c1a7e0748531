"""A sample of queries() against oracle_sql() on sf0.001, compared like the driver does:
same column names, same rows (order-insensitive), values normalised."""

import os

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF
from tools.oracle_check import TABLES, rows_of

SAMPLE = [
    "row_change_summary", "keys_missing", "duplicate_keys", "updatable_changes", "read_only_changes",
    "change_updates", "apply_updates", "render_deletes", "segment_change_class", "vocab_correct",
    "cell_diff", "diff_by_row", "mask_rows", "doc_value_coverage", "reconcile_cells", "resolve_current_id",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(rel.columns, rel.fetchall())
