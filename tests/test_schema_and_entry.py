"""Name guards and the driver contract."""

import __spark_entry__ as E
from revisa.operators import schema as sc


def test_header_position_check():
    assert sc.header_position_check(["a", "b", "c"], ["a"]) == ["Worksheet is missing required columns: b, c"]
    assert sc.header_position_check(["a", "b"], ["a", "x", "y"]) == ["Column 2 mismatch: expected 'b' but found 'x'"]


def test_schema_guards():
    assert sc.schema_diff(["a", "b", "f"], ["a", "c", "f"], formula_columns=["f"]) == {"missing": ["b"], "unexpected": ["c"]}
    assert sc.required_tables(["Version", r"REL \d+.*", "Original"], ["Version", "REL 41"]) == ["Original"]
    assert sc.required_columns_ci(["Record ID", "Family"], ["record id "]) == ["Family"]
    assert sc.discover_release_table(["a", "REL 40", "REL 41"], r"REL \d+") == ("REL 40", ["Multiple release tables found: REL 40, REL 41"])
    assert sc.first_existing(["x", "Name"], ["NAME", "b"], case_insensitive=True) == "NAME"
    data, delta, change, issues = sc.column_segments(["id", "a", "b", "n", "d", "x", "y"], "n", "d")
    assert (data, change, issues) == (["id", "a", "b"], ["x", "y"], [])


def test_contract(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"ord", "rkey", "n_changes", "changes", "changed"}
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
