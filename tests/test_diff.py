"""Table diff: the golden per-row report of the reference's one regression case, rebuilt
as literal grids, plus diff(x, x) = empty."""

from revisa.operators import tablediff as td

LONG = "ignore doesn’t' work on values in \"old.xlsx\" - filters only on new values!"


def grids(spark):
    old = [("Sheet1", 1, 1, "fred"), ("Sheet1", 2, 1, "jane"), ("Sheet1", 2, 4, "ignore this line"), ("Sheet1", 3, 4, LONG), ("Sheet1", 4, 1, "same")]
    new = [
        ("Sheet1", 2, 1, "june"), ("Sheet1", 2, 3, "ernie"), ("Sheet1", 3, 1, "george"), ("Sheet1", 4, 1, "same"),
        ("Sheet1", 4, 2, "ignore this line"), ("Sheet1", 5, 2, "real difference"), ("Sheet2", 1, 1, "x"),
    ]
    schema = "sheet string, row bigint, col int, value string"
    return spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)


def test_golden_rows(spark):
    o, n = grids(spark)
    pairs = td.table_pairs(o, n)
    diffs = td.drop_ignored(td.cell_diff(o, n, pairs), td.ignored_rows(n, pairs, td.parse_ignore_rules(["Sheet1:ignore this line"])))
    rows = {r["row"]: r["text"] for r in td.by_row(diffs).collect()}
    assert rows == {
        1: "Row 1: A: fred -> <empty>",
        2: "Row 2: A: jane -> june, C: <empty> -> ernie, D: ignore this line -> <empty>",
        3: f"Row 3: A: <empty> -> george, D: {LONG} -> <empty>",
        5: "Row 5: B: <empty> -> real difference",
    }
    assert [tuple(r) for r in td.table_set_diff(o, n).collect()] == [("Sheet2", "new_only")]


def test_diff_of_same_is_empty(spark):
    o, _ = grids(spark)
    assert td.cell_diff(o, o, td.table_pairs(o, o)).isEmpty()
    v = td.verdict(td.cell_diff(o, o, td.table_pairs(o, o)), td.table_set_diff(o, o)).first()
    assert v["message"] == "No differences found."


def test_ignore_rule_parsing():
    import pytest

    assert td.parse_ignore_rules(["a:b:c"]) == [("a", "b:c")]
    with pytest.raises(ValueError):
        td.parse_ignore_rules([":x"])
