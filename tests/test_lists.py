"""List-cell parsing and the change-class truth table."""

import pytest

from revisa.functions import lists as L


def entries(spark, text):
    df = spark.createDataFrame([(text,)], "s string")
    return [(e["segment"], e["token"]) for e in df.select(L.split_segments("s")).first()[0]]


def test_split_edges(spark):
    assert entries(spark, "seg: A; B\nC") == [("seg", "A"), (None, "B"), (None, "C")]
    assert entries(spark, "seg:;:tok; a:b:c") == [(None, "tok"), ("a", "b:c")]
    assert entries(spark, None) == []
    assert entries(spark, " ; ") == []


@pytest.mark.parametrize(
    "old,new,cls",
    [
        (None, None, "whitespace"),
        (None, "A", "was_empty"),
        (";", "A", "meaningful"),
        ("A", None, "meaningful"),
        ("s: A; t: B", "S:a;\n T: b", "whitespace"),
        ("s: A; t: B", "x: A; y: B", "segment_name"),
        ("A; B", "B; A", "meaningful"),
        ("A", "A; B", "meaningful"),
    ],
)
def test_classify(spark, old, new, cls):
    df = spark.createDataFrame([(old, new)], "o string, n string")
    assert df.select(L.classify_change("o", "n")).first()[0] == cls


def test_bullets_and_tokens(spark):
    df = spark.createDataFrame([("Type:\n - E\n- a \n-\nx", " a, ,b ,")], "d string, h string")
    r = df.select(L.bullets("d"), L.list_tokens("h")).first()
    assert list(r[0]) == ["E", "a"]
    assert list(r[1]) == ["a", "b"]
