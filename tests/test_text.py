"""Truth tables of the scalar text functions on literal frames."""

import pytest

from revisa.functions import text as T

CASES = ["  a b  ", " x ", "\t\n", "", None, "\u200bz", "x\x1c", "\u3000y\u3000"]


def test_norm_matches_python_strip(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "s string")
    got = [r[0] for r in df.select(T.norm("s")).collect()]
    want = [(c.strip() or None) if c is not None else None for c in CASES]
    assert got == want


@pytest.mark.parametrize(
    "text,value",
    [("12", 12), (" 12.0 ", 12), ("1e3", 1000), ("1.5", None), ("x7", None), ("1d", None), ("0x1p3", None), ("", None), ("-4", -4), ("inf", None), ("nan", None)],
)
def test_int_like(spark, text, value):
    assert spark.createDataFrame([(text,)], "s string").select(T.int_like("s")).first()[0] == value


@pytest.mark.parametrize("text,code", [("E", "E"), (" a ", "A"), ("exemplar", "E"), ("Additional", "A"), ("zzz", None), (None, None), ("", None)])
def test_type_code(spark, text, code):
    assert spark.createDataFrame([(text,)], "s string").select(T.type_code("s")).first()[0] == code


def test_hyperlink_label(spark):
    rows = [('=HYPERLINK("http://x/1","CU1")', "CU1"), ('=hyperlink("u","  L ")', "L"), ("plain", "plain"), ('=HYPERLINK("u","")', None)]
    df = spark.createDataFrame(rows, "s string, want string")
    assert all(r[0] == r[1] for r in df.select(T.hyperlink_label("s"), "want").collect())


def test_a1_column(spark):
    def py(n):
        s = ""
        while n > 0:
            n, r = divmod(n - 1, 26)
            s = chr(65 + r) + s
        return s

    nums = [1, 2, 26, 27, 52, 53, 702, 703, 16384]
    df = spark.createDataFrame([(n,) for n in nums], "n int")
    assert [r[0] for r in df.select(T.a1_column("n")).collect()] == [py(n) for n in nums]


def test_canonical_and_key_numeric(spark):
    df = spark.createDataFrame([("Space-Tools", " cu12 "), ("auto mobile", "XXCU1")], "v string, k string")
    got = df.select(T.canonical_value("v"), T.key_numeric("k", r"^CU(\d+)$")).collect()
    assert [tuple(r) for r in got] == [("spacetools", 12), ("automobile", None)]


def test_whitespace_only_and_visible(spark):
    df = spark.createDataFrame([("a b", "a b"), ("a", "b"), (None, " ")], "o string, n string")
    assert [r[0] for r in df.select(T.whitespace_only_change("o", "n")).collect()] == [True, False, True]
    assert spark.createDataFrame([("a b\t",)], "s string").select(T.visible_whitespace("s")).first()[0] == "a<sp>b<tab>"


def test_sql_literal(spark):
    df = spark.createDataFrame([("O'Neil", "7"), (None, None)], "t string, i string")
    got = df.select(T.sql_literal("t"), T.sql_literal("i", "int")).collect()
    assert [tuple(r) for r in got] == [("'O''Neil'", "7"), ("NULL", "NULL")]
