import re

import pytest
from pyspark.sql import functions as F

from brevita.functions.text import WS, clean, near_dup_key, strip, with_cleaned


def apply(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_whitespace_class_is_pythons(spark):
    points = [c for c in range(0x3100) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, "x" + chr(c) + "y") for c in points], "c int, t string")
    found = {r.c for r in df.filter(F.col("t").rlike(f"x{WS}y")).collect()}
    assert found == {c for c in points if re.fullmatch(r"\s", chr(c))}


@pytest.mark.parametrize(
    "raw, expected",
    [
        (None, ""),
        ("", ""),
        ("  \x1c a 　b\t\nc  ", "a b c"),
        ("``Act''", '"Act"'),
        ("```x", '"`x'),
        ("'''x", "\"'x"),
        ("108th CONGRESS 1st Session H. R. 1 To do", "R. 1 To do"),
        ("  108TH congress\n\n2d SESSION S. 5 An act", "5 An act"),
        ("A 108th CONGRESS 1st Session H. 1 To do", "A 108th CONGRESS 1st Session H. 1 To do"),
        ("108th CONGRESS " + "x" * 400 + " Session H. R. 1", "108th CONGRESS " + "x" * 400 + " Session H. R. 1"),
        ("108th CONGRESS 1st Session H.", "108th CONGRESS 1st Session H."),
        ("a [Page H1234] b [Page S2]c [page H1]", "a b c [page H1]"),
        ("SECTION 1. TITLE", "SECTION 1. TITLE"),
    ],
)
def test_clean(spark, raw, expected):
    assert apply(spark, clean, [raw]) == [expected]


def test_header_stops_at_the_window(spark):
    head = "108th CONGRESS " + "y" * 370 + " Session H. "
    assert len(head) < 400
    assert apply(spark, clean, [head + "rest"]) == ["rest"]


def test_near_dup_key(spark):
    keys = apply(spark, near_dup_key, ["A-b C!1", "", "éß", "x" * 900, "-" * 800 + "z"])
    assert keys == ["abc1", "", "", "x" * 500, ""]


def test_strip_and_single_evaluation(spark):
    assert apply(spark, strip, ["  a b \x1f"]) == ["a b"]
    df = spark.createDataFrame([(1, " a ", " b ")], "k int, text string, summary string")
    plan = with_cleaned(df).filter(F.length("text") > 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CONGRESS") == 2  # once per column, none in the filter
