import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewloom.functions import lenient, text


def one_column(spark, expression, cells, dtype="string"):
    """The expression over every cell, in order."""
    df = spark.createDataFrame(list(enumerate(cells)), f"i int, x {dtype}")
    rows = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [row["y"] for row in sorted(rows)]


def test_to_int_truncates_and_rejects(spark):
    cells = ["1", "5", " 4 ", "+3", "-2", "4.5", "4.", "4d", "4f", "1e1", ".5", ".", "", " ",
             "5.0 out of 5 stars", "NaN", "abc", None, "99999999999"]
    expected = [1, 5, 4, 3, -2, 4, 4] + [None] * 12
    assert one_column(spark, lenient.to_int, cells) == expected


def test_to_int_of_numbers_skips_text(spark):
    got = one_column(
        spark, lambda x: lenient.to_int(x, T.DoubleType()), [4.9, 1e20, None], "double")
    assert got == [4, None, None]


@pytest.mark.parametrize("cell,value", [
    ("3", 3), ("3.0", 3), ("1.234", 1234), ("-3", 3), ("1,234 people", 1234),
    ("none", None), ("", None), ("99999999999", None), (None, None),
])
def test_digits(spark, cell, value):
    assert one_column(spark, lenient.digits, [cell]) == [value]


def test_price_loses_sign_and_ranges(spark):
    cells = ["$1,299.99", "-5.00", "10.00 - 20.00", "free", None]
    got = one_column(spark, lambda x: lenient.price(x).cast("double"), cells)
    assert [None if v is None else round(v, 2) for v in got] == [1299.99, 5.0, None, None, None]


def test_float_never_fails(spark):
    assert one_column(spark, lenient.to_float, ["4.5", "x", "", None]) == [4.5, None, None, None]


def test_null_outside(spark):
    got = one_column(
        spark, lambda x: lenient.null_outside(x, 1.0, 5.0),
        [0.5, 1.0, 4.2, 5.0, 5.1, float("nan"), None], "double")
    assert got == [None, 1.0, 4.2, 5.0, None, None, None]
    assert one_column(spark, lambda x: lenient.null_outside(x, low=0), [-1, 0, 9], "int") == [
        None, 0, 9]
    assert one_column(spark, lenient.null_outside, [-1, 9], "int") == [-1, 9]


def test_parse_date(spark):
    cells = ["10/3/2017", "10/03/2017", "13/3/2017", "10/3/17", "2017-10-03", "", "soon", None]
    day = datetime.date(2017, 10, 3)
    assert one_column(spark, lenient.parse_date, cells) == [day, day, None, None, day] + [None] * 3
    assert one_column(spark, lambda x: lenient.parse_date(x, T.DateType()), [day], "date") == [day]


def test_flag_is_never_null(spark):
    cells = ["Verified Purchase", " verified purchase ", "Vine", "", None]
    got = one_column(spark, lambda x: lenient.flag(x, "verified purchase"), cells)
    assert got == [True, True, False, False, False]


def test_trim_takes_spaces_only_and_strip_all_takes_everything(spark):
    cells = ["  a ", "\ta\n", " a ", "\x1ca\x1f", "a　", "a \n b", "", None]
    assert one_column(spark, F.trim, cells)[1] == "\ta\n"
    assert one_column(spark, text.strip_all, cells) == [
        None if c is None else c.strip() for c in cells]


def test_whitespace_is_what_python_strips():
    import sys

    spaces = {chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace()}
    assert set(text.WHITESPACE) == spaces


def test_embed_text(spark):
    df = spark.createDataFrame(
        [(0, "Nice", "works"), (1, None, "works"), (2, "Nice", None), (3, None, None),
         (4, " a", "b\n")], "i int, t string, b string")
    rows = df.select("i", text.embed_text(F.col("t"), F.col("b")).alias("e")).orderBy("i").collect()
    assert [r["e"] for r in rows] == ["Nice works", "works", "Nice", "", "a b"]


def test_head_counts_code_points_and_shorten_marks_the_cut(spark):
    assert one_column(spark, lambda x: text.head(x, 3), ["añ😀b", "x"]) == ["añ😀", "x"]
    assert one_column(spark, lambda x: text.shorten(x, 6), ["abcdef", "abcdefg", None]) == [
        "abcdef", "abc...", None]
    assert one_column(spark, lambda x: text.shorten(x, 3), ["abcdef"]) == ["abc"]


def test_stars(spark):
    assert one_column(spark, text.stars, [3, 0, None], "int") == ["⭐⭐⭐", "", None]


def test_content_id_keeps_the_parts_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", ":1:bc")], "a string, b string")
    ids = {r[0] for r in df.select(text.content_id(F.col("a"), F.col("b"))).collect()}
    assert len(ids) == 3


def test_typed_numbers_skip_the_text(spark):
    double = T.DoubleType()
    cells = [12345678.0, 0.0005, -19.5, None, 1e20]
    got = one_column(spark, lambda x: lenient.price(x, double).cast("double"), cells, "double")
    assert got[0] == 12345678.0 and abs(got[1] - 0.0005) < 1e-9 and got[2] == 19.5 and got[3] is None
    assert one_column(spark, lambda x: lenient.digits(x, double), cells, "double") == [
        12345678, 0, 19, None, None]


def test_iso_timestamps_keep_their_day(spark):
    cells = ["2017-10-03 10:11:12", "2017-10-03T23:59:59.5", "2017-13-03 10:11:12", "2017-10-03 x"]
    day = datetime.date(2017, 10, 3)
    assert one_column(spark, lenient.parse_date, cells) == [day, day, None, None]
