"""Scalar functions on the hand-made edge fixtures (FIXTURES 3)."""

from pyspark.sql import functions as F

from leadlens.functions import dates as D
from leadlens.functions import text as T


def one(spark, expr, data, schema="x string"):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("y")).collect()]


def test_clean_name(spark):
    got = one(spark, T.clean_name("x"), [(" Ann; ",), ("a/t b",), ("",), (None,), (" ",), ("A\tB",)])
    assert got == ["ann", "a b", "", None, "", "a\tb"]


def test_strip_and_combine(spark):
    df = spark.createDataFrame(
        [("(312) 555-0001", "312.555.0001", None), ("312 555 0001 x2", "", "31255500"),
         (None, None, None)], "m string, h string, w string")
    rows = df.select(T.strip_phone("m").alias("m"), T.combine_phones("m", "w", "h").alias("c"),
                     T.combine_long_phones("h", "m", "w").alias("cl")).collect()
    assert [tuple(r) for r in rows] == [
        ("3125550001", "3125550001312.555.0001", "312.555.00013125550001"),
        ("3125550001x2", "3125550001x231255500", "3125550001x2"),
        (None, "", "")]


def test_not_blank(spark):
    assert one(spark, T.not_blank("x"), [("a",), ("",), (None,), (" ",)]) == [True, False, False, True]


def test_word_after(spark):
    got = one(spark, T.word_after("x", "unit "),
              [("ok unit 3B building X1 now",), ("no marker",), (None,), ("unit ",)])
    assert got == ["3B", "", None, ""]


def test_char_after(spark):
    k = '"evictions_0_to_1_years":'
    data = [('{"evictions_0_to_1_years":"1"}',), ('{"evictions_0_to_1_years":1}',),
            ('{"other":1, "x": "abcdefghijklmnopqrstuvwxyz"}',), (None,)]
    got = one(spark, T.char_after("x", k), data)
    # missing key: instr = 0, so the character at position len(key) is returned
    assert got[:2] == ['"', "1"] and got[2] == data[2][0][len(k) - 1] and got[3] is None
    assert one(spark, T.char_after("x", k, strict=True), data)[2] is None


def test_strip_control_and_ascii(spark):
    got = one(spark, T.strip_control(T.strip_non_ascii("x")), [("x;y\\z\né\r",), ("café \U0001F600!",)])
    assert got == ["xyz", "caf !"]


def test_anchor_modes(spark):
    data = [('<a name="maple" href="x">',), ('<a name="q">',), ("plain",), (None,)]
    assert one(spark, T.anchor_name("x"), data) == ["ple", "", "plain", None]
    assert one(spark, T.anchor_name("x", exact=True), data) == ["maple", "", "plain", None]


def test_yes_no_and_contains_any(spark):
    df = spark.createDataFrame([("312-555", "555"), ("abc", None)], "h string, n string")
    assert [r[0] for r in df.select(T.yes_no(T.contains_any("h", ["n"]))).collect()] == ["yes", "no"]


def test_dates(spark):
    df = spark.createDataFrame([("2014-02-10 10:00:00", "2013-02-10 10:00:00")], "a string, b string") \
              .select(F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    r = df.select(D.month_end("a").cast("string"), D.quarter_of(D.month_end("a")),
                  D.age_years("a", "b"), D.seconds_between("a", "b"),
                  D.strictly_within("a", "b", "-1 hour", "1 hour")).first()
    assert tuple(r) == ("2014-02-28", 1, 1.0, 365 * 86400.0, False)
