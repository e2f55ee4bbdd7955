import datetime as dt

from pyspark.sql import functions as F

from medallion.functions import (concat_skip_null, hour_of, instant, iso_dow, key_text, text_date,
                                 trim_spaces, wall_clock)

NBSP = "\u00a0"
IDEOGRAPHIC = "\u3000"


def one(spark, expr, data, schema):
    return spark.createDataFrame(data, schema).select(expr.alias("x")).collect()


def test_trim_strips_unicode_spaces_not_tabs(spark):
    data = [(NBSP + " a b " + NBSP,), (" c" + IDEOGRAPHIC,), ("\td\t",), (None,)]
    got = [r.x for r in one(spark, trim_spaces("s"), data, "s string")]
    assert got == ["a b", "c", "\td\t", None]


def test_concat_skips_nulls(spark):
    got = one(spark, concat_skip_null(F.col("a"), ", ", F.col("b")), [("X", None), ("X", "RS")], "a string, b string")
    assert [r.x for r in got] == ["X, ", "X, RS"]


def test_iso_day_of_week_sunday_monday(spark):
    got = one(spark, iso_dow(F.col("d")), [(dt.date(2025, 12, 28),), (dt.date(2025, 12, 29),)], "d date")
    assert [r.x for r in got] == [7, 1]


def test_wall_clock_and_date_ignore_offset(spark):
    df = spark.createDataFrame([("2025-12-30T23:05:00+02:00",)], "s string")
    r = df.select(text_date("s").alias("d"), hour_of(wall_clock("s")).alias("h")).first()
    assert r.d == dt.date(2025, 12, 30) and r.h == 23


def test_instant_honours_offset(spark):
    df = spark.createDataFrame([("2025-12-30T23:05:00+02:00",), ("2025-12-30T21:05:00Z",)], "s string")
    a, b = [r.t for r in df.select(instant("s").alias("t")).collect()]
    assert a == b


def test_key_text(spark):
    got = one(spark, key_text("a", "b"), [(1, "x"), (2, None)], "a long, b string")
    assert [r.x for r in got] == ["1|x", "2|"]


def test_malformed_times_become_null_not_errors(spark):
    df = spark.createDataFrame([("not a time",), ("2025-13-45T99:00:00Z",)], "s string")
    got = df.select(text_date("s").alias("d"), wall_clock("s").alias("w"), instant("s").alias("i")).collect()
    assert all(r.d is None and r.w is None and r.i is None for r in got)
