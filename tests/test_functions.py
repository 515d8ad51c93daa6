import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from strata.functions import (email_from_name, null_tokens_to_null, nullable_bigint, number_to_text,
                              to_timestamp_coerce, truthy)
from strata.functions.casts import cast_failed, parse_timestamp
from strata.functions.dates import calendar_columns


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_null_tokens(spark):
    vals = ["NA", "NULL", "", "n/a", "#N/A", "ok", " NA", None]
    assert one_col(spark, vals, null_tokens_to_null) == [None, None, None, None, None, "ok", " NA", None]


def test_to_timestamp_coerce_iso_garbage_sentinel(spark):
    vals = ["2013-04-15", "2013-04-15 12:34:56", "2013-04-15 12:34:56.1234567", "garbage",
            "9999-12-31 23:59:59.9999999", None]
    got = one_col(spark, vals, to_timestamp_coerce)
    assert got[0] == dt.datetime(2013, 4, 15)
    assert got[1] == dt.datetime(2013, 4, 15, 12, 34, 56)
    assert got[2] == dt.datetime(2013, 4, 15, 12, 34, 56, 123456)
    assert got[3:] == [None, None, None]


def test_to_timestamp_coerce_with_format(spark):
    got = one_col(spark, ["15/04/2013", "2013-04-15"], lambda c: to_timestamp_coerce(c, "dd/MM/yyyy"))
    assert got == [dt.datetime(2013, 4, 15), None]


def test_nullable_bigint(spark):
    assert one_col(spark, ["12", "12.0", None, "7"], nullable_bigint) == [12, 12, None, 7]
    with pytest.raises(Exception, match="non-integral"):
        one_col(spark, ["12.5"], nullable_bigint)
    assert one_col(spark, ["12.5", "3"], lambda c: nullable_bigint(c, strict=False)) == [None, 3]


def test_number_to_text(spark):
    got = one_col(spark, ["8302039293929.0", "8302039293929", None, "NaN", "12.5"], number_to_text)
    assert got == ["8302039293929.0", "8302039293929.0", None, None, "12.5"]
    assert one_col(spark, ["8302039293929.0"], lambda c: number_to_text(c, integral=True)) == ["8302039293929"]


def test_truthy(spark):
    assert one_col(spark, [0.0, 1.0, 2.0, None, float("nan")], truthy, "double") == [False, True, True, True, True]


def test_email_from_name(spark):
    got = one_col(spark, ["Acme Toys (Head Office)", "Acme (Ely, UK)", None], email_from_name)
    assert got == ["info@acmetoys.com", "info@acme(ely,uk).com", None]


def test_calendar_columns_iso_week_and_weekday(spark):
    df = spark.createDataFrame([(dt.date(2012, 12, 31),), (dt.date(2013, 3, 31),)], "d date")
    rows = df.select(*calendar_columns(F.col("d"))).collect()
    r = rows[0]
    assert (r.date_key, r.week_of_year, r.day_of_week, r.day_name, r.month_name, r.month_name_short) == \
        (20121231, 1, 0, "Monday", "December", "Dec")
    assert r.is_year_end and r.is_quarter_end and r.is_month_end and not r.is_weekend
    r = rows[1]
    assert r.is_quarter_end and r.is_weekend and r.day_of_week == 6


def test_formatted_parse_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 on 10 March 2013 does not exist in New York (DST gap)
        got = one_col(spark, ["2013-03-10 02:30:00", "bad", "10/03/2013 02:30:00"],
                      lambda c: to_timestamp_coerce(c, "yyyy-MM-dd HH:mm:ss"))
        assert got == [dt.datetime(2013, 3, 10, 2, 30), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_bigint_is_exact_and_loud(spark):
    vals = ["9007199254740993", "9007199254740993.0", "9223372036854775807", "-5.000", " 8 ", "+7", "1e3", None, "NaN"]
    assert one_col(spark, vals, nullable_bigint) == [9007199254740993, 9007199254740993, 9223372036854775807, -5, 8, 7, 1000, None, None]
    junk = ["abc", "1,234", "12.5", "1.00000000000000001", "9223372036854775808"]
    assert one_col(spark, junk, lambda c: nullable_bigint(c, strict=False)) == [None] * 5
    for v in junk:
        with pytest.raises(Exception, match="integer column"):
            one_col(spark, [v], nullable_bigint)
    assert one_col(spark, [*junk, "7", None], lambda c: cast_failed(c, "bigint")) == [True] * 5 + [False, False]


def test_number_to_text_keeps_all_digits(spark):
    vals = ["0.00000000001", "1e22", "123456789012345678901.123456789012345", "1.5e-7", "12.500", "007.10", "-2"]
    assert one_col(spark, vals, number_to_text) == ["0.00000000001", "10000000000000000000000.0", "123456789012345678901.123456789012345",
                                                    "0.00000015", "12.5", "7.1", "-2.0"]


def test_timestamp_range_is_a_parameter(spark):
    wide = one_col(spark, ["9999-12-31 00:00:00"], lambda c: to_timestamp_coerce(c, hi=None))
    assert wide == [dt.datetime(9999, 12, 31)]


def _least_seconds(df):
    df.write.format("noop").mode("overwrite").save()
    took = []
    for _ in range(3):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - t0)
    return min(took)


def test_no_cast_fails_on_common_text(spark):
    """A cast that fails builds an error; ids written as floats and six-digit ids in date columns don't get that far."""
    n = spark.range(0, 800_000, 1, 8).select((F.col("id") % 1000 + 300_000).cast("string").alias("i")).select("i", F.concat("i", F.lit(".0")).alias("f")).localCheckpoint()
    assert n.select(nullable_bigint("f").alias("v")).distinct().count() == 1000
    assert n.where(parse_timestamp("i").isNotNull()).isEmpty()
    assert _least_seconds(n.select(nullable_bigint("f"))) < 4 * _least_seconds(n.select(nullable_bigint("i")))
    assert _least_seconds(n.select(parse_timestamp("i"))) < 4 * _least_seconds(n.select(parse_timestamp(F.concat(F.lit("garbage "), "i"))))


def test_guards_of_casts_keep_what_the_casts_take(spark):
    numbers = ["12", " +12 ", "\t12\n", "\x0012\x7f", "12.0", "-0.000", "1 2", "+", "", "9223372036854775807", "9223372036854775808", "1e3", "12\x85", "٣"]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(numbers)], "i int, x string").select("i", nullable_bigint("x", strict=False).alias("v")).orderBy("i").collect()
    assert [r.v for r in got] == [12, 12, 12, 12, 12, 0, None, None, None, 2**63 - 1, None, 1000, None, None]
    times = [f"{y}{rest}" for y in (294246, 294247, 294248, 299999, 300000, 999999, 29999, 3000000) for rest in ("", "-01-01", "-12-31 23:59:59")] + ["-290000-01-01", " 300000-01", "2013-01-02"]
    df = spark.createDataFrame([(x,) for x in times], "x string").select("x", F.col("x").try_cast("timestamp_ntz").alias("cast"), parse_timestamp("x").alias("parsed"))
    assert df.where(~F.col("cast").eqNullSafe(F.col("parsed"))).isEmpty() and not df.where("cast > '290000-01-01'").isEmpty()
