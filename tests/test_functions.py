"""Scalar functions F1-F14 on hand-made edge rows."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from saleslens.functions import dates as fd
from saleslens.functions import money as fm
from saleslens.functions import text as ft


def test_line_total_rounds_after_each_multiply(spark):
    df = spark.createDataFrame([("3.3333", 3, "0.1000"), ("10.0000", 2, "0.0000"), ("0.0001", 1, "0.5000")],
                               "p string, q int, d string")
    r = df.select(fm.line_total(F.col("p").cast(fm.MONEY), F.col("q").cast("smallint"),
                                F.col("d").cast(fm.MONEY)).alias("lt")).collect()
    # 3.3333*3 = 9.9999 -> *0.9 = 8.99991 -> 8.9999 ; 20 ; 0.00005 -> 0.0001 (half up)
    assert [x.lt for x in r] == [Decimal("8.9999"), Decimal("20.0000"), Decimal("0.0001")]


def test_margin_pct_zero_line_total_is_null(spark):
    df = spark.createDataFrame([("0.0000", "5.0000", 1), ("100.0000", "60.0000", 1)],
                               "lt string, c string, q int")
    df = df.select(F.col("lt").cast(fm.MONEY).alias("LineTotal"), F.col("c").cast(fm.MONEY).alias("StandardCost"),
                   F.col("q").cast("smallint").alias("OrderQty"))
    r = df.withColumn("m", fm.margin()).select("m", fm.margin_pct("m", "LineTotal").alias("pct")).collect()
    assert r[0].m == Decimal("-5.0000") and r[0].pct is None
    assert r[1].m == Decimal("40.0000") and r[1].pct == 40.0


def test_parse_currency_and_percent_edge_text(spark):
    rows = [("€ 120,450.00", "-59.97%"), ("-€ 180,450.50", "11.17%"), ("", ""), ("n/a", "1,234.5%"),
            ("1e3", "1e3%"), ("  12", " 12%"), ('"€ 70.005"', '"-5%"'), (None, None)]
    df = spark.createDataFrame(rows, "c string, p string")
    r = df.select(ft.parse_currency("c").alias("c"), ft.parse_percent("p").alias("p")).collect()
    got = [(x.c, x.p) for x in r]
    assert got == [(Decimal("120450.00"), Decimal("-59.9700")), (Decimal("-180450.50"), Decimal("11.1700")),
                   (None, None), (None, None), (None, None), (None, None),
                   (Decimal("70.01"), Decimal("-5.0000")), (None, None)]


def test_format_round_trips_through_parse(spark):
    df = spark.createDataFrame([("-180450.50",), ("1000.5",), ("0",)], "x string") \
              .select(F.col("x").cast("decimal(18,2)").alias("x"))
    r = df.select("x", ft.parse_currency(ft.format_currency("x")).alias("y")).collect()
    assert all(a.x == a.y for a in r)
    assert df.select(ft.format_currency("x")).first()[0] == "-€ 180,450.50"


def test_date_shift_keeps_distance_and_null(spark):
    df = spark.createDataFrame([(dt.date(2001, 7, 31),), (None,)], "d date")
    r = df.select(fd.shift_date("d", dt.date(2001, 8, 1), dt.date(2026, 1, 1)).alias("s")).collect()
    assert r[0].s == dt.date(2025, 12, 31) and r[1].s is None


def test_year_bounds_leap_years(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2025, 1, 1),), (dt.date(2025, 12, 31),),
                                (dt.date(2024, 12, 31),)], "a date")
    r = df.select(fd.elapsed_days_inclusive(F.col("a")).alias("e"),
                  fd.days_in_prior_year(F.col("a")).alias("d")).collect()
    assert [(x.e, x.d) for x in r] == [(60, 365), (1, 366), (365, 366), (366, 365)]


def test_sale_price_and_coerce(spark):
    df = spark.createDataFrame([("10.0050",), ("0",), (None,)], "lp string")
    r = df.select(fm.sale_price(F.col("lp").cast(fm.MONEY)).alias("s")).collect()
    assert [x.s for x in r] == [Decimal("6.0000"), None, None]
    t = spark.createDataFrame([("12",), ("abc",), (None,)], "t string")
    assert [x.v for x in t.select(fm.coerce_numeric("t").alias("v")).collect()] == [12.0, 0.0, 0.0]
