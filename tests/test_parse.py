"""Lenient typing: the traps where Spark and the reference's engine differ."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from moneytrail.functions.parse import try_date_dmy, try_date_mdy, try_int, try_money


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()[0]


def test_int_accepts_decimal_text(spark):
    assert one(spark, try_int, "2026") == 2026
    assert one(spark, try_int, "2026.0") == 2026
    assert one(spark, try_int, "2.5") == 3
    assert one(spark, try_int, "abc") is None
    assert one(spark, try_int, None) is None


def test_money(spark):
    assert one(spark, try_money, "1.005") == Decimal("1.01")
    assert one(spark, try_money, "-1.005") == Decimal("-1.01")
    assert one(spark, try_money, "1e3") == Decimal("1000.00")
    assert one(spark, try_money, "$5") is None
    assert one(spark, try_money, "1,000") is None
    assert one(spark, try_money, "") is None


def test_mdy_dates(spark):
    assert one(spark, try_date_mdy, "01021995") == dt.date(1995, 1, 2)
    assert one(spark, try_date_mdy, "13021995") is None
    assert one(spark, try_date_mdy, "02301995") is None
    assert one(spark, try_date_mdy, None) is None


def test_dmy_dates_pivot_and_case(spark):
    assert one(spark, try_date_dmy, "05-JAN-26") == dt.date(2026, 1, 5)
    assert one(spark, try_date_dmy, "5-Jan-26") == dt.date(2026, 1, 5)
    assert one(spark, try_date_dmy, "05-JAN-69") == dt.date(1969, 1, 5)
    assert one(spark, try_date_dmy, "05-jan-68") == dt.date(2068, 1, 5)
    assert one(spark, try_date_dmy, "31-FEB-26") is None
