from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom import functions as fx
from riskloom.sources.tables import require_parsed


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_normalize_id(spark):
    df = spark.createDataFrame([("1001",), ("1002.0",), (" 1003 ",), (None,), ("nan",), ("None",), ("<NA>",), ("  ",)], "v string")
    assert [r[0] for r in values(df, fx.normalize_id("v"))] == ["1001", "1002", "1003", None, None, None, None, None]


def test_to_month(spark):
    df = spark.createDataFrame([("2024-01-17",), ("2024-02",), ("2024-03-31",), ("not a date",), ("2024-03-31 10:20:30",), (None,)], "v string")
    assert [r[0] for r in values(df, fx.to_month("v"))] == [
        date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1), None, date(2024, 3, 1), None,
    ]


def test_year_month_text(spark):
    df = spark.createDataFrame([("202401",), ("202402.0",), ("2024-03",), ("2024-04-09",), ("2024-13",)], "v string")
    assert [r[0] for r in values(df, fx.year_month_text("v"))] == ["2024-01", "2024-02", "2024-03", "2024-04", None]
    with pytest.raises(ValueError, match="2024-13"):
        require_parsed(df, "v", fx.year_month_text("v"), "m")


def test_parse_number(spark):
    df = spark.createDataFrame([("1.234,56",), ("1,234.56",), ("1234,5",), ("€ 12",), ("",), ("abc",), ("nan",)], "v string")
    assert [r[0] for r in values(df, fx.parse_number("v"))] == [1234.56, 1234.56, 1234.5, 12.0, None, None, None]
    share = spark.createDataFrame([("12,5%",), ("0.5",)], "v string")
    assert [r[0] for r in values(share, fx.parse_number("v", percent=True))] == [0.125, 0.5]


def test_null_handling(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, 2.0)], "a double, b double")
    assert values(df, fx.safe_divide("a", "b")) == [(None,), (None,), (1.5,)]
    assert values(df, fx.clip("a", 0.0, 2.0)) == [(1.0,), (None,), (2.0,)]
    assert values(df, fx.flag(F.col("a") > 0), fx.flag_or_null(F.col("a") > 0, "a")) == [(1, 1), (0, None), (1, 1)]
    assert values(df, fx.row_sum(["a", "b"]), fx.row_min(["a", "b"])) == [(1.0, 0.0), (2.0, 2.0), (5.0, 2.0)]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "a double")
    assert values(odd, fx.finite("a")) == [(None,), (None,), (1.0,)]


def test_calendar_functions(spark):
    df = spark.createDataFrame([(date(2022, 12, 7),), (date(2023, 4, 15),), (date(2023, 1, 1),)], "d date")
    assert values(df, fx.us_week("d"), F.weekofyear("d"), fx.dow_sun1("d"), fx.dow_mon1("d")) == [
        (50, 49, 4, 3), (15, 15, 7, 6), (1, 52, 1, 7),
    ]
    assert values(df, fx.date_key("d"), fx.month_key("d"), fx.next_month("d")) == [
        (20221207, 202212, date(2023, 1, 1)), (20230415, 202304, date(2023, 5, 1)), (20230101, 202301, date(2023, 2, 1)),
    ]


def test_half_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (0.125,), (54.44500000000001,)], "v double")
    assert values(df, fx.half_even("v", 0), fx.half_even("v", 2))[0][0] == 2.0
    assert [r[1] for r in values(df, fx.half_even("v", 0), fx.half_even("v", 2))][2:] == [0.12, 54.44]
