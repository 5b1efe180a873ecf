"""Calendar dimensions and month domains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import dates as D


def _days(spark: SparkSession, start: str, end: str) -> DataFrame:
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(span).alias("d"))


def describe_days(days: DataFrame, c: Column | str = "d") -> DataFrame:
    """The 18 calendar columns for the distinct dates in ``days``."""
    d = F.col("_d")
    base = days.select((F.col(c) if isinstance(c, str) else c).alias("_d")).distinct()
    return base.select(
        D.date_key(d).alias("DateKey"),
        d.alias("Date"),
        F.year(d).alias("Year"),
        F.quarter(d).alias("Quarter"),
        F.concat(F.lit("Q"), F.quarter(d)).alias("QuarterName"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.date_format(d, "MMM").alias("MonthShortName"),
        F.date_format(d, "yyyy-MM").alias("YearMonth"),
        D.month_key(d).alias("YearMonthKey"),
        D.month_start(d).alias("MonthStartDate"),
        F.last_day(d).alias("MonthEndDate"),
        F.dayofmonth(d).alias("Day"),
        D.dow_sun1(d).alias("DayOfWeek"),
        F.date_format(d, "EEEE").alias("DayName"),
        D.us_week(d).alias("WeekOfYear"),
        F.weekofyear(d).alias("ISOWeek"),
        D.is_weekend(d).alias("IsWeekend"),
    )


def calendar(spark: SparkSession, start: str = "2020-01-01", end: str = "2030-12-31") -> DataFrame:
    """Reporting calendar, one row per day."""
    return describe_days(_days(spark, start, end))


def source_calendar(days: DataFrame, c: Column | str = "d") -> DataFrame:
    """Operational calendar variant (Monday = 1, month and quarter ends)."""
    d = F.col("_d")
    base = days.select((F.col(c) if isinstance(c, str) else c).alias("_d")).distinct()
    return base.select(
        D.date_key(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        D.dow_mon1(d).alias("day_of_week"),
        F.weekofyear(d).alias("week_of_year"),
        D.is_month_end(d).alias("is_month_end"),
        D.is_quarter_end(d).alias("is_quarter_end"),
    )


def date_span(df: DataFrame, c: Column | str, unit: str = "day") -> DataFrame:
    """Every day (or month start) between the first and last date of a source: column ``d``."""
    value = F.col(c) if isinstance(c, str) else c
    value = D.month_start(value) if unit == "month" else value.cast("date")
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return ends.select(F.explode(F.sequence("lo", "hi", F.expr(f"interval 1 {unit}"))).alias("d"))


def months(bounds: DataFrame) -> DataFrame:
    """Continuous month list from a one-row (first_date, last_date) frame."""
    lo, hi = D.month_start("first_date"), D.month_start("last_date")
    return bounds.select(F.explode(F.sequence(lo, hi, F.expr("interval 1 month"))).alias("year_month"))


def attach_calendar(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Month-level calendar attributes; gaps in ``dates`` are filled from the month itself."""
    m = F.col("year_month")
    by_month = dates.groupBy(D.month_start("Date").alias("year_month")).agg(
        *[F.min(c).alias(c) for c in ("Year", "Quarter", "Month", "MonthName", "YearMonthKey")]
    )
    joined = df.join(by_month, "year_month", "left")
    fallback = {
        "Year": F.year(m),
        "Quarter": F.quarter(m),
        "Month": F.month(m),
        "MonthName": F.date_format(m, "MMMM"),
        "YearMonthKey": D.month_key(m),
    }
    return joined.withColumns({name: F.coalesce(F.col(name), expr) for name, expr in fallback.items()})
