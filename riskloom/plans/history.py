"""Lags, rolling statistics, current risk flags and the next-month label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import dates as D
from riskloom.functions.scalars import flag, row_sum, safe_divide, select_case
from riskloom.operators.windows import History

TARGET = "next_month_risk_label"

TRIGGERS = (
    "future_sales_drop_trigger", "future_customer_drop_trigger", "future_volatility_trigger",
    "future_under_trend_trigger", "future_stockout_trigger",
)


def time_features(panel: DataFrame, history: History | None = None) -> DataFrame:
    """Lags, shifted rolling statistics, growth and trend of units and customers."""
    h = history or History()
    windowed = panel.withColumns(
        {
            "units_lag_1m": h.lag("units_sold", 1),
            "units_lag_3m": h.lag("units_sold", 3),
            "revenue_lag_1m": h.lag("revenue", 1),
            "customers_lag_1m": h.lag("unique_customers", 1),
            "rolling_units_mean_3m": h.rolling("units_sold", 3, 2),
            "rolling_units_mean_6m": h.rolling("units_sold", 6, 3),
            "rolling_units_std_3m": h.rolling("units_sold", 3, 2, "std"),
            "trend_slope_3m": h.slope("units_sold", 3),
            "trend_slope_6m": h.slope("units_sold", 6),
            "mom_units_growth_pct": h.growth("units_sold"),
            "customer_count_growth_pct": h.growth("unique_customers"),
        }
    )
    return windowed.withColumn("volatility_3m", safe_divide("rolling_units_std_3m", "rolling_units_mean_3m"))


def expected_units() -> Column:
    """Three-month mean plus its trend, the trend counting as 0 when unknown."""
    return F.col("rolling_units_mean_3m") + F.coalesce(F.col("trend_slope_3m"), F.lit(0.0))


def settled(c: Column | str) -> Column:
    """Nine decimals: a ratio that equals a limit must not pass it by summation noise."""
    return F.round(F.col(c) if isinstance(c, str) else c, 9)


def risk_flags(panel: DataFrame, drop: float = -0.25, vol: float = 0.45, under: float = 0.75) -> DataFrame:
    """Current-month risk factors; unknown comparisons are 0."""
    expected = expected_units()
    return panel.withColumns(
        {
            "risk_factor_sales_drop": flag(F.col("mom_units_growth_pct") < drop),
            "risk_factor_customer_drop": flag(F.col("customer_count_growth_pct") < drop),
            "risk_factor_volatility": flag(settled("volatility_3m") > vol),
            "risk_factor_under_trend": flag((F.col("units_sold") < settled(expected * under)) & (expected > 0)),
        }
    )


def future_triggers(
    panel: DataFrame, ratio: float = 0.75, vol: float = 0.50, under: float = 0.72, history: History | None = None
) -> DataFrame:
    """Next-month outcomes turned into five 0/1 triggers."""
    h = history or History()
    ahead = panel.withColumns(
        {
            "future_units": h.lead("units_sold"),
            "future_customers": h.lead("unique_customers"),
            "future_volatility": h.lead("volatility_3m"),
            "future_expected_units": h.lead(expected_units()),
            "future_stockout": h.lead("stockout_flag"),
            "_is_last": h.is_last(),
        }
    )
    nxt, exp = F.col("future_units"), F.col("future_expected_units")
    return ahead.withColumns(
        {
            "future_sales_drop_trigger": flag(nxt < F.col("units_sold") * ratio),
            "future_customer_drop_trigger": flag(F.col("future_customers") < F.col("unique_customers") * ratio),
            "future_volatility_trigger": flag(settled("future_volatility") > vol),
            "future_under_trend_trigger": flag((nxt < settled(exp * under)) & (exp > 0)),
            "future_stockout_trigger": F.coalesce(F.col("future_stockout").cast("int"), F.lit(0)),
        }
    )


def risk_label(panel: DataFrame, medium_min: int = 1, high_min: int = 3) -> DataFrame:
    """Trigger count to a 0/1/2 label; the last month of a history has no label."""
    score = F.col("target_risk_score")
    label = select_case([score >= high_min, score >= medium_min], [F.lit(2), F.lit(1)], F.lit(0))
    return (
        panel.withColumn("target_risk_score", row_sum(TRIGGERS).cast("int"))
        .withColumns({TARGET: F.when(~F.col("_is_last"), label), "target_month": D.next_month("year_month")})
        .drop("_is_last")
    )


def labelled_panel(panel: DataFrame) -> DataFrame:
    """History features, risk flags, triggers and label in one pass over the sorted panel."""
    return risk_label(future_triggers(risk_flags(time_features(panel))))
