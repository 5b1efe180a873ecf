"""Region and product-group drivers of the market tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.cleaning import parse_bool
from riskloom.functions.scalars import clip, half_even, safe_divide, select_case
from riskloom.operators.joins import spread_over
from riskloom.operators.windows import History, index_to_mean
from riskloom.plans.monthly import crm_region_month
from riskloom.plans.panel import within

GROUP_KEYS = ["year_month", "product_category", "region_id"]


def month_region_grid(months: DataFrame, regions: DataFrame) -> DataFrame:
    return spread_over(months.select("year_month"), regions.select("region_id").distinct())


def group_grid(months: DataFrame, groups: DataFrame, regions: DataFrame) -> DataFrame:
    return spread_over(month_region_grid(months, regions), groups.select("product_category").distinct())


def crm_index(crm: DataFrame, months: DataFrame, regions: DataFrame, neutral: float | None = 100.0) -> DataFrame:
    """CRM activity of a region against the month's regional mean (100 = average)."""
    observed = crm_region_month(within(crm, months)).select(
        "year_month", "region_id", "crm_activity_count", "crm_activity_minutes",
        F.col("avg_customer_health_score").alias("average_customer_health"),
    )
    full = (
        month_region_grid(months, regions)
        .join(observed, ["year_month", "region_id"], "left")
        .fillna(0, subset=["crm_activity_count", "crm_activity_minutes"])
        .fillna(65.0, subset=["average_customer_health"])
    )
    return index_to_mean(full, "crm_activity_count", ["year_month"], "regional_crm_activity_index", 250.0, neutral)


def opportunity_index(
    opportunities: DataFrame, months: DataFrame, groups: DataFrame, regions: DataFrame, neutral: float | None = None
) -> DataFrame:
    """Opportunity count of a group and region against the month's mean."""
    observed = within(opportunities, months).groupBy(*GROUP_KEYS).agg(
        F.count_distinct("opportunity_id").alias("opportunity_count"),
        F.sum("weighted_pipeline_eur").alias("weighted_pipeline_eur"),
        F.avg("win_probability").alias("average_win_probability"),
    )
    full = group_grid(months, groups, regions).join(observed, GROUP_KEYS, "left").fillna(
        0, subset=["opportunity_count", "weighted_pipeline_eur", "average_win_probability"]
    )
    return index_to_mean(full, "opportunity_count", ["year_month"], "pipeline_interest_index", 300.0, neutral)


def supply_driver(inventory: DataFrame) -> DataFrame:
    """Stockout rate and mean available-stock ratio per group, region and month."""
    available = F.col("opening_stock_units") + F.col("production_units")
    ratio = clip(safe_divide("ending_stock_units", available), 0.0, 1.0)
    return inventory.groupBy(*GROUP_KEYS).agg(
        F.avg(parse_bool("stockout_flag").cast("int")).alias("stockout_rate"),
        F.avg(ratio).alias("average_available_stock_ratio"),
    )


def supply_index(inventory: DataFrame, grid: DataFrame) -> DataFrame:
    """Supply pressure 5..100; combinations without inventory get neutral values."""
    joined = grid.join(supply_driver(inventory), GROUP_KEYS, "left").withColumn(
        "inventory_observed_flag", F.col("stockout_rate").isNotNull().cast("int")
    )
    filled = joined.fillna(0.0, subset=["stockout_rate"]).fillna(0.5, subset=["average_available_stock_ratio"])
    raw = 25 + F.col("stockout_rate") * 65 + (1 - F.col("average_available_stock_ratio")) * 35
    return filled.withColumn("supply_pressure_index", half_even(clip(raw, 5.0, 100.0), 2))


def sales_driver(sales: DataFrame) -> DataFrame:
    return sales.groupBy(*GROUP_KEYS).agg(F.sum("units_sold").alias("observed_units"))


def momentum_index(sales: DataFrame, grid: DataFrame) -> DataFrame:
    """Last month's units against the six months before it; neutral 100."""
    h = History(keys=("product_category", "region_id"))
    full = grid.join(sales_driver(sales), GROUP_KEYS, "left").fillna(0, subset=["observed_units"])
    lagged = full.withColumns(
        {
            "units_lag_1m": h.lag("observed_units"),
            "prior_units_baseline_6m": h.rolling("observed_units", 6, 2, gap=2),
        }
    )
    ratio = safe_divide(F.col("units_lag_1m") * 100, "prior_units_baseline_6m")
    return lagged.withColumn("historical_sales_momentum_index", clip(F.coalesce(ratio, F.lit(100.0)), 0.0, 250.0))


def seasonality_index(month: Column) -> Column:
    """130 in the fourth quarter, 82 in July and August, else 100."""
    return select_case(
        [month.isin(10, 11, 12), month.isin(7, 8)], [F.lit(130.0), F.lit(82.0)], F.lit(100.0)
    )


def opportunity_score(
    demand: str = "market_demand_index",
    rivals: str = "competitor_pressure_index",
    supply: str = "supply_pressure_index",
    interest: str = "pipeline_interest_index",
) -> Column:
    raw = (
        F.col(demand) * 0.40
        + (100 - F.col(rivals)) * 0.22
        + (100 - F.col(supply)) * 0.15
        + clip(interest, hi=100.0) * 0.23
    )
    return clip(raw, 0.0, 100.0)
