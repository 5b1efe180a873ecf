"""Canonical sales transactions: measures, rejects, effective start dates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions import dates as D
from riskloom.functions.scalars import band, flag, map_values, row_min, safe_divide

# Band limits and labels.
MARGIN_BANDS = ([0.40, 0.25], ["High Margin", "Medium Margin", "Low Margin"])
ORDER_SIZE_BANDS = ([100, 25], ["Large Order", "Medium Order", "Small Order"])
CHURN_BANDS = ([0.12, 0.07], ["High Churn Risk", "Medium Churn Risk", "Low Churn Risk"])
HEALTH_BANDS = ([75, 50], ["Healthy", "Neutral", "At Risk"])

# Chance of winning an opportunity by stage.
STAGE_PROBABILITY = {
    "Lead": 0.10,
    "Qualified": 0.25,
    "Proposal": 0.45,
    "Negotiation": 0.65,
    "Closed Won": 1.00,
    "Closed Lost": 0.00,
}

REQUIRED_SALES_FIELDS = ("year_month", "product_id", "region_id", "transaction_id", "units_sold", "revenue")


def sales_measures(df: DataFrame) -> DataFrame:
    """Cost of goods, discount value, margin and size bands, missing-value flags."""
    return df.withColumns(
        {
            "cogs_eur": F.col("revenue_eur") - F.col("gross_profit_eur"),
            "discount_value_eur": F.col("revenue_eur") * F.col("discount_pct"),
            "margin_category": band("gross_margin_pct", *MARGIN_BANDS),
            "order_size_category": band("units", *ORDER_SIZE_BANDS),
            "missing_sales_rep_flag": flag(F.col("sales_rep_id").isNull()),
            "missing_discount_flag": flag(F.col("discount_pct").isNull()),
            "missing_margin_flag": flag(F.col("gross_margin_pct").isNull()),
        }
    )


def variance(actual: str, reference: str, out: str) -> dict[str, Column]:
    """Absolute and relative deviation from a reference (null when the reference is 0)."""
    gap = F.col(actual) - F.col(reference)
    return {f"{out}_eur": gap, f"{out}_pct": safe_divide(gap, reference)}


def forecast_error(df: DataFrame) -> DataFrame:
    gap = F.col("forecast_revenue_eur") - F.col("actual_revenue_eur")
    return df.withColumns(
        {"forecast_error_eur": gap, "forecast_error_pct": safe_divide(gap, "actual_revenue_eur")}
    )


def cost_variance(df: DataFrame) -> DataFrame:
    return df.withColumns(variance("actual_unit_cost_eur", "standard_unit_cost_eur", "cost_variance"))


def commercial_measures(df: DataFrame) -> DataFrame:
    """Revenue, profit, margin and local-currency revenue from units, price, unit cost and fx."""
    revenue = F.col("units") * F.col("asp_eur")
    profit = revenue - F.col("units") * F.col("unit_cost_eur")
    return df.withColumns(
        {
            "revenue_eur": revenue,
            "gross_profit_eur": profit,
            "gross_margin_pct": safe_divide(profit, revenue),
            "revenue_local_currency": safe_divide(revenue, "fx_to_eur"),
        }
    )


def prorated_return_value(revenue: str = "revenue_eur", returned: str = "return_units", sold: str = "units") -> Column:
    """Share of a sale's revenue that belongs to the returned units."""
    return safe_divide(F.col(revenue) * F.col(returned), sold)


def weighted_value(stage: str = "stage", value: str = "expected_value_eur") -> Column:
    """Opportunity value times the chance of its stage."""
    return F.col(value) * map_values(stage, STAGE_PROBABILITY, 0.0)


def stock_flow(df: DataFrame, ratio: float = 0.12) -> DataFrame:
    """Closing stock never below zero; stockout when it covers less than ``ratio`` of sales."""
    closing = F.greatest(
        F.col("opening_stock_units") + F.col("production_units") - F.col("actual_units"), F.lit(0)
    )
    return df.withColumns(
        {"ending_stock_units": closing, "stockout_flag": closing < F.col("actual_units") * F.lit(ratio)}
    )


def split_valid(df: DataFrame, required: Sequence[str] = REQUIRED_SALES_FIELDS) -> tuple[DataFrame, DataFrame]:
    """Rows with every required field, and the rest."""
    complete = F.lit(True)
    for c in required:
        complete = complete & F.col(c).isNotNull()
    return df.where(complete), df.where(~complete)


def first_seen(df: DataFrame, key: str, c: str, out: str) -> DataFrame:
    """First date per key; null keys are left out."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(c).alias(out))


def effective_start(
    dim: DataFrame, facts: DataFrame, key: str, configured: str, observed_on: str, observed: str, effective: str
) -> DataFrame:
    """Earlier of the configured and the first observed date, per key seen in the facts."""
    seen = first_seen(facts, key, observed_on, observed)
    return seen.join(dim.select(key, configured), key, "left").withColumn(
        effective, row_min([configured, observed])
    )


def product_starts(products: DataFrame, sales: DataFrame) -> DataFrame:
    return effective_start(
        products, sales, "product_id", "launch_date", "order_date", "observed_first_sale_date", "effective_launch_date"
    )


def customer_starts(customers: DataFrame, sales: DataFrame) -> DataFrame:
    return effective_start(
        customers,
        sales,
        "customer_id",
        "customer_since",
        "order_date",
        "observed_first_customer_sale",
        "effective_customer_since",
    )


def launch_issue(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Products that sold before their configured launch month, with the gap in months."""
    seen = first_seen(sales, "product_id", "year_month", "first_sales_month")
    launch = D.month_start("launch_date")
    conflict = F.coalesce(F.col("first_sales_month") < launch, F.lit(False))
    return products.join(seen, "product_id", "left").withColumns(
        {
            "launch_month": launch,
            "effective_launch_month": row_min([launch, F.col("first_sales_month")]),
            "launch_date_issue_flag": flag(conflict),
            "launch_month_gap": F.when(conflict, D.months_diff(launch, "first_sales_month")).otherwise(F.lit(0)),
        }
    )


def launch_audit(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Products with a launch conflict and the sales rows concerned, most affected first."""
    flagged = launch_issue(products, sales).where("launch_date_issue_flag = 1").select(
        "product_id", "product_line", "product_category", "launch_month",
        "first_sales_month", "effective_launch_month", "launch_month_gap",
    )
    launches = products.select("product_id", D.month_start("launch_date").alias("_launch"))
    early = (
        sales.join(launches, "product_id")
        .where(F.col("year_month") < F.col("_launch"))
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("sales_rows_before_configured_launch"),
            F.min("year_month").alias("earliest_sales_month"),
            F.max("year_month").alias("latest_prelaunch_sales_month"),
        )
    )
    return flagged.join(early, "product_id", "left").orderBy(
        F.desc("sales_rows_before_configured_launch"), "product_id"
    )
