"""Staging projections: lenient casts, trimmed text and derived columns per raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.cleaning import parse_bool
from riskloom.functions.scalars import band, flag
from riskloom.plans.sales import CHURN_BANDS, HEALTH_BANDS, cost_variance, forecast_error, sales_measures

# Output column: type. ``text`` is trimmed, ``upper`` trimmed and upper-cased,
# ``strict_date`` fails on bad input. ``a<b`` reads raw column b into a.
SPECS: dict[str, dict[str, str]] = {
    "regions": {
        "region_id": "int", "country": "text", "region": "text", "currency": "upper",
        "fx_to_eur": "decimal(18,6)", "market_growth_factor": "decimal(9,6)", "margin_factor": "decimal(9,6)",
    },
    "products": {
        "product_id": "int", "sku": "upper", "product_family": "text", "product_group": "text",
        "product_name": "text", "launch_year": "smallint", "lifecycle_stage": "text",
        "base_list_price_eur": "decimal(18,2)", "base_unit_cost_eur": "decimal(18,2)",
        "target_margin_pct": "decimal(9,6)", "product_growth_factor": "decimal(9,6)",
    },
    "customers": {
        "customer_id": "int", "customer_code": "upper", "customer_segment": "text", "industry": "text",
        "region_id": "int", "customer_since": "date", "customer_size_score": "decimal(18,6)",
        "base_churn_probability": "decimal(9,6)",
    },
    "sales_reps": {
        "sales_rep_id": "int", "sales_rep_code": "upper", "region_id": "int", "seniority": "text",
        "annual_quota_eur": "decimal(18,2)",
    },
    "sales": {
        "sales_id": "bigint", "order_id": "text", "date_id": "int", "order_date<date": "strict_date",
        "year_month": "strict_date", "customer_id": "int", "product_id": "int", "region_id": "int",
        "sales_rep_id": "int", "units": "int", "asp_eur": "decimal(18,4)", "discount_pct": "decimal(9,6)",
        "revenue_eur": "decimal(18,2)", "revenue_local_currency": "decimal(18,2)", "currency": "text",
        "unit_cost_eur": "decimal(18,4)", "gross_profit_eur": "decimal(18,2)", "gross_margin_pct": "decimal(9,6)",
        "is_outlier_order": "boolean",
    },
    "forecast": {
        "forecast_id": "bigint", "year_month": "date", "product_id": "int", "region_id": "int",
        "forecast_version": "text", "forecast_units": "int", "forecast_revenue_eur": "decimal(18,2)",
        "actual_units": "int", "actual_revenue_eur": "decimal(18,2)",
    },
    "inventory": {
        "inventory_id": "bigint", "year_month": "date", "product_id": "int", "region_id": "int",
        "opening_stock_units": "int", "production_units": "int", "ending_stock_units": "int",
        "stockout_flag": "boolean", "inventory_value_eur": "decimal(18,2)",
    },
    "costs": {
        "cost_id": "bigint", "year_month": "date", "product_id": "int",
        "standard_unit_cost_eur": "decimal(18,4)", "actual_unit_cost_eur": "decimal(18,4)",
    },
    "crm_activities": {
        "activity_id": "bigint", "date_id": "int", "activity_date<date": "date", "customer_id": "int",
        "sales_rep_id": "int", "activity_type": "text", "activity_minutes": "int",
        "sentiment_score": "decimal(9,6)", "customer_health_score": "decimal(9,2)",
    },
    "returns": {
        "return_id": "bigint", "sales_id": "bigint", "date_id": "int", "return_date<date": "date",
        "customer_id": "int", "product_id": "int", "region_id": "int", "return_units": "int",
        "return_value_eur": "decimal(18,2)", "return_reason": "text",
    },
    "opportunities": {
        "opportunity_id": "bigint", "created_date": "date", "customer_id": "int", "product_group": "text",
        "sales_rep_id": "int", "stage": "text", "expected_value_eur": "decimal(18,2)",
        "win_probability": "decimal(9,6)", "expected_close_date": "date", "created_date_id": "int",
        "weighted_pipeline_eur": "decimal(18,2)",
    },
    "market_signals": {
        "year_month": "date", "region_id": "int", "product_family": "text", "product_group": "text",
        "market_demand_index": "decimal(9,2)", "market_growth_pct": "decimal(9,2)",
        "competitor_pressure_index": "decimal(9,2)", "seasonality_index": "decimal(9,2)",
        "macro_business_index": "decimal(9,2)", "supply_pressure_index": "decimal(9,2)",
        "pipeline_interest_index": "decimal(9,2)", "demand_shock_flag": "boolean",
        "market_opportunity_score": "decimal(9,2)",
        # kept at the precision of the raw table
        "regional_market_growth_factor": "decimal(9,6)",
    },
    "market_activity": {
        "year_month": "date", "region_id": "int", "product_id": "int", "campaign_flag": "boolean",
        "campaign_channel": "text", "campaign_spend_eur": "decimal(18,2)", "campaign_impressions": "int",
        "campaign_clicks": "int", "campaign_ctr_pct": "decimal(9,3)", "website_visits": "int",
        "product_page_views": "int", "demo_requests": "int", "marketing_qualified_leads": "int",
        "cost_per_lead_eur": "decimal(18,2)", "regional_crm_activity_index": "decimal(9,2)",
        "pipeline_interest_index": "decimal(9,2)",
    },
}


def staged_column(raw: str, kind: str) -> Column:
    c = F.col(raw)
    if kind == "text":
        return F.trim(c.cast("string"))
    if kind == "upper":
        return F.upper(F.trim(c.cast("string")))
    if kind == "strict_date":
        return c.cast("date")
    if kind == "boolean":
        text = F.lower(F.trim(c.cast("string")))
        return F.when(text.isin("true", "1", "yes", "false", "0", "no"), parse_bool(text))
    if kind == "date":
        return c.cast("string").try_cast("date")
    return c.try_cast(kind)


def stage(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Typed projection of a raw table; raw columns that are absent are skipped."""
    out = []
    for target, kind in spec.items():
        name, _, raw = target.partition("<")
        raw = raw or name
        if raw in df.columns:
            out.append(staged_column(raw, kind).alias(name))
    return df.select(*out)


def stage_products(df: DataFrame) -> DataFrame:
    return stage(df, SPECS["products"]).withColumns(
        {
            "is_declining_product": flag(F.col("lifecycle_stage") == "Decline"),
            "is_new_product": flag(F.col("lifecycle_stage") == "New"),
        }
    )


def stage_customers(df: DataFrame) -> DataFrame:
    return stage(df, SPECS["customers"]).withColumn("churn_risk_band", band("base_churn_probability", *CHURN_BANDS))


def stage_sales(df: DataFrame) -> DataFrame:
    return sales_measures(stage(df, SPECS["sales"]))


def stage_forecast(df: DataFrame) -> DataFrame:
    return forecast_error(stage(df, SPECS["forecast"]))


def stage_inventory(df: DataFrame) -> DataFrame:
    return stage(df, SPECS["inventory"]).withColumn("zero_stock_flag", flag(F.col("ending_stock_units") <= 0))


def stage_costs(df: DataFrame) -> DataFrame:
    return cost_variance(stage(df, SPECS["costs"]))


def stage_crm(df: DataFrame) -> DataFrame:
    return stage(df, SPECS["crm_activities"]).withColumn(
        "customer_health_band", band("customer_health_score", *HEALTH_BANDS)
    )


def stage_opportunities(df: DataFrame) -> DataFrame:
    """Adds days to close and closed flags; stage text is trimmed before it is compared."""
    return stage(df, SPECS["opportunities"]).withColumns(
        {
            "days_to_close": F.datediff("expected_close_date", "created_date"),
            "is_closed_won": flag(F.lower("stage") == "closed won"),
            "is_closed_lost": flag(F.lower("stage") == "closed lost"),
        }
    )


STAGERS = {
    "regions": lambda df: stage(df, SPECS["regions"]),
    "products": stage_products,
    "customers": stage_customers,
    "sales_reps": lambda df: stage(df, SPECS["sales_reps"]),
    "sales": stage_sales,
    "forecast": stage_forecast,
    "inventory": stage_inventory,
    "costs": stage_costs,
    "crm_activities": stage_crm,
    "returns": lambda df: stage(df, SPECS["returns"]),
    "opportunities": stage_opportunities,
    "market_signals": lambda df: stage(df, SPECS["market_signals"]),
    "market_activity": lambda df: stage(df, SPECS["market_activity"]),
}


def stage_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Staged version of every known raw table."""
    return {name: STAGERS[name](df) for name, df in raw.items() if name in STAGERS}


def raw_ddl() -> dict[str, str]:
    """Column lists of the raw tables, derived from the staging types."""
    storage = {"text": "string", "upper": "string", "strict_date": "date"}
    return {
        table: ", ".join(
            f"`{(t.partition('<')[2] or t)}` {storage.get(kind, kind)}" for t, kind in spec.items()
        )
        for table, spec in SPECS.items()
    }
