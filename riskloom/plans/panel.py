"""Dense product × region × month panel and its source context."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import dates as D
from riskloom.functions.scalars import flag, safe_divide
from riskloom.functions.cleaning import unknown_if_null
from riskloom.operators.joins import spread_over
from riskloom.operators.sets import union_all
from riskloom.operators.windows import keep_one
from riskloom.plans.monthly import PANEL_KEYS, SIGNAL_KEYS

# Counts and amounts that are zero in a month without sales.
ZERO_WITHOUT_SALES = (
    "units_sold", "revenue", "unique_customers", "order_count", "active_sales_reps",
    "gross_profit_eur", "cogs_eur", "discount_value_eur", "outlier_order_count",
    "missing_sales_rep_count", "missing_discount_count", "missing_margin_count",
    "enterprise_customer_count", "high_churn_customer_count", "covered_annual_quota_eur",
)

RETURN_COUNTS = ("return_units", "return_value_eur", "return_count")

ACTIVITY_COUNTS = (
    "crm_activity_count", "crm_activity_minutes", "crm_demo_like_count", "pipeline_opportunities",
    "weighted_pipeline_eur", "expected_pipeline_eur", "closed_won_count", "closed_lost_count",
)


def after_launch(df: DataFrame, launch: str = "effective_launch_date") -> DataFrame:
    """Months from the launch month on; rows with an unknown launch stay."""
    return df.where(F.col(launch).isNull() | (F.col("year_month") >= D.month_start(launch)))


def within(df: DataFrame, months: DataFrame) -> DataFrame:
    """Facts inside the month horizon."""
    return df.join(months.select("year_month"), "year_month", "left_semi")


def grid(products: DataFrame, regions: DataFrame, bounds: DataFrame, launch: str = "effective_launch_date") -> DataFrame:
    """All product-region-month combinations from launch (or horizon start) to horizon end.

    Months are generated per product, so pre-launch months are never produced,
    and the horizon is a scalar subquery.
    """
    ends = bounds.select(
        F.struct(D.month_start("first_date").alias("lo"), D.month_start("last_date").alias("hi"))
    ).scalar()
    start = F.greatest(D.month_start(launch), F.col("_ends.lo"))
    span = F.when(start <= F.col("_ends.hi"), F.sequence(start, F.col("_ends.hi"), F.expr("interval 1 month")))
    by_month = products.withColumn("_ends", ends).withColumn("year_month", F.explode(span)).drop("_ends")
    return spread_over(by_month, regions)


def zero_fill(df: DataFrame, columns: Sequence[str] = ZERO_WITHOUT_SALES) -> DataFrame:
    """Counts and amounts become 0; ratios and averages are left missing."""
    present = [c for c in columns if c in df.columns]
    return df.fillna(0, subset=present)


def build_panel(
    products: DataFrame, starts: DataFrame, regions: DataFrame, bounds: DataFrame, monthly: DataFrame
) -> DataFrame:
    """Grid with product and region attributes and monthly sales attached."""
    launched = products.join(
        starts.select("product_id", "observed_first_sale_date", "effective_launch_date"), "product_id", "left"
    ).withColumns(
        {
            "effective_launch_date": F.coalesce("effective_launch_date", "launch_date"),
            "product_line": unknown_if_null("product_line"),
            "product_category": unknown_if_null("product_category"),
        }
    )
    named = regions.withColumn("region", unknown_if_null("region"))
    cells = grid(launched, named, bounds)
    filled = zero_fill(cells.join(monthly, PANEL_KEYS, "left"))
    return filled.withColumn("no_sales_flag", flag(F.col("units_sold") == 0))


def supply_fields(panel: DataFrame) -> DataFrame:
    """Availability flag, backorders (only where inventory is known) and supply coverage."""
    supply = F.coalesce(F.col("opening_stock_units"), F.lit(0)) + F.coalesce(F.col("production_units"), F.lit(0))
    known = F.col("opening_stock_units").isNotNull()
    return panel.withColumns(
        {
            "inventory_available_flag": known.cast("int"),
            "backorder_units": F.when(known, F.greatest(F.col("units_sold") - supply, F.lit(0))).otherwise(F.lit(0)),
            "supply_coverage_ratio": safe_divide(supply, "units_sold"),
            "stockout_flag": F.coalesce("stockout_flag", F.lit(0)),
            "zero_stock_flag": F.coalesce("zero_stock_flag", F.lit(0)),
        }
    )


def attach_sources(panel: DataFrame, sources: Mapping[str, DataFrame]) -> DataFrame:
    """Join the monthly sources that are given; each already has the grain of its key."""
    out = panel
    if "inventory" in sources:
        out = supply_fields(out.join(sources["inventory"], PANEL_KEYS, "left"))
    if "returns" in sources:
        out = zero_fill(out.join(sources["returns"], PANEL_KEYS, "left"), RETURN_COUNTS).withColumn(
            "return_rate_units", safe_divide("return_units", "units_sold")
        )
    if "activity" in sources:
        out = out.join(sources["activity"], PANEL_KEYS, "left").withColumn(
            "market_activity_available_flag", F.coalesce("market_activity_available_flag", F.lit(0))
        )
    if "costs" in sources:
        out = out.join(sources["costs"], ["product_id", "year_month"], "left")
    if "crm" in sources:
        out = zero_fill(out.join(sources["crm"], ["year_month", "region_id"], "left"), ACTIVITY_COUNTS)
    if "opportunities" in sources:
        keys = ["year_month", "region_id", "product_category"]
        out = zero_fill(out.join(sources["opportunities"], keys, "left"), ACTIVITY_COUNTS)
    if "signals" in sources:
        out = out.join(sources["signals"], SIGNAL_KEYS, "left").withColumn(
            "market_signal_available_flag", F.coalesce("market_signal_available_flag", F.lit(0))
        )
    return out


def active_panel(eligible: DataFrame, sales: DataFrame, products: DataFrame) -> DataFrame:
    """Eligible cells plus every observed sales cell; on overlap the sales cell wins."""
    columns = ["year_month", "product_id", "region_id", "effective_launch_month"]
    observed = (
        sales.select("year_month", "product_id", "region_id").distinct()
        .join(products.select("product_id", "effective_launch_month"), "product_id", "left")
    )
    tagged = union_all(
        eligible.select(*columns).withColumns({"_priority": F.lit(0), "source": F.lit("eligible")}),
        observed.select(*columns).withColumns({"_priority": F.lit(1), "source": F.lit("sales")}),
    )
    return keep_one(tagged, ["year_month", "product_id", "region_id"], [F.col("_priority")], last=True).drop("_priority")
