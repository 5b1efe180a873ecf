"""Month-level aggregates of every source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scalars import contains_any, flag, safe_divide
from riskloom.functions.cleaning import unknown_if_null
from riskloom.operators.quantiles import exact_medians
from riskloom.session import dealt

PANEL_KEYS = ["product_id", "region_id", "year_month"]

# Activity types that count as a demonstration.
DEMO_WORDS = "demo|visit|meeting|presentation"


def most_common(c: str, default: str = "Unknown") -> Column:
    """Most frequent label, smallest on ties. The buffer holds one count per distinct label."""
    return F.coalesce(F.mode(F.col(c).cast("string"), True), F.lit(default))


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def _modal_labels(df: DataFrame, keys: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Most frequent known label per key and column, smallest on ties, ``Unknown`` where none is known.

    Rows are counted per (key, label) first, so one key's rows never meet as rows.
    """
    counted = df.groupBy(*keys, *labels).agg(F.count(F.lit(1)).alias("_n"))
    cells = F.array(*[F.struct(F.lit(c).alias("_which"), F.col(c).cast("string").alias("_label"), F.col("_n")) for c in labels])
    per_label = counted.select(*keys, F.inline(cells)).groupBy(*keys, "_which", "_label").agg(F.sum("_n").alias("_n"))
    known = F.when(F.col("_label").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_label").alias("label")))
    return per_label.groupBy(*keys).agg(
        *[F.coalesce(F.min(F.when(F.col("_which") == c, known))["label"], F.lit("Unknown")).alias(c) for c in labels]
    )


def customer_product_monthly(sales: DataFrame) -> DataFrame:
    """Customer × product × region × month; rows with null keys form groups of their own.

    Segment and churn band are the group's most frequent labels, so a key has
    one row even where its labels vary. Rows are exchanged once, by the key;
    counting orders and labels inside a key needs no further exchange.
    """
    keys = ["year_month", "customer_id", "product_id", "region_id"]
    labels = ["customer_segment", "churn_risk_band"]
    measures = ["units_sold", "revenue", "avg_discount_pct", "gross_profit_eur"]
    return (
        dealt(sales.select(*keys, "transaction_id", *labels, *measures), *keys)
        .groupBy(*keys)
        .agg(
            F.sum("units_sold").alias("units_sold"),
            F.sum("revenue").alias("revenue"),
            F.count_distinct("transaction_id").alias("order_count"),
            F.avg("avg_discount_pct").alias("avg_discount_pct"),
            F.sum("gross_profit_eur").alias("gross_profit_eur"),
            *[most_common(c).alias(c) for c in labels],
        )
    )


# Distinct counts of ``monthly_sales``: output: column.
DISTINCT_COUNTS = {"unique_customers": "customer_id", "order_count": "transaction_id", "active_sales_reps": "sales_rep_id"}

# Dominant labels of ``monthly_sales``: output: column.
DOMINANT_LABELS = {
    "dominant_margin_category": "margin_category", "dominant_order_size_category": "order_size_category",
    "dominant_rep_seniority": "seniority",
}


def monthly_sales(sales: DataFrame, keys: Sequence[str] = PANEL_KEYS, counted: Sequence[DataFrame] = ()) -> DataFrame:
    """Product × region × month sales: sums, distinct counts, means, flag sums, dominant labels.

    Every distinct count is an aggregate of its own over its key and column: in
    one aggregate Spark would repeat each row once per distinct column before
    the exchange. Labels are counted first and compared after, as a mode over
    rows would sort a scan's rows. All sides end partitioned by ``keys``, so
    joining them needs no further exchange. ``counted`` has tables by ``keys``
    that already hold distinct counts (a key they lack counts 0); their other
    columns come last.
    """
    known = _known(sales, keys)
    measures = known.groupBy(*keys).agg(
        F.sum("units_sold").alias("units_sold"),
        F.sum("revenue").alias("revenue"),
        F.avg("avg_discount_pct").alias("avg_discount_pct"),
        F.avg("asp_eur").alias("avg_asp_eur"),
        F.sum("gross_profit_eur").alias("gross_profit_eur"),
        F.sum("cogs_eur").alias("cogs_eur"),
        F.sum("discount_value_eur").alias("discount_value_eur"),
        F.sum(F.col("is_outlier_order").cast("int")).alias("outlier_order_count"),
        F.sum("missing_sales_rep_flag").alias("missing_sales_rep_count"),
        F.sum("missing_discount_flag").alias("missing_discount_count"),
        F.sum("missing_margin_flag").alias("missing_margin_count"),
    )
    labels = _modal_labels(known, keys, list(DOMINANT_LABELS.values())).withColumnsRenamed(
        {c: n for n, c in DOMINANT_LABELS.items()}
    )
    held = [c for t in counted for c in t.columns if c not in keys]
    extra = [c for c in held if c not in DISTINCT_COUNTS]
    counts = [
        known.groupBy(*keys).agg(F.count_distinct(c).alias(n)) for n, c in DISTINCT_COUNTS.items() if n not in held
    ]
    joined = measures
    for table in [labels, *counts, *counted]:
        joined = joined.join(table, list(keys), "left")
    return joined.select(
        *measures.columns,
        *DOMINANT_LABELS,
        *[F.coalesce(n, F.lit(0)).alias(n) for n in DISTINCT_COUNTS],
        safe_divide("gross_profit_eur", "revenue").alias("gross_margin_pct"),
        *extra,
    )


def customer_counts(sales: DataFrame, enterprise: str = "Enterprise", keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Number and mix of the customers of a group-month, each customer counted once."""
    attrs = ["customer_segment", "churn_risk_band", "customer_size_score", "base_churn_probability"]
    # dealt before they are reduced: the smallest row of attributes, by which a customer counts
    # where they vary, is found by sorting, which would spill on the larger inputs of a scan
    rows = dealt(_known(sales, keys).select(*keys, "customer_id", *attrs), *keys, "customer_id")
    once = rows.groupBy(*keys, "customer_id").agg(F.min(F.struct(*attrs)).alias("_row")).select(*keys, "customer_id", "_row.*")
    return once.groupBy(*keys).agg(
        F.count("customer_id").alias("unique_customers"),
        F.avg("customer_size_score").alias("avg_customer_size_score"),
        F.avg("base_churn_probability").alias("avg_base_churn_probability"),
        F.sum(flag(F.col("customer_segment") == enterprise)).alias("enterprise_customer_count"),
        F.sum(contains_any("churn_risk_band", "high")).alias("high_churn_customer_count"),
    )


def customer_month_features(
    sales: DataFrame, enterprise: str = "Enterprise", keys: Sequence[str] = PANEL_KEYS
) -> DataFrame:
    """Customer mix with each customer counted once per group-month."""
    return customer_counts(sales, enterprise, keys).drop("unique_customers")


def rep_counts(sales: DataFrame, reps: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Number and annual quota of the representatives active in a group-month, each counted once.

    Pairs are made distinct before the quota is looked up, so the lookup joins
    the small side of the aggregation.
    """
    active = _known(sales, [*keys, "sales_rep_id"]).select(*keys, "sales_rep_id").distinct()
    quotas = reps.groupBy("sales_rep_id").agg(F.sum("annual_quota_eur").alias("annual_quota_eur"))
    return (
        active.join(quotas, "sales_rep_id", "left")
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("active_sales_reps"),
            F.coalesce(F.sum("annual_quota_eur"), F.lit(0.0)).alias("covered_annual_quota_eur"),
        )
    )


def quota_month(sales: DataFrame, reps: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Annual quota of the representatives active in a group-month, each counted once."""
    return rep_counts(sales, reps, keys).drop("active_sales_reps")


def sales_by_panel_key(
    sales: DataFrame, reps: DataFrame, enterprise: str = "Enterprise", counted: Sequence[DataFrame] = ()
) -> DataFrame:
    """Everything sales contributes to the panel.

    Sums, customer mix and quota share the panel key, so after their own
    aggregations the joins need no further exchange. The tables of customers and
    representatives also hold the number of each; ``counted`` may hold others.
    """
    return monthly_sales(sales, counted=[*counted, customer_counts(sales, enterprise), rep_counts(sales, reps)])


def inventory_monthly(inventory: DataFrame) -> DataFrame:
    return (
        _known(inventory, PANEL_KEYS)
        .groupBy(*PANEL_KEYS)
        .agg(
            F.sum("opening_stock_units").alias("opening_stock_units"),
            F.sum("production_units").alias("production_units"),
            F.sum("ending_stock_units").alias("ending_stock_units"),
            F.max(flag(F.col("stockout_flag").cast("boolean"))).alias("stockout_flag"),
            F.max(flag(F.col("zero_stock_flag").cast("boolean"))).alias("zero_stock_flag"),
            F.sum("inventory_value_eur").alias("inventory_value_eur"),
        )
    )


def cost_monthly(costs: DataFrame) -> DataFrame:
    measures = ["standard_unit_cost_eur", "actual_unit_cost_eur", "cost_variance_eur", "cost_variance_pct"]
    keys = ["product_id", "year_month"]
    return _known(costs, keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in measures])


def returns_monthly(returns: DataFrame) -> DataFrame:
    """Returned units, value and distinct returns per panel key; the count travels without the sums."""
    groups = _known(returns, PANEL_KEYS).groupBy(*PANEL_KEYS)
    sums = groups.agg(
        F.sum("return_units").alias("return_units"),
        F.sum("return_value_eur").alias("return_value_eur"),
    )
    return sums.join(groups.agg(F.count_distinct("return_id").alias("return_count")), PANEL_KEYS)


def crm_region_month(crm: DataFrame, period: str = "year_month") -> DataFrame:
    """CRM activity per region and period."""
    keys = [period, "region_id"]
    return (
        _known(crm, keys)
        .groupBy(*keys)
        .agg(
            F.count_distinct("activity_id").alias("crm_activity_count"),
            F.sum("activity_minutes").alias("crm_activity_minutes"),
            F.sum(contains_any("activity_type", DEMO_WORDS)).alias("crm_demo_like_count"),
            F.avg("sentiment_score").alias("avg_sentiment_score"),
            F.avg("customer_health_score").alias("avg_customer_health_score"),
        )
    )


def opportunity_monthly(opportunities: DataFrame) -> DataFrame:
    """Opportunities per month, region and product category, with the conversion rate."""
    closed = F.col("closed_won_count") + F.col("closed_lost_count")
    return (
        _known(opportunities, ["year_month", "region_id"])
        .withColumn("product_category", unknown_if_null("product_category"))
        .groupBy("year_month", "region_id", "product_category")
        .agg(
            F.count_distinct("opportunity_id").alias("pipeline_opportunities"),
            F.sum("weighted_pipeline_eur").alias("weighted_pipeline_eur"),
            F.sum("expected_value_eur").alias("expected_pipeline_eur"),
            F.avg("win_probability").alias("avg_win_probability"),
            F.avg("days_to_close").alias("avg_days_to_close"),
            F.sum("is_closed_won").alias("closed_won_count"),
            F.sum("is_closed_lost").alias("closed_lost_count"),
        )
        .withColumn("pipeline_conversion_rate", safe_divide("closed_won_count", closed))
    )


def market_activity_monthly(activity: DataFrame) -> DataFrame:
    """Campaign and web activity; rates come from the summed totals, not from averaged rates."""
    sums = [
        "campaign_spend_eur", "campaign_impressions", "campaign_clicks", "website_visits",
        "product_page_views", "demo_requests", "marketing_qualified_leads",
    ]
    return (
        _known(activity, PANEL_KEYS)
        .groupBy(*PANEL_KEYS)
        .agg(
            F.max(F.col("campaign_flag").cast("int")).alias("campaign_flag"),
            most_common("campaign_channel").alias("campaign_channel"),
            *[F.sum(c).alias(c) for c in sums],
            F.avg("regional_crm_activity_index").alias("regional_crm_activity_index"),
            F.avg("pipeline_interest_index").alias("activity_pipeline_interest_index"),
        )
        .withColumns(
            {
                "campaign_ctr_pct": F.coalesce(
                    safe_divide("campaign_clicks", "campaign_impressions") * 100, F.lit(0.0)
                ),
                "cost_per_lead_eur": safe_divide("campaign_spend_eur", "marketing_qualified_leads"),
                "market_activity_available_flag": F.lit(1),
            }
        )
    )


SIGNAL_KEYS = ["year_month", "product_line", "product_category", "region_id"]


def market_signals_monthly(signals: DataFrame) -> DataFrame:
    means = [
        "market_demand_index", "market_growth_pct", "competitor_pressure_index", "seasonality_index",
        "macro_business_index", "supply_pressure_index", "market_opportunity_score", "regional_market_growth_factor",
    ]
    return (
        _known(signals, ["year_month", "region_id"])
        .withColumns({c: unknown_if_null(c) for c in ("product_line", "product_category")})
        .groupBy(*SIGNAL_KEYS)
        .agg(
            *[F.avg(c).alias(c) for c in means],
            F.avg("pipeline_interest_index").alias("market_pipeline_interest_index"),
            F.max(F.col("demand_shock_flag").cast("int")).alias("demand_shock_flag"),
        )
        .withColumn("market_signal_available_flag", F.lit(1))
    )


def group_profile(products: DataFrame) -> DataFrame:
    """Product groups: size, median list price, mean target margin, growth and decline share."""
    keys = ["product_line", "product_category"]
    medians = exact_medians(products, keys, ["base_list_price_eur"])
    return products.groupBy(*keys).agg(
        F.count_distinct("product_id").alias("product_count"),
        F.avg("target_margin_pct").alias("average_target_margin_pct"),
        F.avg("product_growth_factor").alias("average_product_growth_factor"),
        F.avg("is_declining_product").alias("decline_product_share"),
    ).join(medians.withColumnRenamed("median_base_list_price_eur", "median_list_price_eur"), keys, "left")


def ambiguous_groups(products: DataFrame) -> DataFrame:
    """Product categories that occur in more than one product line."""
    return products.groupBy("product_category").agg(
        F.count_distinct("product_line").alias("product_lines")
    ).where("product_lines > 1")


def monthly_actuals(sales: DataFrame) -> DataFrame:
    return sales.groupBy("year_month", "product_id", "region_id").agg(
        F.sum("units_sold").alias("actual_units"),
        F.sum("revenue").alias("actual_revenue_eur"),
        F.sum("gross_profit_eur").alias("actual_gp_eur"),
    )


def campaign_summary(activity: DataFrame) -> DataFrame:
    """Activity with and without a campaign."""
    means = {
        "average_spend_eur": "campaign_spend_eur",
        "average_impressions": "campaign_impressions",
        "average_website_visits": "website_visits",
        "average_demo_requests": "demo_requests",
        "average_mqls": "marketing_qualified_leads",
    }
    medians = exact_medians(activity, ["campaign_flag"], ["cost_per_lead_eur"])
    return activity.groupBy("campaign_flag").agg(
        F.count(F.lit(1)).alias("row_count"), *[F.avg(c).alias(n) for n, c in means.items()]
    ).join(medians, "campaign_flag", "left")


def channel_summary(activity: DataFrame) -> DataFrame:
    return (
        activity.where("campaign_flag = 1")
        .groupBy("campaign_channel")
        .agg(
            F.count(F.lit(1)).alias("campaigns"),
            F.avg("campaign_spend_eur").alias("average_spend_eur"),
            F.avg("campaign_ctr_pct").alias("average_ctr_pct"),
            F.avg("marketing_qualified_leads").alias("average_mqls"),
        )
        .orderBy(F.desc("campaigns"), "campaign_channel")
    )


def customer_mix(cpm: DataFrame, distributor: str = "Distributor") -> DataFrame:
    """Shares of active customers and per-order averages."""
    orders = F.sum("order_count")
    return (
        _known(cpm, PANEL_KEYS)
        .groupBy(*PANEL_KEYS)
        .agg(
            F.avg(flag(F.col("customer_segment") == distributor)).alias("distributor_order_share"),
            F.avg(contains_any("churn_risk_band", "high")).alias("churn_risk_customer_share"),
            safe_divide(F.sum("units_sold"), orders).alias("avg_order_units"),
            safe_divide(F.sum("revenue"), orders).alias("avg_order_revenue"),
        )
    )
