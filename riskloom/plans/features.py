"""Business features on the labelled panel.

Each function adds one family in a single projection. Window features of a
family share the history specification; group benchmarks are aggregates joined
back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from riskloom.functions import dates as D
from riskloom.functions.scalars import clip, finite, flag, flag_or_null, map_values, safe_divide
from riskloom.operators.joins import join_back
from riskloom.operators.ranks import group_ranks
from riskloom.operators.windows import History
from riskloom.plans.history import TARGET
from riskloom.plans.monthly import PANEL_KEYS, customer_mix

# Order of the lifecycle stages.
LIFECYCLE_ORDER = {"New": 0, "Growth": 1, "Mature": 2, "Decline": 3}

# Column order of the compatible output.
BASE_COLUMNS = (
    "product_id", "year_month", "product_line", "product_category", "region", "units_sold", "revenue",
    "unique_customers", "avg_discount_pct", "units_lag_1m", "units_lag_3m", "revenue_lag_1m",
    "rolling_units_mean_3m", "rolling_units_mean_6m", "rolling_units_std_3m", "volatility_3m",
    "mom_units_growth_pct", "customer_count_growth_pct", "trend_slope_3m", "trend_slope_6m",
    "stockout_flag", "backorder_units", "market_demand_index", "competitor_pressure_index",
    "campaign_flag", "website_visits", "demo_requests", "risk_factor_sales_drop",
    "risk_factor_customer_drop", "risk_factor_volatility", "risk_factor_under_trend",
    "next_month_risk_label",
)

SUPPLY_WEIGHTS = {"stockout": 35.0, "zero_stock": 25.0, "backorder": 20.0, "external": 20.0}

PRESSURE_WEIGHTS = {
    "risk_factor_sales_drop": 20.0,
    "risk_factor_customer_drop": 15.0,
    "risk_factor_under_trend": 15.0,
    "high_competition_flag": 15.0,
    "weak_market_flag": 15.0,
    "supply_pressure_score": 0.20,
}

MARKET_GRAIN = ["product_line", "product_category", "region_id"]

PEER_KEYS = ["product_category", "region_id", "year_month"]


def _or(c: str, value: float):
    return F.coalesce(F.col(c).cast("double"), F.lit(float(value)))


def lifecycle(panel: DataFrame) -> DataFrame:
    age = D.months_diff("year_month", "effective_launch_date", floor=0)
    stage = F.col("lifecycle_stage")
    return panel.withColumns(
        {
            "product_group": F.col("product_category"),
            "product_age_months": age,
            "lifecycle_stage_num": map_values("lifecycle_stage", LIFECYCLE_ORDER, -1),
            "is_decline_stage": flag(stage == "Decline"),
            "is_growth_stage": flag(stage == "Growth"),
            "is_mature_product": flag(age >= 36),
        }
    )


def profitability(panel: DataFrame) -> DataFrame:
    est_profit = F.col("revenue") - F.col("units_sold") * F.col("base_unit_cost_eur")
    est_margin = safe_divide(est_profit, "revenue")
    return panel.withColumns(
        {
            "estimated_gross_profit": est_profit,
            "estimated_gross_margin_pct": est_margin,
            "margin_gap_vs_target": est_margin - F.col("target_margin_pct"),
            "actual_margin_gap_vs_target": F.col("gross_margin_pct") - F.col("target_margin_pct"),
            "actual_vs_estimated_margin_gap": F.col("gross_margin_pct") - est_margin,
            "gross_profit_per_unit": safe_divide("gross_profit_eur", "units_sold"),
            "cost_variance_to_revenue": safe_divide("cost_variance_eur", "revenue"),
            "return_value_rate": safe_divide("return_value_eur", "revenue"),
        }
    )


# output: (numerator, denominator)
FUNNEL_RATIOS = {
    "campaign_spend_per_visit": ("campaign_spend_eur", "website_visits"),
    "campaign_spend_per_demo": ("campaign_spend_eur", "demo_requests"),
    "page_view_to_visit_ratio": ("product_page_views", "website_visits"),
    "demo_conversion_rate": ("demo_requests", "product_page_views"),
    "mql_conversion_rate": ("marketing_qualified_leads", "product_page_views"),
    "click_to_mql_rate": ("marketing_qualified_leads", "campaign_clicks"),
    "digital_interest_per_unit": ("product_page_views", "units_sold"),
}


def funnel(panel: DataFrame) -> DataFrame:
    ratios = {out: safe_divide(a, b) for out, (a, b) in FUNNEL_RATIOS.items()}
    idle = flag((F.col("campaign_spend_eur") > 0) & (F.col("units_sold") == 0))
    return panel.withColumns({**ratios, "campaign_active_with_no_sales": idle})


def campaign_history(panel: DataFrame, history: History | None = None) -> DataFrame:
    h = history or History()
    return panel.withColumns(
        {
            "campaign_spend_lag_1m": h.lag("campaign_spend_eur"),
            "campaign_spend_rolling_3m": h.rolling("campaign_spend_eur", 3, 1, "sum"),
            "website_visits_growth_pct": h.growth("website_visits"),
            "demo_requests_growth_pct": h.growth("demo_requests"),
        }
    )


SUPPLY_RATIOS = {
    "production_to_sales_ratio": ("production_units", "units_sold"),
    "ending_stock_to_sales_ratio": ("ending_stock_units", "units_sold"),
    "inventory_months_cover": ("ending_stock_units", "rolling_units_mean_3m"),
    "inventory_turnover_proxy": ("units_sold", "ending_stock_units"),
    "backorder_rate": ("backorder_units", "units_sold"),
}


def supply_ratios(panel: DataFrame) -> DataFrame:
    ratios = {out: safe_divide(a, b) for out, (a, b) in SUPPLY_RATIOS.items()}
    return panel.withColumns(
        {**ratios, "stock_change_units": F.col("ending_stock_units") - F.col("opening_stock_units")}
    )


def supply_pressure_score(panel: DataFrame, weights: Mapping[str, float] = SUPPLY_WEIGHTS) -> DataFrame:
    external = clip(_or("supply_pressure_index", 50), 0.0, 100.0) / 100
    score = (
        clip(_or("stockout_flag", 0), 0.0, 1.0) * weights["stockout"]
        + clip(_or("zero_stock_flag", 0), 0.0, 1.0) * weights["zero_stock"]
        + clip(_or("backorder_rate", 0), 0.0, 1.0) * weights["backorder"]
        + external * weights["external"]
    )
    return panel.withColumn("supply_pressure_score", clip(score, 0.0, 100.0))


def return_pressure(panel: DataFrame) -> DataFrame:
    score = clip(_or("return_rate_units", 0), 0.0, 1.0) * 60 + clip(_or("return_value_rate", 0), 0.0, 1.0) * 40
    return panel.withColumns(
        {
            "return_pressure_score": clip(score, 0.0, 100.0),
            "stockout_with_demand_flag": flag((F.col("stockout_flag") == 1) & (F.col("units_sold") > 0)),
        }
    )


def market_context(panel: DataFrame) -> DataFrame:
    """Market ratios, a tailwind score with neutral fills, and null-preserving flags."""
    tailwind = (
        (_or("market_demand_index", 100) - 100) * 0.35
        + (100 - _or("competitor_pressure_index", 50)) * 0.20
        + (_or("macro_business_index", 100) - 100) * 0.15
        + (_or("market_opportunity_score", 50) - 50) * 0.20
        + clip(_or("market_growth_pct", 0), -1.0, 1.0) * 10
    )
    demand, rivals = F.col("market_demand_index"), F.col("competitor_pressure_index")
    return panel.withColumns(
        {
            "seasonality_adjusted_units": safe_divide("units_sold", F.col("seasonality_index") / 100),
            "demand_competition_ratio": safe_divide(demand, rivals),
            "market_tailwind_score": tailwind,
            "high_competition_flag": flag_or_null(rivals >= 70, rivals),
            "weak_market_flag": flag_or_null(demand < 90, demand),
        }
    )


MARKET_CHANGES = {
    "market_demand_change_pct": "market_demand_index",
    "macro_business_index_pct": "macro_business_index",
    "competitor_pressure_change_pct": "competitor_pressure_index",
    "market_opportunity_change_pct": "market_opportunity_score",
    "supply_pressure_change_pct": "supply_pressure_index",
}


def market_change_table(panel: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Month-on-month market changes, one row per market grain and month.

    The panel repeats a market row for every product of the group, so rows are
    reduced to one per market-month before the lag. With ``signals`` given only
    the keys are read from the panel.
    """
    grain = [*MARKET_GRAIN, "year_month"]
    values = list(dict.fromkeys(MARKET_CHANGES.values()))
    if signals is None:
        unique = panel.groupBy(*grain).agg(*[F.max(c).alias(c) for c in values])
    else:
        unique = panel.select(*grain).distinct().join(signals.select(*grain, *values), grain, "left")
    h = History(keys=MARKET_GRAIN)
    return unique.select(*grain, *[h.growth(src).alias(out) for out, src in MARKET_CHANGES.items()])


def market_changes(panel: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """Panel with the changes of its market joined back."""
    return panel.join(market_change_table(panel, signals), [*MARKET_GRAIN, "year_month"], "left")


def peer_table(panel: DataFrame, keys: Sequence[str] = PEER_KEYS) -> DataFrame:
    """Category-region-month totals, shares, discount gap and two ranks, one row per panel key.

    Works on the few columns it needs, so the wide panel is not shuffled by peer
    group. Totals are aggregated and joined back; ranks use value-range
    splitting, so a category holding a third of all products is still spread
    over tasks.
    """
    narrow = panel.select(
        *dict.fromkeys([*PANEL_KEYS, *keys, "units_sold", "revenue", "unique_customers", "avg_discount_pct"])
    )
    totals = join_back(
        narrow,
        keys,
        {
            "category_region_units_2": F.sum("units_sold"),
            "category_region_revenue": F.sum("revenue"),
            "category_region_customers": F.sum("unique_customers"),
            "category_region_avg_discount": F.avg("avg_discount_pct"),
            "category_region_product_count": F.count_distinct("product_id"),
        },
    )
    units_rank = group_ranks(narrow, keys, "units_sold", descending=True).select(
        *keys, "units_sold", F.col("dense_rank").alias("unit_rank_category_region")
    )
    revenue_rank = group_ranks(narrow, keys, "revenue").select(
        *keys, "revenue", F.col("rank_share").alias("revenue_percentile_category_region")
    )
    ranked = totals.join(units_rank, [*keys, "units_sold"], "left").join(revenue_rank, [*keys, "revenue"], "left")
    shares = {
        "product_unit_share_category_region": safe_divide("units_sold", "category_region_units_2"),
        "product_revenue_share_category_region": safe_divide("revenue", "category_region_revenue"),
        "customer_share_category_region": safe_divide("unique_customers", "category_region_customers"),
        "discount_vs_category_region": F.col("avg_discount_pct") - F.col("category_region_avg_discount"),
    }
    return ranked.select(
        *PANEL_KEYS, "category_region_units_2", "category_region_revenue", "category_region_customers",
        "category_region_avg_discount", "category_region_product_count", "unit_rank_category_region",
        "revenue_percentile_category_region", *[e.alias(n) for n, e in shares.items()],
    )


def peer_benchmarks(panel: DataFrame, keys: Sequence[str] = PEER_KEYS) -> DataFrame:
    """Panel with its peer benchmarks."""
    return panel.join(peer_table(panel, keys), PANEL_KEYS, "left")


def momentum(panel: DataFrame, history: History | None = None) -> DataFrame:
    h = history or History()
    share = "product_unit_share_category_region"
    windowed = panel.withColumns(
        {
            "unit_share_lag_1m": h.lag(share),
            "unit_share_change_pct": h.growth(share),
            "units_acceleration_3m": h.diff("trend_slope_3m"),
            "rolling_units_cv_6m": safe_divide(
                h.rolling("units_sold", 6, 3, "std"), h.rolling("units_sold", 6, 3)
            ),
            "rolling_revenue_mean_3m": h.rolling("revenue", 3, 2),
            "rolling_revenue_std_3m": h.rolling("revenue", 3, 2, "std"),
        }
    )
    return windowed.withColumns(
        {
            "units_vs_6m_avg_pct": safe_divide(
                F.col("units_sold") - F.col("rolling_units_mean_6m"), "rolling_units_mean_6m"
            ),
            "revenue_vs_lag_1m_pct": safe_divide(F.col("revenue") - F.col("revenue_lag_1m"), "revenue_lag_1m"),
            "revenue_volatility_3m": safe_divide("rolling_revenue_std_3m", "rolling_revenue_mean_3m"),
        }
    )


CUSTOMER_LAGS = (
    "avg_customer_size_score", "avg_customer_churn_probability", "distributor_order_share",
    "churn_risk_customer_share",
)


def customer_lags(panel: DataFrame, history: History | None = None) -> DataFrame:
    """Alias of the churn mean and one-month lags of the customer mix."""
    h = history or History()
    named = panel.withColumn("avg_customer_churn_probability", F.col("avg_base_churn_probability"))
    return named.withColumns({f"{c}_lag_1m": h.lag(c) for c in CUSTOMER_LAGS})


def customer_mix_features(panel: DataFrame, cpm: DataFrame, distributor: str = "Distributor") -> DataFrame:
    """Panel with customer-mix shares, per-order averages and their lags."""
    return customer_lags(panel.join(customer_mix(cpm, distributor), PANEL_KEYS, "left"))


def growths(panel: DataFrame, history: History | None = None) -> DataFrame:
    h = history or History()
    return panel.withColumns(
        {
            "gross_profit_growth_pct": h.growth("gross_profit_eur"),
            "weighted_pipeline_growth_pct": h.growth("weighted_pipeline_eur"),
            "return_rate_change_pct": h.growth("return_rate_units"),
        }
    )


def interactions(panel: DataFrame) -> DataFrame:
    demand, supply = F.col("market_demand_index"), F.col("supply_pressure_index")
    leads = F.col("marketing_qualified_leads")
    return panel.withColumns(
        {
            "demand_supply_gap": demand - supply,
            "demand_supply_mismatch_flag": flag_or_null((demand >= 110) & (supply >= 65), demand, supply),
            "engagement_to_pipeline_ratio": safe_divide(leads, "pipeline_opportunities"),
            "pipeline_value_per_customer": safe_divide("weighted_pipeline_eur", "unique_customers"),
            "marketing_efficiency_score": safe_divide(leads + F.col("demo_requests"), "campaign_spend_eur"),
        }
    )


def commercial_pressure(panel: DataFrame, weights: Mapping[str, float] = PRESSURE_WEIGHTS) -> DataFrame:
    total = F.lit(0.0)
    for column, weight in weights.items():
        total = total + _or(column, 0) * weight
    score = clip(total, 0.0, 100.0)
    return panel.withColumns(
        {"commercial_pressure_score": score, "revenue_at_risk_proxy": F.col("revenue") * score / 100}
    )


def side_tables(panel: DataFrame, signals: DataFrame) -> dict[str, DataFrame]:
    """Peer benchmarks and market changes as tables of their own."""
    return {"peers": peer_table(panel), "changes": market_change_table(panel, signals)}


def add_side_tables(wide: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Side tables joined to a panel with its sources.

    Peers and mix share the panel key with the other sources, so joining them
    here, before the history windows, costs no extra exchange of the wide rows.
    """
    keyed = wide.join(tables["peers"], PANEL_KEYS, "left").join(tables["mix"], PANEL_KEYS, "left")
    return keyed.join(tables["changes"], [*MARKET_GRAIN, "year_month"], "left")


def derived_features(labelled: DataFrame) -> DataFrame:
    """All feature families on a labelled panel that has its side tables.

    Projections and windows over one history specification only: after the
    label's exchange the rows are not moved again.
    """
    out = labelled
    for step in (
        lifecycle, profitability, funnel, campaign_history, supply_ratios, supply_pressure_score, return_pressure,
        market_context, momentum, customer_lags, growths, interactions, commercial_pressure,
    ):
        out = step(out)
    return out


def without_infinite(df: DataFrame) -> DataFrame:
    """NaN and infinities of all floating-point columns become null."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: finite(c) for c in floats}) if floats else df


def output_contracts(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compatible data set (fixed columns) and enriched data set (the same columns first, no future values)."""
    missing = [c for c in BASE_COLUMNS if c not in panel.columns]
    if missing:
        raise ValueError(f"panel lacks contract columns: {missing}")
    text_months = without_infinite(panel).withColumn("year_month", F.date_format("year_month", "yyyy-MM"))
    if "target_month" in panel.columns:
        text_months = text_months.withColumn("target_month", F.date_format("target_month", "yyyy-MM"))
    extras = [
        c for c in panel.columns
        if c not in BASE_COLUMNS and not c.startswith("future_") and c != "target_risk_score"
    ]
    return text_months.select(*BASE_COLUMNS), text_months.select(*BASE_COLUMNS, *extras)


def scoring_rows(df: DataFrame, target: str = TARGET) -> tuple[DataFrame, DataFrame]:
    """Labelled rows and rows waiting for their outcome."""
    return df.where(F.col(target).isNotNull()), df.where(F.col(target).isNull())
