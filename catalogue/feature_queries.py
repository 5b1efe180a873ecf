"""Domain features, market drivers and output column sets."""

from pyspark.sql import functions as F

from catalogue.base import customer_months, features, labelled, panel, query, written
from riskloom.operators.sets import sort_by
from riskloom.plans import features as fe, history as H, market as mk
from riskloom.plans.calendar import months
from riskloom.plans.panel import within
from riskloom.plans.sales import launch_issue, product_starts
from riskloom.session import materialize
from riskloom.sources.star import DISTRIBUTOR, Star

KEYS = ["product_id", "region_id", "year_month"]
_K = "product_id, region_id, year_month"


@query(
    "flagship_current_risk",
    f"""SELECT {_K}, units_sold, units_lag_1m, mom_units_growth_pct, trend_slope_3m, risk_factor_sales_drop, risk_factor_under_trend
        FROM t_flags WHERE risk_factor_sales_drop + risk_factor_under_trend > 0
        ORDER BY risk_factor_sales_drop + risk_factor_under_trend DESC, mom_units_growth_pct NULLS LAST, {_K}""",
    rounded="units_sold units_lag_1m mom_units_growth_pct trend_slope_3m",
)
def current_risk(star: Star):
    """Which product-regions show a sales drop or an under-trend month, most severe first."""
    # one pass over the joined facts; launch dates come from the same monthly rows
    monthly = materialize(
        star.raw_sales().groupBy(*KEYS).agg(
            F.sum("units").alias("units_sold"), F.sum("revenue_eur").alias("revenue"),
            F.count_distinct("customer_id").alias("unique_customers"), F.min("order_date").alias("order_date"),
        ),
        "flagship-monthly",
    )
    star.__dict__["starts"] = product_starts(star.products, monthly)
    flagged = H.risk_flags(H.time_features(star.panel(monthly.drop("order_date"))))
    severity = F.col("risk_factor_sales_drop") + F.col("risk_factor_under_trend")
    rows = flagged.withColumn("severity", severity).where("severity > 0")
    return sort_by(rows, "-severity", "mom_units_growth_pct", *KEYS).select(
        *KEYS, "units_sold", "units_lag_1m", "mom_units_growth_pct", "trend_slope_3m", "risk_factor_sales_drop",
        "risk_factor_under_trend",
    )


@query(
    "fe01_risk_flags",
    f"""SELECT {_K}, risk_factor_sales_drop, risk_factor_customer_drop, risk_factor_volatility, risk_factor_under_trend FROM t_flags""",
)
def risk_flags(star):
    return H.risk_flags(H.time_features(panel(star))).select(
        *KEYS, "risk_factor_sales_drop", "risk_factor_customer_drop", "risk_factor_volatility", "risk_factor_under_trend"
    )


@query(
    "fe02_future_triggers",
    f"""SELECT {_K}, future_sales_drop_trigger, future_customer_drop_trigger, future_volatility_trigger,
               future_under_trend_trigger, future_stockout_trigger FROM t_labelled""",
)
def future_triggers(star):
    return labelled(star).select(*KEYS, *H.TRIGGERS)


@query(
    "fe03_risk_label",
    f"SELECT {_K}, target_risk_score, next_month_risk_label, target_month FROM t_labelled",
)
def risk_label(star):
    return labelled(star).select(*KEYS, "target_risk_score", H.TARGET, "target_month")


@query(
    "fe03_risk_label_two_trigger_medium",
    f"""SELECT {_K}, CASE WHEN last_row THEN NULL WHEN target_risk_score >= 3 THEN 2 WHEN target_risk_score >= 2 THEN 1 ELSE 0 END
               AS next_month_risk_label FROM t_labelled""",
)
def risk_label_alternative(star):
    base = labelled(star).drop("target_risk_score", H.TARGET, "target_month")
    relabelled = H.risk_label(base.withColumn("_is_last", F.col("future_units").isNull()), medium_min=2)
    return relabelled.select(*KEYS, H.TARGET)


@query(
    "fe04_lifecycle",
    f"""SELECT {_K}, product_category AS product_group,
               CAST(greatest(date_diff('month', effective_launch_date, year_month), 0) AS INTEGER) AS product_age_months,
               CASE lifecycle_stage WHEN 'New' THEN 0 WHEN 'Growth' THEN 1 WHEN 'Mature' THEN 2 WHEN 'Decline' THEN 3 ELSE -1 END
                 AS lifecycle_stage_num,
               CAST(lifecycle_stage = 'Decline' AS INTEGER) AS is_decline_stage,
               CAST(lifecycle_stage = 'Growth' AS INTEGER) AS is_growth_stage,
               CAST(date_diff('month', effective_launch_date, year_month) >= 36 AS INTEGER) AS is_mature_product FROM t_panel""",
)
def lifecycle(star):
    return fe.lifecycle(panel(star)).select(
        *KEYS, "product_group", "product_age_months", "lifecycle_stage_num", "is_decline_stage", "is_growth_stage", "is_mature_product"
    )


@query(
    "fe05_profitability",
    f"""SELECT {_K}, revenue - units_sold * base_unit_cost_eur AS estimated_gross_profit,
               (revenue - units_sold * base_unit_cost_eur) / nullif(revenue, 0) AS estimated_gross_margin_pct,
               (revenue - units_sold * base_unit_cost_eur) / nullif(revenue, 0) - target_margin_pct AS margin_gap_vs_target,
               gross_margin_pct - target_margin_pct AS actual_margin_gap_vs_target,
               gross_margin_pct - (revenue - units_sold * base_unit_cost_eur) / nullif(revenue, 0) AS actual_vs_estimated_margin_gap,
               gross_profit_eur / nullif(units_sold, 0) AS gross_profit_per_unit,
               cost_variance_eur / nullif(revenue, 0) AS cost_variance_to_revenue,
               return_value_eur / nullif(revenue, 0) AS return_value_rate FROM t_full""",
    rounded="""estimated_gross_profit estimated_gross_margin_pct margin_gap_vs_target actual_margin_gap_vs_target
               actual_vs_estimated_margin_gap gross_profit_per_unit cost_variance_to_revenue return_value_rate""",
)
def profitability(star):
    return fe.profitability(labelled(star)).select(
        *KEYS, "estimated_gross_profit", "estimated_gross_margin_pct", "margin_gap_vs_target", "actual_margin_gap_vs_target",
        "actual_vs_estimated_margin_gap", "gross_profit_per_unit", "cost_variance_to_revenue", "return_value_rate",
    )


@query(
    "fe06_funnel",
    f"""SELECT {_K}, campaign_spend_eur / nullif(website_visits, 0) AS campaign_spend_per_visit,
               campaign_spend_eur / nullif(demo_requests, 0) AS campaign_spend_per_demo,
               product_page_views / nullif(website_visits, 0) AS page_view_to_visit_ratio,
               demo_requests / nullif(product_page_views, 0) AS demo_conversion_rate,
               marketing_qualified_leads / nullif(product_page_views, 0) AS mql_conversion_rate,
               marketing_qualified_leads / nullif(campaign_clicks, 0) AS click_to_mql_rate,
               product_page_views / nullif(units_sold, 0) AS digital_interest_per_unit,
               CASE WHEN campaign_spend_eur > 0 AND units_sold = 0 THEN 1 ELSE 0 END AS campaign_active_with_no_sales FROM t_full""",
    rounded="""campaign_spend_per_visit campaign_spend_per_demo page_view_to_visit_ratio demo_conversion_rate
               mql_conversion_rate click_to_mql_rate digital_interest_per_unit""",
)
def funnel(star):
    return fe.funnel(labelled(star)).select(*KEYS, *fe.FUNNEL_RATIOS, "campaign_active_with_no_sales")


_PRIOR = """FROM t_full p LEFT JOIN t_full w ON w.product_id = p.product_id AND w.region_id = p.region_id AND w.mi = p.mi - 1"""


@query(
    "fe07_campaign_history",
    f"""SELECT p.product_id, p.region_id, p.year_month, w.campaign_spend_eur AS campaign_spend_lag_1m,
               (SELECT sum(v.campaign_spend_eur) FROM t_full v WHERE v.product_id = p.product_id AND v.region_id = p.region_id
                  AND v.mi BETWEEN p.mi - 3 AND p.mi - 1) AS campaign_spend_rolling_3m,
               (p.website_visits - w.website_visits) / nullif(w.website_visits, 0) AS website_visits_growth_pct,
               (p.demo_requests - w.demo_requests) / nullif(w.demo_requests, 0) AS demo_requests_growth_pct {_PRIOR}""",
    rounded="campaign_spend_lag_1m campaign_spend_rolling_3m website_visits_growth_pct demo_requests_growth_pct",
)
def campaign_history(star):
    return fe.campaign_history(labelled(star)).select(
        *KEYS, "campaign_spend_lag_1m", "campaign_spend_rolling_3m", "website_visits_growth_pct", "demo_requests_growth_pct"
    )


@query(
    "fe08_supply_ratios",
    f"""SELECT {_K}, production_units / nullif(units_sold, 0) AS production_to_sales_ratio,
               ending_stock_units / nullif(units_sold, 0) AS ending_stock_to_sales_ratio,
               ending_stock_units / nullif(rolling_units_mean_3m, 0) AS inventory_months_cover,
               units_sold / nullif(ending_stock_units, 0) AS inventory_turnover_proxy,
               ending_stock_units - opening_stock_units AS stock_change_units, backorder_rate FROM t_scored""",
    rounded="""production_to_sales_ratio ending_stock_to_sales_ratio inventory_months_cover inventory_turnover_proxy
               stock_change_units backorder_rate""",
)
def supply_ratios(star):
    return fe.supply_ratios(labelled(star)).select(*KEYS, *fe.SUPPLY_RATIOS, "stock_change_units")


@query("fe09_supply_pressure", f"SELECT {_K}, supply_pressure_score FROM t_scored", rounded="supply_pressure_score")
def supply_pressure(star):
    return fe.supply_pressure_score(fe.supply_ratios(labelled(star))).select(*KEYS, "supply_pressure_score")


@query(
    "fe10_return_pressure",
    f"""SELECT {_K}, least(greatest(coalesce(return_rate_units, 0), 0), 1) * 60
               + least(greatest(coalesce(return_value_eur / nullif(revenue, 0), 0), 0), 1) * 40 AS return_pressure_score,
               CASE WHEN stockout_flag = 1 AND units_sold > 0 THEN 1 ELSE 0 END AS stockout_with_demand_flag FROM t_full""",
    rounded="return_pressure_score",
)
def return_pressure(star):
    return fe.return_pressure(fe.profitability(labelled(star))).select(*KEYS, "return_pressure_score", "stockout_with_demand_flag")


@query(
    "fe11_market_context",
    f"""SELECT {_K}, units_sold / nullif(seasonality_index / 100, 0) AS seasonality_adjusted_units,
               market_demand_index / nullif(competitor_pressure_index, 0) AS demand_competition_ratio,
               (coalesce(market_demand_index, 100) - 100) * 0.35 + (100 - coalesce(competitor_pressure_index, 50)) * 0.20
               + (coalesce(macro_business_index, 100) - 100) * 0.15 + (coalesce(market_opportunity_score, 50) - 50) * 0.20
               + least(greatest(coalesce(market_growth_pct, 0), -1), 1) * 10 AS market_tailwind_score,
               high_competition_flag, weak_market_flag FROM t_scored""",
    rounded="seasonality_adjusted_units demand_competition_ratio market_tailwind_score",
)
def market_context(star):
    return fe.market_context(labelled(star)).select(
        *KEYS, "seasonality_adjusted_units", "demand_competition_ratio", "market_tailwind_score", "high_competition_flag",
        "weak_market_flag",
    )


@query(
    "fe12_market_changes",
    f"""SELECT p.product_id, p.region_id, p.year_month,
               {', '.join(f"(p.{s} - w.{s}) / nullif(w.{s}, 0) AS {o}" for o, s in fe.MARKET_CHANGES.items())}
        FROM (SELECT t.product_id, t.region_id, t.year_month, t.product_line, t.product_category,
                     s.market_demand_index, s.macro_business_index, s.competitor_pressure_index, s.market_opportunity_score,
                     s.supply_pressure_index
              FROM t_panel t LEFT JOIN t_signals s ON s.year_month = t.year_month AND s.product_line = t.product_line
                AND s.product_category = t.product_category AND s.region_id = t.region_id) p
        LEFT JOIN t_signals w ON w.year_month = p.year_month - INTERVAL 1 MONTH AND w.product_line = p.product_line
          AND w.product_category = p.product_category AND w.region_id = p.region_id""",
    rounded=" ".join(fe.MARKET_CHANGES),
)
def market_changes(star):
    return fe.market_changes(labelled(star)).select(*KEYS, *fe.MARKET_CHANGES)


_GROUP = "(PARTITION BY product_category, region_id, year_month)"


@query(
    "fe13_peer_benchmarks",
    f"""SELECT {_K}, sum(units_sold) OVER {_GROUP} AS category_region_units_2, sum(revenue) OVER {_GROUP} AS category_region_revenue,
               CAST(sum(unique_customers) OVER {_GROUP} AS BIGINT) AS category_region_customers,
               avg(avg_discount_pct) OVER {_GROUP} AS category_region_avg_discount,
               count(*) OVER {_GROUP} AS category_region_product_count,
               units_sold / nullif(sum(units_sold) OVER {_GROUP}, 0) AS product_unit_share_category_region,
               revenue / nullif(sum(revenue) OVER {_GROUP}, 0) AS product_revenue_share_category_region,
               unique_customers / nullif(sum(unique_customers) OVER {_GROUP}, 0) AS customer_share_category_region,
               avg_discount_pct - avg(avg_discount_pct) OVER {_GROUP} AS discount_vs_category_region,
               dense_rank() OVER (PARTITION BY product_category, region_id, year_month ORDER BY units_sold DESC) AS unit_rank_category_region,
               (rank() OVER (PARTITION BY product_category, region_id, year_month ORDER BY revenue)
                 + (count(*) OVER (PARTITION BY product_category, region_id, year_month, revenue) - 1) / 2.0)
                 / count(*) OVER {_GROUP} AS revenue_percentile_category_region FROM t_panel""",
    rounded="""category_region_units_2 category_region_revenue category_region_avg_discount product_unit_share_category_region
               product_revenue_share_category_region customer_share_category_region discount_vs_category_region
               revenue_percentile_category_region""",
)
def peer_benchmarks(star):
    return fe.peer_benchmarks(panel(star)).select(
        *KEYS, "category_region_units_2", "category_region_revenue", "category_region_customers", "category_region_avg_discount",
        "category_region_product_count", "product_unit_share_category_region", "product_revenue_share_category_region",
        "customer_share_category_region", "discount_vs_category_region", "unit_rank_category_region",
        "revenue_percentile_category_region",
    )


@query(
    "fe14_momentum",
    f"""WITH s AS (SELECT p.product_id, p.region_id, p.year_month, p.mi, p.units_sold, p.revenue,
                     p.units_sold / nullif(sum(p.units_sold) OVER (PARTITION BY p.product_category, p.region_id, p.year_month), 0) AS share,
                     h.* EXCLUDE (product_id, region_id, year_month)
                   FROM t_panel p JOIN t_hist h ON h.product_id = p.product_id AND h.region_id = p.region_id AND h.year_month = p.year_month)
        SELECT a.product_id, a.region_id, a.year_month, b.share AS unit_share_lag_1m,
               (a.share - b.share) / nullif(b.share, 0) AS unit_share_change_pct,
               a.trend_slope_3m - b.trend_slope_3m AS units_acceleration_3m,
               (a.units_sold - a.rolling_units_mean_6m) / nullif(a.rolling_units_mean_6m, 0) AS units_vs_6m_avg_pct,
               (a.revenue - a.revenue_lag_1m) / nullif(a.revenue_lag_1m, 0) AS revenue_vs_lag_1m_pct,
               a.rolling_units_std_6m / nullif(a.rolling_units_mean_6m, 0) AS rolling_units_cv_6m,
               a.rolling_revenue_mean_3m, a.rolling_revenue_std_3m,
               a.rolling_revenue_std_3m / nullif(a.rolling_revenue_mean_3m, 0) AS revenue_volatility_3m
        FROM s a LEFT JOIN s b ON b.product_id = a.product_id AND b.region_id = a.region_id AND b.mi = a.mi - 1""",
    rounded="""unit_share_lag_1m unit_share_change_pct units_acceleration_3m units_vs_6m_avg_pct revenue_vs_lag_1m_pct
               rolling_units_cv_6m rolling_revenue_mean_3m rolling_revenue_std_3m revenue_volatility_3m""",
)
def momentum(star):
    return features(star).select(
        *KEYS, "unit_share_lag_1m", "unit_share_change_pct", "units_acceleration_3m", "units_vs_6m_avg_pct", "revenue_vs_lag_1m_pct",
        "rolling_units_cv_6m", "rolling_revenue_mean_3m", "rolling_revenue_std_3m", "revenue_volatility_3m",
    )


@query(
    "fe15_customer_mix_features",
    f"""WITH s AS (SELECT p.product_id, p.region_id, p.year_month, p.mi, p.avg_customer_size_score, p.avg_base_churn_probability,
                     m.distributor_order_share, m.churn_risk_customer_share, m.avg_order_units, m.avg_order_revenue
                   FROM t_panel p LEFT JOIN t_mix m ON m.product_id = p.product_id AND m.region_id = p.region_id AND m.year_month = p.year_month)
        SELECT a.product_id, a.region_id, a.year_month, a.distributor_order_share, a.churn_risk_customer_share, a.avg_order_units,
               a.avg_order_revenue, a.avg_base_churn_probability AS avg_customer_churn_probability,
               b.avg_customer_size_score AS avg_customer_size_score_lag_1m,
               b.avg_base_churn_probability AS avg_customer_churn_probability_lag_1m,
               b.distributor_order_share AS distributor_order_share_lag_1m,
               b.churn_risk_customer_share AS churn_risk_customer_share_lag_1m
        FROM s a LEFT JOIN s b ON b.product_id = a.product_id AND b.region_id = a.region_id AND b.mi = a.mi - 1""",
    rounded="""distributor_order_share churn_risk_customer_share avg_order_units avg_order_revenue avg_customer_churn_probability
               avg_customer_size_score_lag_1m avg_customer_churn_probability_lag_1m distributor_order_share_lag_1m
               churn_risk_customer_share_lag_1m""",
)
def customer_mix_features(star):
    return fe.customer_mix_features(panel(star), customer_months(star), DISTRIBUTOR).select(
        *KEYS, "distributor_order_share", "churn_risk_customer_share", "avg_order_units", "avg_order_revenue",
        "avg_customer_churn_probability", *[f"{c}_lag_1m" for c in fe.CUSTOMER_LAGS],
    )


@query(
    "fe16_growths",
    f"""SELECT p.product_id, p.region_id, p.year_month,
               (p.gross_profit_eur - w.gross_profit_eur) / nullif(w.gross_profit_eur, 0) AS gross_profit_growth_pct,
               (p.weighted_pipeline_eur - w.weighted_pipeline_eur) / nullif(w.weighted_pipeline_eur, 0) AS weighted_pipeline_growth_pct,
               (p.return_rate_units - w.return_rate_units) / nullif(w.return_rate_units, 0) AS return_rate_change_pct {_PRIOR}""",
    rounded="gross_profit_growth_pct weighted_pipeline_growth_pct return_rate_change_pct",
)
def growths(star):
    return fe.growths(labelled(star)).select(
        *KEYS, "gross_profit_growth_pct", "weighted_pipeline_growth_pct", "return_rate_change_pct"
    )


@query(
    "fe17_interactions",
    f"""SELECT {_K}, market_demand_index - supply_pressure_index AS demand_supply_gap,
               CASE WHEN market_demand_index IS NULL OR supply_pressure_index IS NULL THEN NULL
                    WHEN market_demand_index >= 110 AND supply_pressure_index >= 65 THEN 1 ELSE 0 END AS demand_supply_mismatch_flag,
               marketing_qualified_leads / nullif(pipeline_opportunities, 0) AS engagement_to_pipeline_ratio,
               weighted_pipeline_eur / nullif(unique_customers, 0) AS pipeline_value_per_customer,
               (marketing_qualified_leads + demo_requests) / nullif(campaign_spend_eur, 0) AS marketing_efficiency_score FROM t_full""",
    rounded="demand_supply_gap engagement_to_pipeline_ratio pipeline_value_per_customer marketing_efficiency_score",
)
def interactions(star):
    return fe.interactions(labelled(star)).select(
        *KEYS, "demand_supply_gap", "demand_supply_mismatch_flag", "engagement_to_pipeline_ratio", "pipeline_value_per_customer",
        "marketing_efficiency_score",
    )


@query(
    "fe18_commercial_pressure", f"SELECT {_K}, commercial_pressure_score, revenue_at_risk_proxy FROM t_pressure",
    rounded="commercial_pressure_score revenue_at_risk_proxy",
)
def commercial_pressure(star):
    scored = fe.market_context(fe.supply_pressure_score(fe.supply_ratios(labelled(star))))
    return fe.commercial_pressure(scored).select(*KEYS, "commercial_pressure_score", "revenue_at_risk_proxy")


@query(
    "fe19_crm_index",
    """SELECT year_month, region_id, n AS crm_activity_count, minutes AS crm_activity_minutes, coalesce(health, 65) AS average_customer_health,
              CAST(round_even(CAST(least(greatest(CASE WHEN m = 0 THEN 100 ELSE 100 * n / m END, 0), 250) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS regional_crm_activity_index
       FROM (SELECT g.year_month, g.region_id, coalesce(c.crm_activity_count, 0) AS n, coalesce(c.crm_activity_minutes, 0) AS minutes,
                    c.avg_customer_health_score AS health,
                    avg(coalesce(c.crm_activity_count, 0)) OVER (PARTITION BY g.year_month) AS m
             FROM (SELECT year_month, region_id FROM t_months CROSS JOIN t_regions) g
             LEFT JOIN t_crm_month c ON c.year_month = g.year_month AND c.region_id = g.region_id)""",
    rounded="average_customer_health regional_crm_activity_index",
)
def crm_index(star):
    return mk.crm_index(star.crm, months(star.bounds), star.regions)


@query(
    "fe20_opportunity_interest_index",
    """SELECT year_month, product_category, region_id, n AS opportunity_count, coalesce(v, 0) AS weighted_pipeline_eur,
              coalesce(w, 0) AS average_win_probability,
              CAST(round_even(CAST(least(greatest(coalesce(100 * n / nullif(m, 0), 0), 0), 300) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS pipeline_interest_index
       FROM (SELECT g.*, coalesce(c.pipeline_opportunities, 0) AS n, c.weighted_pipeline_eur AS v, c.avg_win_probability AS w,
                    avg(coalesce(c.pipeline_opportunities, 0)) OVER (PARTITION BY g.year_month) AS m
             FROM (SELECT year_month, product_category, region_id FROM t_months CROSS JOIN t_regions
                   CROSS JOIN (SELECT DISTINCT product_category FROM t_products)) g
             LEFT JOIN t_opps_month c ON c.year_month = g.year_month AND c.region_id = g.region_id
               AND c.product_category = g.product_category)""",
    rounded="weighted_pipeline_eur average_win_probability pipeline_interest_index",
)
def opportunity_interest_index(star):
    return mk.opportunity_index(star.opportunities, months(star.bounds), star.products, star.regions)


def _grid_inventory(star):
    w = written(star)
    groups = star.products.select("product_id", "product_category")
    grid = mk.group_grid(months(star.bounds), star.products, star.regions)
    return grid, within(w.inventory().join(groups, "product_id"), months(star.bounds)), w.sales.join(groups, "product_id")


_GRID = """(SELECT year_month, product_category, region_id FROM t_months CROSS JOIN t_regions
            CROSS JOIN (SELECT DISTINCT product_category FROM t_products)) g"""


@query(
    "fe21_supply_index",
    f"""SELECT g.year_month, g.product_category, g.region_id, coalesce(r, 0) AS stockout_rate, coalesce(a, 0.5) AS average_available_stock_ratio,
               CAST(r IS NOT NULL AS INTEGER) AS inventory_observed_flag,
               CAST(round_even(CAST(least(greatest(25 + 65 * coalesce(r, 0) + 35 * (1 - coalesce(a, 0.5)), 5), 100) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS supply_pressure_index
        FROM {_GRID} LEFT JOIN (
          SELECT year_month, product_category, region_id, avg(CAST(stockout AS INTEGER)) AS r,
                 avg(ending_stock_units / nullif(opening_stock_units + production_units, 0)) AS a
          FROM t_inventory JOIN (SELECT product_id, product_category FROM t_products) USING (product_id) GROUP BY 1, 2, 3) i
        USING (year_month, product_category, region_id)""",
    rounded="stockout_rate average_available_stock_ratio supply_pressure_index",
)
def supply_index(star):
    grid, inventory, _ = _grid_inventory(star)
    return mk.supply_index(inventory, grid)


@query(
    "fe22_momentum_index",
    f"""WITH d AS (SELECT g.year_month, year(g.year_month) * 12 + month(g.year_month) AS mi, g.product_category, g.region_id,
                          coalesce(u, 0) AS observed_units
                   FROM {_GRID} LEFT JOIN (SELECT year_month, product_category, region_id, sum(units) AS u FROM t_sales
                     JOIN (SELECT product_id, product_category FROM t_products) USING (product_id) GROUP BY 1, 2, 3) s
                   USING (year_month, product_category, region_id))
        SELECT a.year_month, a.product_category, a.region_id, a.observed_units,
               max(b.observed_units) FILTER (b.mi = a.mi - 1) AS units_lag_1m,
               CASE WHEN count(*) FILTER (b.mi <= a.mi - 2) >= 2 THEN avg(b.observed_units) FILTER (b.mi <= a.mi - 2) END AS prior_units_baseline_6m,
               least(greatest(coalesce(100 * max(b.observed_units) FILTER (b.mi = a.mi - 1) / nullif(CASE WHEN
                 count(*) FILTER (b.mi <= a.mi - 2) >= 2 THEN avg(b.observed_units) FILTER (b.mi <= a.mi - 2) END, 0), 100), 0), 250)
                 AS historical_sales_momentum_index
        FROM d a LEFT JOIN d b ON b.product_category = a.product_category AND b.region_id = a.region_id AND b.mi BETWEEN a.mi - 7 AND a.mi - 1
        GROUP BY a.year_month, a.mi, a.product_category, a.region_id, a.observed_units""",
    rounded="observed_units units_lag_1m prior_units_baseline_6m historical_sales_momentum_index",
)
def momentum_index(star):
    grid, _, sales = _grid_inventory(star)
    return mk.momentum_index(sales, grid)


@query(
    "fe23_seasonality_index",
    """SELECT o_orderkey, CASE WHEN month(o_orderdate) > 9 THEN 130 WHEN month(o_orderdate) IN (7, 8) THEN 82 ELSE 100 END AS seasonality_index
       FROM orders""",
    rounded="seasonality_index",
)
def seasonality_index(star):
    return star.table("orders").select("o_orderkey", mk.seasonality_index(F.month("o_orderdate")).alias("seasonality_index"))


@query(
    "fe24_opportunity_score",
    "SELECT year_month, product_line, product_category, region_id, market_opportunity_score FROM t_signals",
    rounded="market_opportunity_score",
)
def opportunity_score(star):
    signals = written(star).market_signals().drop("market_opportunity_score")
    return signals.select(
        "year_month", "product_line", "product_category", "region_id", mk.opportunity_score().alias("market_opportunity_score")
    )


@query(
    "fe25_compatible_columns",
    f"""SELECT product_id, strftime(year_month, '%Y-%m') AS year_month, {', '.join(fe.BASE_COLUMNS[2:])} FROM t_labelled""",
    rounded="""units_sold revenue avg_discount_pct units_lag_1m units_lag_3m revenue_lag_1m rolling_units_mean_3m rolling_units_mean_6m
               rolling_units_std_3m volatility_3m mom_units_growth_pct customer_count_growth_pct trend_slope_3m trend_slope_6m
               backorder_units market_demand_index competitor_pressure_index website_visits demo_requests""",
)
def compatible_columns(star):
    compatible, _ = fe.output_contracts(labelled(star))
    return compatible


@query("fe25_enriched_columns")
def enriched_columns(star):
    _, enriched = fe.output_contracts(features(star))
    return enriched


@query(
    "fe26_launch_issue",
    """SELECT p.product_id, launch_date AS launch_month, first_sales_month, least(launch_date, first_sales_month) AS effective_launch_month,
              CAST(coalesce(first_sales_month < launch_date, FALSE) AS INTEGER) AS launch_date_issue_flag,
              CASE WHEN first_sales_month < launch_date THEN CAST(date_diff('month', first_sales_month, launch_date) AS INTEGER) ELSE 0 END
                AS launch_month_gap
       FROM t_products p LEFT JOIN (SELECT product_id, min(year_month) AS first_sales_month FROM t_sales GROUP BY 1) s USING (product_id)""",
)
def launch_issues(star):
    return launch_issue(star.products, written(star).sales).select(
        "product_id", "launch_month", "first_sales_month", "effective_launch_month", "launch_date_issue_flag", "launch_month_gap"
    )
