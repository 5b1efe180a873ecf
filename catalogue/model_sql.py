"""The sales model written independently in SQL, as named common table expressions.

Histories are self-joins on a month number instead of window functions.
"""

from __future__ import annotations

import re

_MODE = "first(v ORDER BY n DESC, v)"

CTES: dict[str, str] = {}

CTES["t_products"] = """
SELECT product_id, b, 'Line ' || (b % 2) AS product_line, 'Category ' || (b % 5) AS product_category,
       'SKU-' || b AS sku,
       CASE b % 4 WHEN 0 THEN 'New' WHEN 1 THEN 'Growth' WHEN 2 THEN 'Mature' ELSE 'Decline' END AS lifecycle_stage,
       make_date(1995 + b % 4, 1, 1) AS launch_date,
       list_price AS base_list_price_eur, list_price * 0.5 AS base_unit_cost_eur,
       (b % 5 * 2 + 25) / 100.0 AS target_margin_pct, (b + 90) / 100.0 AS product_growth_factor,
       CASE WHEN b % 4 = 3 THEN 1 ELSE 0 END AS is_declining_product,
       CASE WHEN b % 4 = 0 THEN 1 ELSE 0 END AS is_new_product
FROM (SELECT p_brand AS product_id, CAST(substr(p_brand, 7) AS INTEGER) AS b, min(p_retailprice) AS list_price
      FROM part GROUP BY 1, 2)
"""

CTES["t_regions"] = """
SELECT r_regionkey AS region_id, r_name AS region,
       CASE WHEN r_regionkey % 2 = 0 THEN 'EUR' ELSE 'USD' END AS currency,
       CASE WHEN r_regionkey % 2 = 0 THEN 1.0 ELSE 0.9 END::DOUBLE AS fx_to_eur,
       1 + r_regionkey / 20.0 AS market_growth_factor, 1 - r_regionkey / 50.0 AS margin_factor
FROM region
"""

CTES["t_customers"] = """
SELECT c_custkey AS customer_id, c_mktsegment AS customer_segment, n_regionkey AS region_id,
       make_date(CAST(1995 + c_custkey % 3 AS INTEGER), CAST(1 + c_custkey % 12 AS INTEGER), 1) AS customer_since,
       c_acctbal AS customer_size_score, (c_custkey % 20) / 100.0 AS base_churn_probability,
       CASE WHEN c_custkey % 20 >= 12 THEN 'High Churn Risk' WHEN c_custkey % 20 >= 7 THEN 'Medium Churn Risk'
            ELSE 'Low Churn Risk' END AS churn_risk_band
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
"""

CTES["t_reps"] = """
SELECT s_suppkey AS sales_rep_id, n_regionkey AS region_id,
       CASE s_suppkey % 3 WHEN 0 THEN 'Junior' WHEN 1 THEN 'Professional' ELSE 'Senior' END AS seniority,
       s_acctbal AS annual_quota_eur
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
"""

CTES["t_lines"] = """
SELECT l.*, p_brand AS product_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, c.region_id,
       c.customer_segment, c.churn_risk_band, c.customer_size_score, c.base_churn_probability
FROM lineitem l
JOIN orders ON l_orderkey = o_orderkey
JOIN t_customers c ON o_custkey = c.customer_id
JOIN part ON l_partkey = p_partkey
"""

CTES["t_sales"] = """
SELECT *, revenue_eur - gross_profit_eur AS cogs_eur, revenue_eur * discount_pct AS discount_value_eur,
       revenue_eur AS revenue, units AS units_sold, discount_pct AS avg_discount_pct,
       CASE WHEN gross_margin_pct >= 0.40 THEN 'High Margin' WHEN gross_margin_pct >= 0.25 THEN 'Medium Margin'
            ELSE 'Low Margin' END AS margin_category,
       CASE WHEN units >= 100 THEN 'Large Order' WHEN units >= 25 THEN 'Medium Order'
            ELSE 'Small Order' END AS order_size_category,
       CASE WHEN sales_rep_id IS NULL THEN 1 ELSE 0 END AS missing_sales_rep_flag,
       CASE WHEN discount_pct IS NULL THEN 1 ELSE 0 END AS missing_discount_flag,
       CASE WHEN gross_margin_pct IS NULL THEN 1 ELSE 0 END AS missing_margin_flag
FROM (
  SELECT l_orderkey AS transaction_id, order_date, CAST(date_trunc('month', order_date) AS DATE) AS year_month,
         customer_id, product_id, s.region_id,
         CASE WHEN l_suppkey % 17 = 0 THEN NULL ELSE l_suppkey END AS sales_rep_id,
         l_quantity AS units, l_extendedprice / l_quantity AS asp_eur,
         CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_discount END AS discount_pct,
         l_extendedprice * (1 - l_discount) AS revenue_eur,
         l_extendedprice * 0.7 / l_quantity AS unit_cost_eur,
         l_extendedprice * (1 - l_discount) - l_extendedprice * 0.7 AS gross_profit_eur,
         (l_extendedprice * (1 - l_discount) - l_extendedprice * 0.7)
           / (l_extendedprice * (1 - l_discount)) AS gross_margin_pct,
         l_quantity >= 48 AS is_outlier_order,
         customer_segment, churn_risk_band, customer_size_score, base_churn_probability,
         CASE WHEN l_suppkey % 17 = 0 THEN 'Unknown' ELSE coalesce(r.seniority, 'Unknown') END AS seniority
  FROM t_lines s LEFT JOIN t_reps r ON l_suppkey = r.sales_rep_id)
"""

CTES["t_months"] = """
SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                   INTERVAL 1 MONTH)) AS DATE) AS year_month FROM orders
"""

CTES["t_modes"] = f"""
SELECT product_id, region_id, year_month,
       {_MODE} FILTER (k = 1) AS dominant_margin_category,
       {_MODE} FILTER (k = 2) AS dominant_order_size_category,
       {_MODE} FILTER (k = 3) AS dominant_rep_seniority
FROM (SELECT product_id, region_id, year_month, k, v, count(*) AS n
      FROM (SELECT product_id, region_id, year_month, 1 AS k, margin_category AS v FROM t_sales
            UNION ALL SELECT product_id, region_id, year_month, 2, order_size_category FROM t_sales
            UNION ALL SELECT product_id, region_id, year_month, 3, seniority FROM t_sales)
      GROUP BY ALL)
GROUP BY product_id, region_id, year_month
"""

CTES["t_monthly"] = """
SELECT a.*, dominant_margin_category, dominant_order_size_category, dominant_rep_seniority
FROM (
  SELECT product_id, region_id, year_month, sum(units) AS units_sold, sum(revenue) AS revenue,
         count(DISTINCT customer_id) AS unique_customers, avg(discount_pct) AS avg_discount_pct,
         count(DISTINCT transaction_id) AS order_count, count(DISTINCT sales_rep_id) AS active_sales_reps,
         avg(asp_eur) AS avg_asp_eur, sum(gross_profit_eur) AS gross_profit_eur, sum(cogs_eur) AS cogs_eur,
         sum(discount_value_eur) AS discount_value_eur,
         CAST(sum(CAST(is_outlier_order AS INTEGER)) AS BIGINT) AS outlier_order_count,
         CAST(sum(missing_sales_rep_flag) AS BIGINT) AS missing_sales_rep_count,
         CAST(sum(missing_discount_flag) AS BIGINT) AS missing_discount_count,
         CAST(sum(missing_margin_flag) AS BIGINT) AS missing_margin_count,
         sum(gross_profit_eur) / nullif(sum(revenue), 0) AS gross_margin_pct
  FROM t_sales GROUP BY 1, 2, 3) a
JOIN t_modes USING (product_id, region_id, year_month)
"""

CTES["t_customer_month"] = """
SELECT product_id, region_id, year_month, avg(customer_size_score) AS avg_customer_size_score,
       avg(base_churn_probability) AS avg_base_churn_probability,
       count(*) FILTER (customer_segment = 'BUILDING') AS enterprise_customer_count,
       count(*) FILTER (churn_risk_band LIKE '%High%') AS high_churn_customer_count
FROM (SELECT DISTINCT product_id, region_id, year_month, customer_id FROM t_sales) JOIN
     (SELECT * EXCLUDE (region_id) FROM t_customers) USING (customer_id)
GROUP BY 1, 2, 3
"""

CTES["t_quota"] = """
SELECT product_id, region_id, year_month, sum(annual_quota_eur) AS covered_annual_quota_eur
FROM (SELECT DISTINCT product_id, region_id, year_month, sales_rep_id FROM t_sales WHERE sales_rep_id IS NOT NULL)
JOIN (SELECT sales_rep_id, annual_quota_eur FROM t_reps) USING (sales_rep_id)
GROUP BY 1, 2, 3
"""

CTES["t_starts"] = """
SELECT product_id, min(order_date) AS observed_first_sale_date,
       least(min(order_date), any_value(launch_date)) AS effective_launch_date
FROM t_sales JOIN (SELECT product_id, launch_date FROM t_products) USING (product_id) GROUP BY 1
"""

CTES["t_panel"] = """
SELECT p.product_id, g.region_id, m.year_month, year(m.year_month) * 12 + month(m.year_month) AS mi,
       g.region, p.b, p.product_line, p.product_category, p.sku, p.lifecycle_stage, p.launch_date,
       p.base_list_price_eur, p.base_unit_cost_eur, p.target_margin_pct, p.product_growth_factor,
       s.observed_first_sale_date, coalesce(s.effective_launch_date, p.launch_date) AS effective_launch_date,
       coalesce(a.units_sold, 0) AS units_sold, coalesce(a.revenue, 0) AS revenue,
       coalesce(a.unique_customers, 0) AS unique_customers, a.avg_discount_pct,
       coalesce(a.order_count, 0) AS order_count, coalesce(a.active_sales_reps, 0) AS active_sales_reps,
       a.avg_asp_eur, coalesce(a.gross_profit_eur, 0) AS gross_profit_eur, coalesce(a.cogs_eur, 0) AS cogs_eur,
       coalesce(a.discount_value_eur, 0) AS discount_value_eur,
       coalesce(a.outlier_order_count, 0) AS outlier_order_count,
       coalesce(a.missing_sales_rep_count, 0) AS missing_sales_rep_count,
       coalesce(a.missing_discount_count, 0) AS missing_discount_count,
       coalesce(a.missing_margin_count, 0) AS missing_margin_count, a.gross_margin_pct,
       a.dominant_margin_category, a.dominant_order_size_category, a.dominant_rep_seniority,
       c.avg_customer_size_score, c.avg_base_churn_probability,
       coalesce(c.enterprise_customer_count, 0) AS enterprise_customer_count,
       coalesce(c.high_churn_customer_count, 0) AS high_churn_customer_count,
       coalesce(q.covered_annual_quota_eur, 0) AS covered_annual_quota_eur,
       CASE WHEN coalesce(a.units_sold, 0) = 0 THEN 1 ELSE 0 END AS no_sales_flag
FROM t_products p CROSS JOIN t_regions g CROSS JOIN t_months m
LEFT JOIN t_starts s ON s.product_id = p.product_id
LEFT JOIN t_monthly a ON a.product_id = p.product_id AND a.region_id = g.region_id AND a.year_month = m.year_month
LEFT JOIN t_customer_month c ON c.product_id = p.product_id AND c.region_id = g.region_id AND c.year_month = m.year_month
LEFT JOIN t_quota q ON q.product_id = p.product_id AND q.region_id = g.region_id AND q.year_month = m.year_month
WHERE m.year_month >= date_trunc('month', coalesce(s.effective_launch_date, p.launch_date))
"""

CTES["t_base"] = """
SELECT product_id, region_id, year_month, year(year_month) * 12 + month(year_month) AS mi,
       CAST(substr(product_id, 7) AS INTEGER) AS b, sum(units) AS units, count(DISTINCT transaction_id) AS orders,
       round(sum(cogs_eur), 4) AS cogs
FROM t_sales GROUP BY 1, 2, 3
"""

CTES["t_inventory"] = """
SELECT product_id, region_id, year_month, opening_stock_units, production_units,
       greatest(0, opening_stock_units + production_units - units) AS ending_stock_units,
       greatest(0, opening_stock_units + production_units - units) < units * 0.12 AS stockout,
       CASE WHEN greatest(0, opening_stock_units + production_units - units) < units * 0.12 THEN 1 ELSE 0 END AS stockout_flag,
       CASE WHEN greatest(0, opening_stock_units + production_units - units) <= 0 THEN 1 ELSE 0 END AS zero_stock_flag,
       greatest(0, opening_stock_units + production_units - units) * 10 AS inventory_value_eur
FROM (SELECT *, floor(units * 0.6 + (b * 31 + region_id * 7 + mi) % 40) AS opening_stock_units,
             floor(units * 0.5) AS production_units FROM t_base)
"""

CTES["t_costs"] = """
SELECT product_id, year_month, actual_unit_cost_eur, base_unit_cost_eur AS standard_unit_cost_eur,
       actual_unit_cost_eur - base_unit_cost_eur AS cost_variance_eur,
       (actual_unit_cost_eur - base_unit_cost_eur) / nullif(base_unit_cost_eur, 0) AS cost_variance_pct
FROM (SELECT product_id, year_month, round(sum(cogs), 4) / nullif(sum(units), 0) AS actual_unit_cost_eur
      FROM t_base GROUP BY 1, 2) JOIN (SELECT product_id, base_unit_cost_eur FROM t_products) USING (product_id)
"""

CTES["t_returns"] = """
SELECT product_id, region_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS year_month,
       sum(l_quantity) AS return_units, sum(l_extendedprice * (1 - l_discount)) AS return_value_eur,
       count(DISTINCT l_orderkey) AS return_count
FROM t_lines WHERE l_returnflag = 'R' GROUP BY 1, 2, 3
"""

CTES["t_order_activity"] = """
SELECT o_orderkey AS k, o_orderstatus, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS day,
       CAST(date_trunc('month', o_orderdate) AS DATE) AS year_month,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS customer_id, o_orderkey % 10 AS sales_rep_id,
       coalesce(c.region_id, r.region_id) AS region_id
FROM orders
LEFT JOIN t_customers c ON c.customer_id = CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END
LEFT JOIN t_reps r ON r.sales_rep_id = o_orderkey % 10
"""

CTES["t_opps"] = """
SELECT *, expected_value_eur * prob AS weighted_pipeline_eur, expected_value_eur * prob / expected_value_eur AS win_probability,
       CASE WHEN stage = 'Closed Won' THEN 1 ELSE 0 END AS is_closed_won,
       CASE WHEN stage = 'Closed Lost' THEN 1 ELSE 0 END AS is_closed_lost,
       date_diff('day', day, expected_close_date) AS days_to_close
FROM (SELECT *, CASE stage WHEN 'Lead' THEN 0.10 WHEN 'Qualified' THEN 0.25 WHEN 'Proposal' THEN 0.45
                           WHEN 'Negotiation' THEN 0.65 WHEN 'Closed Won' THEN 1.00 ELSE 0.00 END::DOUBLE AS prob
      FROM (SELECT k AS opportunity_id, day, year_month, customer_id, sales_rep_id, region_id,
                   'Category ' || (k % 5) AS product_category, o_totalprice AS expected_value_eur,
                   day + CAST(k % 200 + 20 AS INTEGER) AS expected_close_date,
                   CASE WHEN o_orderstatus = 'F' THEN 'Closed Won' WHEN o_orderstatus = 'P' THEN 'Closed Lost'
                        WHEN k % 4 = 0 THEN 'Lead' WHEN k % 4 = 1 THEN 'Qualified' WHEN k % 4 = 2 THEN 'Proposal'
                        ELSE 'Negotiation' END AS stage
            FROM t_order_activity))
"""

CTES["t_opps_month"] = """
SELECT year_month, region_id, product_category, count(DISTINCT opportunity_id) AS pipeline_opportunities,
       sum(weighted_pipeline_eur) AS weighted_pipeline_eur, sum(expected_value_eur) AS expected_pipeline_eur,
       avg(win_probability) AS avg_win_probability, avg(days_to_close) AS avg_days_to_close,
       CAST(sum(is_closed_won) AS BIGINT) AS closed_won_count, CAST(sum(is_closed_lost) AS BIGINT) AS closed_lost_count,
       CAST(sum(is_closed_won) AS DOUBLE) / nullif(sum(is_closed_won) + sum(is_closed_lost), 0) AS pipeline_conversion_rate
FROM t_opps WHERE region_id IS NOT NULL GROUP BY 1, 2, 3
"""

CTES["t_crm"] = """
SELECT k AS activity_id, day AS activity_date, year_month, customer_id, sales_rep_id, region_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Product Demo' WHEN '2-HIGH' THEN 'Site Visit'
            WHEN '3-MEDIUM' THEN 'Email' WHEN '4-NOT SPECIFIED' THEN 'Call' WHEN '5-LOW' THEN 'Meeting' END AS activity_type,
       k % 50 + 10 AS activity_minutes, (k % 201 - 100) / 100.0 AS sentiment_score,
       CAST(k % 101 AS DOUBLE) AS customer_health_score
FROM t_order_activity
"""

CTES["t_crm_month"] = """
SELECT year_month, region_id, count(DISTINCT activity_id) AS crm_activity_count,
       CAST(sum(activity_minutes) AS BIGINT) AS crm_activity_minutes,
       count(*) FILTER (activity_type IN ('Product Demo', 'Site Visit', 'Meeting')) AS crm_demo_like_count,
       avg(sentiment_score) AS avg_sentiment_score, avg(customer_health_score) AS avg_customer_health_score
FROM t_crm WHERE region_id IS NOT NULL GROUP BY 1, 2
"""

CTES["t_activity"] = """
SELECT product_id, region_id, year_month, c AS campaign_flag,
       CASE WHEN c = 0 THEN 'No campaign' WHEN (b + region_id) % 3 = 0 THEN 'Search'
            WHEN (b + region_id) % 3 = 1 THEN 'Social' ELSE 'Email' END AS campaign_channel,
       c * (units * 1.5 + 10) AS campaign_spend_eur, c * units * 20 AS campaign_impressions, c * units AS campaign_clicks,
       units * 3 + orders AS website_visits, units * 6 + orders * 2 AS product_page_views,
       floor(units / 10) AS demo_requests, floor(units / 10) + orders AS marketing_qualified_leads,
       CAST(orders * 25 AS DOUBLE) AS regional_crm_activity_index,
       CAST(orders * 10 AS DOUBLE) AS activity_pipeline_interest_index,
       coalesce(c * units / nullif(c * units * 20, 0) * 100, 0) AS campaign_ctr_pct,
       c * (units * 1.5 + 10) / nullif(floor(units / 10) + orders, 0) AS cost_per_lead_eur,
       1 AS market_activity_available_flag
FROM (SELECT *, CASE WHEN (b + region_id * 2 + mi) % 3 = 0 THEN 1 ELSE 0 END AS c FROM t_base)
"""

CTES["t_signals"] = """
SELECT *, greatest(0, least(100, market_demand_index * 0.40 + (100 - competitor_pressure_index) * 0.22
         + (100 - supply_pressure_index) * 0.15 + least(market_pipeline_interest_index, 100) * 0.23)) AS market_opportunity_score,
       1 AS market_signal_available_flag
FROM (SELECT year_month, product_line, product_category, region_id,
             CAST(u % 90 + 60 AS DOUBLE) AS market_demand_index, (u % 41 - 20) / 10.0 AS market_growth_pct,
             CAST(u * 7 % 60 + 30 AS DOUBLE) AS competitor_pressure_index,
             CASE WHEN month(year_month) >= 10 THEN 130.0 WHEN month(year_month) IN (7, 8) THEN 82.0 ELSE 100.0 END::DOUBLE
               AS seasonality_index,
             CAST((year(year_month) * 12 + month(year_month)) % 21 + 90 AS DOUBLE) AS macro_business_index,
             CAST(u * 3 % 75 + 20 AS DOUBLE) AS supply_pressure_index,
             CAST(u * 11 % 150 AS DOUBLE) AS market_pipeline_interest_index,
             CASE WHEN u % 29 = 0 THEN 1 ELSE 0 END AS demand_shock_flag,
             1 + region_id / 20.0 AS regional_market_growth_factor
      FROM (SELECT year_month, product_line, product_category, region_id, CAST(sum(units) AS BIGINT) AS u
            FROM t_base JOIN (SELECT product_id, product_line, product_category FROM t_products) USING (product_id)
            GROUP BY 1, 2, 3, 4))
"""

CTES["t_full"] = """
SELECT p.*, i.opening_stock_units, i.production_units, i.ending_stock_units, i.inventory_value_eur,
       coalesce(i.stockout_flag, 0) AS stockout_flag, coalesce(i.zero_stock_flag, 0) AS zero_stock_flag,
       CASE WHEN i.opening_stock_units IS NULL THEN 0 ELSE 1 END AS inventory_available_flag,
       CASE WHEN i.opening_stock_units IS NULL THEN 0
            ELSE greatest(p.units_sold - (i.opening_stock_units + i.production_units), 0) END::DOUBLE AS backorder_units,
       (coalesce(i.opening_stock_units, 0) + coalesce(i.production_units, 0)) / nullif(p.units_sold, 0) AS supply_coverage_ratio,
       k.standard_unit_cost_eur, k.actual_unit_cost_eur, k.cost_variance_eur, k.cost_variance_pct,
       coalesce(t.return_units, 0) AS return_units, coalesce(t.return_value_eur, 0) AS return_value_eur,
       coalesce(t.return_count, 0) AS return_count, coalesce(t.return_units, 0) / nullif(p.units_sold, 0) AS return_rate_units,
       a.* EXCLUDE (product_id, region_id, year_month, market_activity_available_flag),
       coalesce(a.market_activity_available_flag, 0) AS market_activity_available_flag,
       coalesce(c.crm_activity_count, 0) AS crm_activity_count, coalesce(c.crm_activity_minutes, 0) AS crm_activity_minutes,
       coalesce(c.crm_demo_like_count, 0) AS crm_demo_like_count, c.avg_sentiment_score, c.avg_customer_health_score,
       coalesce(o.pipeline_opportunities, 0) AS pipeline_opportunities,
       coalesce(o.weighted_pipeline_eur, 0) AS weighted_pipeline_eur,
       coalesce(o.expected_pipeline_eur, 0) AS expected_pipeline_eur, o.avg_win_probability, o.avg_days_to_close,
       coalesce(o.closed_won_count, 0) AS closed_won_count, coalesce(o.closed_lost_count, 0) AS closed_lost_count,
       o.pipeline_conversion_rate,
       g.* EXCLUDE (year_month, product_line, product_category, region_id, market_signal_available_flag),
       coalesce(g.market_signal_available_flag, 0) AS market_signal_available_flag
FROM t_panel p
LEFT JOIN t_inventory i ON i.product_id = p.product_id AND i.region_id = p.region_id AND i.year_month = p.year_month
LEFT JOIN t_costs k ON k.product_id = p.product_id AND k.year_month = p.year_month
LEFT JOIN t_returns t ON t.product_id = p.product_id AND t.region_id = p.region_id AND t.year_month = p.year_month
LEFT JOIN t_activity a ON a.product_id = p.product_id AND a.region_id = p.region_id AND a.year_month = p.year_month
LEFT JOIN t_crm_month c ON c.year_month = p.year_month AND c.region_id = p.region_id
LEFT JOIN t_opps_month o ON o.year_month = p.year_month AND o.region_id = p.region_id AND o.product_category = p.product_category
LEFT JOIN t_signals g ON g.year_month = p.year_month AND g.product_line = p.product_line
     AND g.product_category = p.product_category AND g.region_id = p.region_id
"""

CTES["t_hist"] = """
SELECT p.product_id, p.region_id, p.year_month,
       max(w.units_sold) FILTER (w.mi = p.mi - 1) AS units_lag_1m,
       max(w.units_sold) FILTER (w.mi = p.mi - 3) AS units_lag_3m,
       max(w.revenue) FILTER (w.mi = p.mi - 1) AS revenue_lag_1m,
       max(w.unique_customers) FILTER (w.mi = p.mi - 1) AS customers_lag_1m,
       CASE WHEN count(w.units_sold) FILTER (w.mi >= p.mi - 3) >= 2
            THEN avg(w.units_sold) FILTER (w.mi >= p.mi - 3) END AS rolling_units_mean_3m,
       CASE WHEN count(w.units_sold) >= 3 THEN avg(w.units_sold) END AS rolling_units_mean_6m,
       CASE WHEN count(w.units_sold) FILTER (w.mi >= p.mi - 3) >= 2
            THEN stddev_samp(w.units_sold) FILTER (w.mi >= p.mi - 3) END AS rolling_units_std_3m,
       CASE WHEN count(w.units_sold) >= 3 THEN stddev_samp(w.units_sold) END AS rolling_units_std_6m,
       CASE WHEN count(w.units_sold) FILTER (w.mi >= p.mi - 3) = 3
            THEN regr_slope(w.units_sold, w.mi) FILTER (w.mi >= p.mi - 3) END AS trend_slope_3m,
       CASE WHEN count(w.units_sold) = 6 THEN regr_slope(w.units_sold, w.mi) END AS trend_slope_6m,
       CASE WHEN count(w.revenue) FILTER (w.mi >= p.mi - 3) >= 2
            THEN avg(w.revenue) FILTER (w.mi >= p.mi - 3) END AS rolling_revenue_mean_3m,
       CASE WHEN count(w.revenue) FILTER (w.mi >= p.mi - 3) >= 2
            THEN stddev_samp(w.revenue) FILTER (w.mi >= p.mi - 3) END AS rolling_revenue_std_3m
FROM t_panel p LEFT JOIN t_panel w
  ON w.product_id = p.product_id AND w.region_id = p.region_id AND w.mi BETWEEN p.mi - 6 AND p.mi - 1
GROUP BY p.product_id, p.region_id, p.year_month, p.mi
"""

CTES["t_flags"] = """
SELECT *, CASE WHEN mom_units_growth_pct < -0.25 THEN 1 ELSE 0 END AS risk_factor_sales_drop,
       CASE WHEN customer_count_growth_pct < -0.25 THEN 1 ELSE 0 END AS risk_factor_customer_drop,
       CASE WHEN round(volatility_3m, 9) > 0.45 THEN 1 ELSE 0 END AS risk_factor_volatility,
       CASE WHEN units_sold < round(e * 0.75, 9) AND e > 0 THEN 1 ELSE 0 END AS risk_factor_under_trend
FROM (SELECT f.*, h.* EXCLUDE (product_id, region_id, year_month),
             rolling_units_std_3m / nullif(rolling_units_mean_3m, 0) AS volatility_3m,
             (units_sold - units_lag_1m) / nullif(units_lag_1m, 0) AS mom_units_growth_pct,
             (unique_customers - customers_lag_1m) / nullif(customers_lag_1m, 0) AS customer_count_growth_pct,
             rolling_units_mean_3m + coalesce(trend_slope_3m, 0) AS e
      FROM t_full f JOIN t_hist h USING (product_id, region_id, year_month))
"""

CTES["t_labelled"] = """
SELECT *, CASE WHEN last_row THEN NULL WHEN target_risk_score >= 3 THEN 2 WHEN target_risk_score >= 1 THEN 1 ELSE 0 END
         AS next_month_risk_label,
       CAST(year_month + INTERVAL 1 MONTH AS DATE) AS target_month
FROM (SELECT *, future_sales_drop_trigger + future_customer_drop_trigger + future_volatility_trigger
              + future_under_trend_trigger + future_stockout_trigger AS target_risk_score
      FROM (SELECT f.*, n.units_sold AS future_units, n.mi IS NULL AS last_row,
                   CASE WHEN n.units_sold < f.units_sold * 0.75 THEN 1 ELSE 0 END AS future_sales_drop_trigger,
                   CASE WHEN n.unique_customers < f.unique_customers * 0.75 THEN 1 ELSE 0 END AS future_customer_drop_trigger,
                   CASE WHEN round(n.volatility_3m, 9) > 0.50 THEN 1 ELSE 0 END AS future_volatility_trigger,
                   CASE WHEN n.units_sold < round(n.e * 0.72, 9) AND n.e > 0 THEN 1 ELSE 0 END AS future_under_trend_trigger,
                   coalesce(n.stockout_flag, 0) AS future_stockout_trigger
            FROM t_flags f LEFT JOIN t_flags n
              ON n.product_id = f.product_id AND n.region_id = f.region_id AND n.mi = f.mi + 1))
"""

CTES["t_cpm"] = """
SELECT year_month, customer_id, product_id, region_id, sum(units) AS units_sold, sum(revenue) AS revenue,
       count(DISTINCT transaction_id) AS order_count, avg(discount_pct) AS avg_discount_pct,
       sum(gross_profit_eur) AS gross_profit_eur, mode(customer_segment) AS customer_segment,
       mode(churn_risk_band) AS churn_risk_band
FROM t_sales GROUP BY 1, 2, 3, 4
"""

CTES["t_mix"] = """
SELECT product_id, region_id, year_month,
       avg(CASE WHEN customer_segment = 'MACHINERY' THEN 1.0 ELSE 0.0 END) AS distributor_order_share,
       avg(CASE WHEN churn_risk_band LIKE '%High%' THEN 1.0 ELSE 0.0 END) AS churn_risk_customer_share,
       sum(units_sold) / nullif(sum(order_count), 0) AS avg_order_units,
       sum(revenue) / nullif(sum(order_count), 0) AS avg_order_revenue
FROM t_cpm GROUP BY 1, 2, 3
"""

CTES["t_scored"] = """
SELECT *, least(100, greatest(0, stockout_flag * 35.0 + zero_stock_flag * 25.0
              + least(greatest(coalesce(backorder_rate, 0), 0), 1) * 20
              + least(greatest(coalesce(supply_pressure_index, 50), 0), 100) / 100 * 20))::DOUBLE AS supply_pressure_score,
       CASE WHEN competitor_pressure_index IS NULL THEN NULL WHEN competitor_pressure_index >= 70 THEN 1 ELSE 0 END
         AS high_competition_flag,
       CASE WHEN market_demand_index IS NULL THEN NULL WHEN market_demand_index < 90 THEN 1 ELSE 0 END AS weak_market_flag
FROM (SELECT *, backorder_units / nullif(units_sold, 0) AS backorder_rate FROM t_labelled)
"""

CTES["t_pressure"] = """
SELECT *, revenue * commercial_pressure_score / 100 AS revenue_at_risk_proxy
FROM (SELECT *, least(100, greatest(0, risk_factor_sales_drop * 20.0 + risk_factor_customer_drop * 15.0
              + risk_factor_under_trend * 15.0 + coalesce(high_competition_flag, 0) * 15.0
              + coalesce(weak_market_flag, 0) * 15.0 + supply_pressure_score * 0.20))::DOUBLE AS commercial_pressure_score
      FROM t_scored)
"""

# Rule-based class probabilities: a deterministic stand-in for a fitted model.
CTES["t_pred"] = """
SELECT *, CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS predicted_label
FROM (SELECT product_id, region_id, year_month, target_month, next_month_risk_label AS actual_label,
             revenue_at_risk_proxy, revenue, units_sold,
             p2, (100 - s2) * (20 + s2 % 60) / 10000.0 AS p1, 1 - p2 - (100 - s2) * (20 + s2 % 60) / 10000.0 AS p0
      FROM (SELECT *, s2 / 100.0 AS p2
            FROM (SELECT *, CAST(least(100, floor(round(commercial_pressure_score * 1.1, 6))) AS INTEGER) AS s2 FROM t_pressure)))
"""

CTES["t_split"] = """
SELECT l.*, CASE WHEN next_month_risk_label IS NULL THEN 'scoring'
                 WHEN pos <= greatest(1, CAST(floor(n * 0.70) AS BIGINT)) THEN 'train'
                 WHEN pos <= greatest(1, CAST(floor(n * 0.70) AS BIGINT)) + greatest(1, CAST(floor(n * 0.15) AS BIGINT))
                 THEN 'validation' ELSE 'test' END AS split
FROM t_pressure l LEFT JOIN (
  SELECT m.target_month, (SELECT count(DISTINCT target_month) FROM t_pressure e
                          WHERE e.next_month_risk_label IS NOT NULL AND e.target_month <= m.target_month) AS pos,
         (SELECT count(DISTINCT target_month) FROM t_pressure e WHERE e.next_month_risk_label IS NOT NULL) AS n
  FROM (SELECT DISTINCT target_month FROM t_pressure WHERE next_month_risk_label IS NOT NULL) m) USING (target_month)
"""

# Numeric features of the closed-form learning queries: all that the SQL model has. The
# remaining features of the table are derived from these.
NUMERIC = tuple(
    """
    base_list_price_eur base_unit_cost_eur target_margin_pct product_growth_factor
    units_sold revenue unique_customers avg_discount_pct order_count active_sales_reps avg_asp_eur gross_profit_eur cogs_eur
    discount_value_eur outlier_order_count gross_margin_pct avg_customer_size_score avg_base_churn_probability
    enterprise_customer_count high_churn_customer_count covered_annual_quota_eur no_sales_flag
    opening_stock_units production_units ending_stock_units inventory_value_eur stockout_flag zero_stock_flag backorder_units
    supply_coverage_ratio standard_unit_cost_eur actual_unit_cost_eur cost_variance_eur cost_variance_pct
    return_units return_value_eur return_count return_rate_units
    campaign_flag campaign_spend_eur campaign_impressions campaign_clicks website_visits product_page_views demo_requests
    marketing_qualified_leads regional_crm_activity_index activity_pipeline_interest_index campaign_ctr_pct cost_per_lead_eur
    crm_activity_count crm_activity_minutes crm_demo_like_count avg_sentiment_score avg_customer_health_score
    pipeline_opportunities weighted_pipeline_eur expected_pipeline_eur avg_win_probability avg_days_to_close
    closed_won_count closed_lost_count pipeline_conversion_rate
    market_demand_index market_growth_pct competitor_pressure_index seasonality_index macro_business_index supply_pressure_index
    market_pipeline_interest_index demand_shock_flag regional_market_growth_factor market_opportunity_score
    units_lag_1m units_lag_3m revenue_lag_1m customers_lag_1m rolling_units_mean_3m rolling_units_mean_6m rolling_units_std_3m
    trend_slope_3m trend_slope_6m rolling_revenue_mean_3m rolling_revenue_std_3m volatility_3m
    mom_units_growth_pct customer_count_growth_pct
    risk_factor_sales_drop risk_factor_customer_drop risk_factor_volatility risk_factor_under_trend
    backorder_rate supply_pressure_score high_competition_flag weak_market_flag commercial_pressure_score
    """.split()
)

CTES["t_fit"] = f"""
SELECT {', '.join(f"any_value(m_{c}) AS m_{c}, avg(coalesce({c}, m_{c})) AS a_{c}, coalesce(nullif(stddev_samp(coalesce({c}, m_{c})), 0), 1) AS s_{c}" for c in NUMERIC)}
FROM t_split CROSS JOIN (SELECT {', '.join(f"coalesce(median({c}), 0) AS m_{c}" for c in NUMERIC)} FROM t_split WHERE split = 'train')
WHERE split = 'train'
"""

CTES["t_prep"] = f"""
SELECT product_id, region_id, year_month, target_month, split, next_month_risk_label,
       {', '.join(f"(coalesce({c}, m_{c}) - a_{c}) / s_{c} AS {c}" for c in NUMERIC)}
FROM t_split CROSS JOIN t_fit
"""

CTES["t_class"] = "\nUNION ALL ".join(
    f"""SELECT '{c}' AS feature, next_month_risk_label AS label, count(*) AS n, avg({c}) AS mean, var_pop({c}) AS var,
           (SELECT avg({c}) FROM t_prep WHERE split = 'train') AS grand,
           (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM t_prep WHERE split = 'train') AS spread
FROM t_prep WHERE split = 'train' GROUP BY next_month_risk_label"""
    for c in NUMERIC
)

_NAME = re.compile(r"\bt_[a-z_]+\b")


def with_ctes(body: str) -> str:
    """The statement with the expressions it needs, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in CTES and name not in needed:
                needed.add(name)
                visit(CTES[name])

    visit(body)
    if not needed:
        return body
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    parts = [f"{name} AS MATERIALIZED ({sql.strip()})" for name, sql in CTES.items() if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body
