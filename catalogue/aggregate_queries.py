"""Aggregations of every source and the descriptive reports."""

from pyspark.sql import functions as F

from catalogue.base import customer_months, labelled, panel, query, written
from riskloom.operators import profiles as P
from riskloom.operators.quantiles import exact_percentiles
from riskloom.plans import market as mk, monthly as mo
from riskloom.plans.learning import RISK_LABELS
from riskloom.plans.history import TARGET
from riskloom.plans.sales import first_seen, launch_audit
from riskloom.sources.star import DISTRIBUTOR, ENTERPRISE

KEYS = ["product_id", "region_id", "year_month"]


@query(
    "ag01_customer_product_monthly", "SELECT * FROM t_cpm",
    rounded="units_sold revenue avg_discount_pct gross_profit_eur",
)
def customer_product_monthly(star):
    return mo.customer_product_monthly(written(star).sales)


@query(
    "ag02_monthly_sales", "SELECT * FROM t_monthly",
    rounded="units_sold revenue avg_discount_pct avg_asp_eur gross_profit_eur cogs_eur discount_value_eur gross_margin_pct",
)
def monthly_sales(star):
    return mo.monthly_sales(written(star).sales)


@query("ag03_customer_mix_month", "SELECT * FROM t_customer_month", rounded="avg_customer_size_score avg_base_churn_probability")
def customer_month(star):
    return mo.customer_month_features(written(star).sales, ENTERPRISE)


@query("ag04_quota_month", "SELECT * FROM t_quota", rounded="covered_annual_quota_eur")
def quota_month(star):
    return mo.quota_month(written(star).sales, star.reps)


@query(
    "ag05_distinct_counts",
    """SELECT product_id, count(DISTINCT customer_id) AS customers, count(DISTINCT sales_rep_id) AS reps,
              count(DISTINCT discount_pct) AS discounts FROM t_sales GROUP BY 1""",
)
def distinct_counts(star):
    return star.raw_sales().groupBy("product_id").agg(
        F.count_distinct("customer_id").alias("customers"), F.count_distinct("sales_rep_id").alias("reps"),
        F.count_distinct("discount_pct").alias("discounts"),
    )


@query(
    "ag06_most_common",
    """SELECT customer_id, coalesce(first(v ORDER BY n DESC, v), 'Unknown') AS usual_status FROM (
         SELECT o_custkey AS customer_id, CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END AS v,
                CASE WHEN CASE WHEN o_orderkey % 5 > 0 THEN o_orderstatus END IS NULL THEN -1 ELSE count(*) END AS n
         FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def most_common(star):
    gap = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderstatus"))
    df = star.table("orders").select(F.col("o_custkey").alias("customer_id"), gap.alias("status"))
    return df.groupBy("customer_id").agg(mo.most_common("status").alias("usual_status"))


@query("ag07_first_seen", "SELECT product_id, min(order_date) AS first_sale FROM t_sales GROUP BY 1")
def first_sale(star):
    return first_seen(star.raw_sales(), "product_id", "order_date", "first_sale")


@query(
    "ag08_inventory_monthly",
    """SELECT product_id, region_id, year_month, opening_stock_units, production_units, ending_stock_units, stockout_flag,
              zero_stock_flag, inventory_value_eur FROM t_inventory""",
    rounded="opening_stock_units production_units ending_stock_units inventory_value_eur",
)
def inventory_monthly(star):
    return mo.inventory_monthly(star.inventory())


@query(
    "ag09_cost_monthly", "SELECT * FROM t_costs",
    rounded="standard_unit_cost_eur actual_unit_cost_eur cost_variance_eur cost_variance_pct",
)
def cost_monthly(star):
    return mo.cost_monthly(star.costs())


@query("ag10_returns_monthly", "SELECT * FROM t_returns", rounded="return_units return_value_eur")
def returns_monthly(star):
    return mo.returns_monthly(star.returns)


@query(
    "ag10_return_rate",
    "SELECT product_id, region_id, year_month, return_units, return_rate_units FROM t_full",
    rounded="return_units return_rate_units",
)
def return_rate(star):
    return labelled(star).select(*KEYS, "return_units", "return_rate_units")


@query("ag11_crm_region_month", "SELECT * FROM t_crm_month", rounded="avg_sentiment_score avg_customer_health_score")
def crm_region_month(star):
    return mo.crm_region_month(star.crm)


@query(
    "ag11_crm_region_day",
    """SELECT CAST(ts AS DATE) AS day, user_id % 5 AS region_id, count(DISTINCT event_id) AS crm_activity_count,
              count(*) AS crm_activity_minutes, 0 AS crm_demo_like_count, avg(value / 100.0) AS avg_sentiment_score,
              avg(value) AS avg_customer_health_score FROM events GROUP BY 1, 2""",
    rounded="avg_sentiment_score avg_customer_health_score",
)
def crm_region_day(star):
    return mo.crm_region_month(star.event_activity, "day")


@query(
    "ag12_opportunity_monthly", "SELECT * FROM t_opps_month",
    rounded="weighted_pipeline_eur expected_pipeline_eur avg_win_probability avg_days_to_close pipeline_conversion_rate",
)
def opportunity_monthly(star):
    return mo.opportunity_monthly(star.opportunities)


@query(
    "ag13_market_activity_monthly", "SELECT * FROM t_activity",
    rounded="""campaign_spend_eur campaign_impressions campaign_clicks website_visits product_page_views demo_requests
               marketing_qualified_leads regional_crm_activity_index activity_pipeline_interest_index campaign_ctr_pct
               cost_per_lead_eur""",
)
def market_activity_monthly(star):
    return mo.market_activity_monthly(star.market_activity())


@query(
    "ag14_market_signals_monthly", "SELECT * FROM t_signals",
    rounded="""market_demand_index market_growth_pct competitor_pressure_index seasonality_index macro_business_index
               supply_pressure_index market_pipeline_interest_index regional_market_growth_factor market_opportunity_score""",
)
def market_signals_monthly(star):
    return mo.market_signals_monthly(star.market_signals())


@query(
    "ag15_group_profile",
    """SELECT product_line, product_category, count(DISTINCT product_id) AS product_count,
              avg(target_margin_pct) AS average_target_margin_pct, avg(product_growth_factor) AS average_product_growth_factor,
              avg(is_declining_product) AS decline_product_share, median(base_list_price_eur) AS median_list_price_eur
       FROM t_products GROUP BY 1, 2""",
    rounded="average_target_margin_pct average_product_growth_factor decline_product_share median_list_price_eur",
)
def group_profile(star):
    return mo.group_profile(star.products)


@query(
    "ag15_part_price_median",
    """SELECT p_brand, median(p_retailprice) AS median_p_retailprice, median(p_size) AS median_p_size FROM part GROUP BY 1""",
    rounded="median_p_retailprice median_p_size",
)
def part_price_median(star):
    return mo.exact_medians(star.table("part"), ["p_brand"], ["p_retailprice", "p_size"])


@query(
    "ag15_ambiguous_groups",
    "SELECT product_category, count(DISTINCT product_line) AS product_lines FROM t_products GROUP BY 1 HAVING count(DISTINCT product_line) > 1",
)
def ambiguous_groups(star):
    return mo.ambiguous_groups(star.products)


def _group_inventory(star):
    w = written(star)
    return w.inventory().join(star.products.select("product_id", "product_category"), "product_id")


@query(
    "ag16_supply_driver",
    """SELECT year_month, product_category, region_id, avg(CAST(stockout AS INTEGER)) AS stockout_rate,
              avg(greatest(0, least(1, ending_stock_units / nullif(opening_stock_units + production_units, 0))))
                FILTER (opening_stock_units + production_units <> 0) AS average_available_stock_ratio
       FROM t_inventory JOIN (SELECT product_id, product_category FROM t_products) USING (product_id) GROUP BY 1, 2, 3""",
    rounded="stockout_rate average_available_stock_ratio",
)
def supply_driver(star):
    return mk.supply_driver(_group_inventory(star))


@query(
    "ag17_sales_driver",
    """SELECT year_month, product_category, region_id, sum(units) AS observed_units
       FROM t_sales JOIN (SELECT product_id, product_category FROM t_products) USING (product_id) GROUP BY 1, 2, 3""",
    rounded="observed_units",
)
def sales_driver(star):
    return mk.sales_driver(written(star).sales.join(star.products.select("product_id", "product_category"), "product_id"))


@query(
    "ag18_campaign_summary",
    """SELECT campaign_flag, count(*) AS row_count, avg(campaign_spend_eur) AS average_spend_eur,
              avg(campaign_impressions) AS average_impressions, avg(website_visits) AS average_website_visits,
              avg(demo_requests) AS average_demo_requests, avg(marketing_qualified_leads) AS average_mqls,
              median(cost_per_lead_eur) AS median_cost_per_lead_eur FROM t_activity GROUP BY 1""",
    rounded="average_spend_eur average_impressions average_website_visits average_demo_requests average_mqls median_cost_per_lead_eur",
)
def campaign_summary(star):
    return mo.campaign_summary(mo.market_activity_monthly(written(star).market_activity()))


@query(
    "ag18_channel_summary",
    """SELECT campaign_channel, count(*) AS campaigns, avg(campaign_spend_eur) AS average_spend_eur,
              avg(campaign_ctr_pct) AS average_ctr_pct, avg(marketing_qualified_leads) AS average_mqls
       FROM t_activity WHERE campaign_flag = 1 GROUP BY 1""",
    rounded="average_spend_eur average_ctr_pct average_mqls",
)
def channel_summary(star):
    return mo.channel_summary(mo.market_activity_monthly(written(star).market_activity()))


@query(
    "ag19_customer_mix", "SELECT * FROM t_mix",
    rounded="distributor_order_share churn_risk_customer_share avg_order_units avg_order_revenue",
)
def customer_mix(star):
    return mo.customer_mix(customer_months(star), DISTRIBUTOR)


@query(
    "ag20_label_distribution",
    """SELECT next_month_risk_label AS label, count(*) AS row_count,
              count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM t_labelled GROUP BY 1""",
    rounded="share",
)
def label_distribution(star):
    return P.label_distribution(labelled(star), TARGET)


@query(
    "ag20_label_distribution_by_region",
    """SELECT region_id, label, count(*) FILTER (next_month_risk_label = label) AS row_count,
              count(*) FILTER (next_month_risk_label = label) / CAST(count(*) AS DOUBLE) AS share
       FROM t_labelled CROSS JOIN (SELECT unnest([0, 1, 2]) AS label) WHERE next_month_risk_label IS NOT NULL GROUP BY 1, 2""",
    rounded="share",
)
def label_distribution_by_region(star):
    known = labelled(star).where(F.col(TARGET).isNotNull())
    return P.label_distribution(known, TARGET, RISK_LABELS, "region_id")


@query(
    "ag21_describe",
    """SELECT 'l_quantity' AS "column", count(l_quantity) AS n, avg(l_quantity) AS mean, stddev_samp(l_quantity) AS std,
              min(l_quantity) AS min, max(l_quantity) AS max, quantile_cont(l_quantity, 0.01) AS p1,
              quantile_cont(l_quantity, 0.5) AS p50, quantile_cont(l_quantity, 0.99) AS p99 FROM lineitem
       UNION ALL SELECT 'l_extendedprice', count(l_extendedprice), avg(l_extendedprice), stddev_samp(l_extendedprice),
              min(l_extendedprice), max(l_extendedprice), quantile_cont(l_extendedprice, 0.01),
              quantile_cont(l_extendedprice, 0.5), quantile_cont(l_extendedprice, 0.99) FROM lineitem""",
    rounded="mean std min max p1 p50 p99", digits=4,
)
def describe(star):
    return P.describe(star.table("lineitem"), ["l_quantity", "l_extendedprice"], [0.01, 0.5, 0.99])


@query(
    "ag21_grouped_percentiles",
    """SELECT event_type, 'value' AS "column", p AS point, CASE p WHEN 0.25 THEN quantile_cont(value, 0.25)
              WHEN 0.5 THEN quantile_cont(value, 0.5) ELSE quantile_cont(value, 0.9) END AS value
       FROM events, (SELECT unnest([0.25, 0.5, 0.9])::DOUBLE AS p) GROUP BY event_type, p""",
    rounded="value point",
)
def grouped_percentiles(star):
    return exact_percentiles(star.table("events"), ["event_type"], ["value"], [0.25, 0.5, 0.9])


@query(
    "ag22_crosstab",
    """SELECT c_mktsegment, count(*) FILTER (n_regionkey = 0) AS "0", count(*) FILTER (n_regionkey = 1) AS "1",
              count(*) FILTER (n_regionkey = 2) AS "2", count(*) FILTER (n_regionkey = 3) AS "3",
              count(*) FILTER (n_regionkey = 4) AS "4" FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def crosstab(star):
    return P.crosstab(star.customers.withColumnRenamed("customer_segment", "c_mktsegment"), "c_mktsegment", "region_id", [0, 1, 2, 3, 4])


@query(
    "ag23_segment_profile",
    """SELECT c_mktsegment AS customer_segment, count(*) AS customers, avg(c_acctbal) AS avg_size,
              avg((c_custkey % 20) / 100.0) AS avg_churn FROM customer GROUP BY 1""",
    rounded="avg_size avg_churn",
)
def segment_profile(star):
    return star.customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.avg("customer_size_score").alias("avg_size"),
        F.avg("base_churn_probability").alias("avg_churn"),
    )


@query(
    "ag23_reps_by_region",
    """SELECT region, seniority, count(*) AS reps, sum(annual_quota_eur) AS quota
       FROM t_reps JOIN t_regions USING (region_id) GROUP BY 1, 2""",
    rounded="quota",
)
def reps_by_region(star):
    return star.reps.join(star.regions.select("region_id", "region"), "region_id").groupBy("region", "seniority").agg(
        F.count(F.lit(1)).alias("reps"), F.sum("annual_quota_eur").alias("quota")
    )


@query(
    "ag24_monthly_actuals",
    """SELECT year_month, product_id, region_id, sum(units) AS actual_units, sum(revenue) AS actual_revenue_eur,
              sum(gross_profit_eur) AS actual_gp_eur FROM t_sales GROUP BY 1, 2, 3""",
    rounded="actual_units actual_revenue_eur actual_gp_eur",
)
def monthly_actuals(star):
    return mo.monthly_actuals(star.sales)


@query(
    "ag25_kpis",
    """SELECT unnest(['transactions', 'total_units', 'revenue_eur', 'gross_profit_eur', 'average_gross_margin', 'outlier_orders']) AS metric,
              unnest([CAST(count(*) AS DOUBLE), sum(units), round(sum(revenue), 2), round(sum(gross_profit_eur), 2),
                      avg(gross_margin_pct), CAST(count(*) FILTER (is_outlier_order) AS DOUBLE)]) AS value FROM t_sales""",
    rounded="value", digits=4,
)
def kpi_rows(star):
    return P.kpis(
        written(star).sales,
        {
            "transactions": F.count(F.lit(1)),
            "total_units": F.sum("units"),
            "revenue_eur": F.round(F.sum("revenue"), 2),
            "gross_profit_eur": F.round(F.sum("gross_profit_eur"), 2),
            "average_gross_margin": F.avg("gross_margin_pct"),
            "outlier_orders": F.count_if("is_outlier_order"),
        },
    )


@query(
    "ag25_missing_pct",
    """SELECT 'sales_rep_id' AS "column", 100.0 * count(*) FILTER (sales_rep_id IS NULL) / count(*) AS missing_pct FROM t_sales
       UNION ALL SELECT 'discount_pct', 100.0 * count(*) FILTER (discount_pct IS NULL) / count(*) FROM t_sales""",
    rounded="missing_pct",
)
def missing_share(star):
    return P.missing_pct(star.raw_sales().select("sales_rep_id", "discount_pct", "units", "product_id"))


@query(
    "ag26_reconcile",
    """SELECT unnest(['units_sold', 'revenue']) AS measure, unnest([sum(units), round(sum(revenue), 2)]) AS detail_total,
              unnest([sum(units), round(sum(revenue), 2)]) AS summary_total, 0.0::DOUBLE AS difference, TRUE AS passed FROM t_sales""",
    rounded="detail_total summary_total difference", digits=2,
)
def reconcile(star):
    return P.reconcile(written(star).sales, panel(star), ["units_sold", "revenue"])


@query(
    "ag27_profile",
    """SELECT 'orders' AS table_name, count(*) AS row_count, 3 AS column_count,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END FROM orders)) AS duplicate_rows,
              100.0 * count(*) FILTER (o_orderkey % 7 = 0) / (3 * count(*)) AS missing_cells_pct FROM orders""",
    rounded="missing_cells_pct",
)
def table_profile(star):
    gap = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))
    return P.profile(star.table("orders").select("o_custkey", "o_orderstatus", gap.alias("priority")), "orders")


@query(
    "ag28_launch_audit",
    """SELECT p.product_id, product_line, product_category, launch_date AS launch_month, f.first_month AS first_sales_month,
              least(launch_date, f.first_month) AS effective_launch_month,
              CAST(date_diff('month', f.first_month, launch_date) AS INTEGER) AS launch_month_gap, e.n AS sales_rows_before_configured_launch,
              e.lo AS earliest_sales_month, e.hi AS latest_prelaunch_sales_month
       FROM t_products p JOIN (SELECT product_id, min(year_month) AS first_month FROM t_sales GROUP BY 1) f USING (product_id)
       JOIN (SELECT s.product_id, count(*) AS n, min(year_month) AS lo, max(year_month) AS hi
             FROM t_sales s JOIN t_products q ON q.product_id = s.product_id WHERE year_month < launch_date GROUP BY 1) e
         ON e.product_id = p.product_id WHERE f.first_month < launch_date""",
)
def audit_launches(star):
    return launch_audit(star.products, written(star).sales)


@query(
    "ag29_zero_sales_share",
    """SELECT product_category, avg(CAST(units_sold = 0 AS INTEGER)) AS zero_sales, avg(CAST(unique_customers > 3 AS INTEGER)) AS busy
       FROM t_panel GROUP BY 1""",
    rounded="zero_sales busy",
)
def zero_sales_share(star):
    return P.shares(
        panel(star), {"zero_sales": F.col("units_sold") == 0, "busy": F.col("unique_customers") > 3}, ["product_category"]
    )


@query(
    "ag30_numeric_quality",
    """SELECT 'discount_pct' AS "column", count(*) FILTER (discount_pct IS NULL) AS missing_values, min(discount_pct) AS minimum,
              max(discount_pct) AS maximum FROM t_sales
       UNION ALL SELECT 'units', count(*) FILTER (units IS NULL), min(units), max(units) FROM t_sales""",
    rounded="minimum maximum",
)
def numeric_quality(star):
    return P.numeric_quality(star.raw_sales(), ["discount_pct", "units"])
