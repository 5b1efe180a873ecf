"""Data-quality check tables."""

from pyspark.sql import functions as F

from catalogue.base import features, labelled, panel, predictions, prepared, query, split_features, written
from catalogue.model_sql import NUMERIC
from riskloom.functions import dates as D
from riskloom.operators import profiles as P, quality as Q
from riskloom.operators.joins import require_match
from riskloom.plans.calendar import months
from riskloom.plans.history import TARGET
from riskloom.plans.monthly import market_activity_monthly
from riskloom.plans.sales import customer_starts

KEYS = ["product_id", "region_id", "year_month"]


def _checks_sql(relation: str, rules: dict[str, str]) -> str:
    """(check_name, passed, detail) per rule, one row each."""
    return "\nUNION ALL ".join(
        f"""SELECT '{name}' AS check_name, count(*) FILTER ({cond}) = 0 AS passed,
            CAST(count(*) FILTER ({cond}) AS VARCHAR) AS detail FROM {relation}"""
        for name, cond in rules.items()
    )


def _pk_sql(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{key}' AS key_name, count(*) AS row_count, count(*) FILTER ({key} IS NULL) AS missing_keys,
        count({key}) - count(DISTINCT {key}) AS duplicate_keys,
        count({key}) = count(DISTINCT {key}) AND count(*) FILTER ({key} IS NULL) = 0 AS passed FROM {table}"""


_PKS = {"region": "r_regionkey", "nation": "n_nationkey", "customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey",
        "orders": "o_orderkey", "lineitem": "l_orderkey", "events": "event_id"}


@query("dq03_primary_keys", "\nUNION ALL ".join(_pk_sql(t, k) for t, k in _PKS.items()))
def primary_keys(star):
    return Q.union_all(*[Q.check_pk(star.table(t), k, t) for t, k in _PKS.items()])


@query(
    "dq04_grains",
    """SELECT 'panel' AS table_name, 'product_id x region_id x year_month' AS grain, count(*) - count(DISTINCT (product_id, region_id, year_month)) AS duplicate_keys,
              count(*) = count(DISTINCT (product_id, region_id, year_month)) AS passed FROM t_panel
       UNION ALL SELECT 'lineitem', 'l_orderkey x l_linenumber',
              (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
              (SELECT count(*) FROM lineitem) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))""",
)
def grains(star):
    return Q.union_all(
        Q.check_grain(panel(star), KEYS, "panel"),
        Q.check_grain(star.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem"),
    )


_FKS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey", False),
    ("lineitem", "l_partkey", "part", "p_partkey", False),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", True),
    ("orders", "o_custkey", "customer", "c_custkey", False),
    ("customer", "c_nationkey", "nation", "n_nationkey", False),
    ("supplier", "s_nationkey", "nation", "n_nationkey", False),
    ("nation", "n_regionkey", "region", "r_regionkey", False),
    ("events", "user_id", "customer", "c_custkey", True),
    ("labels", "doc_id", "documents", "doc_id", False),
]


@query(
    "dq05_foreign_keys",
    "\nUNION ALL ".join(
        f"""SELECT '{f}.{k} -> {d}' AS relation, count(*) AS unmatched_rows, count(*) = 0 AS passed
            FROM {f} WHERE NOT EXISTS (SELECT 1 FROM {d} x WHERE x.{dk} = {f}.{k})"""
        for f, k, d, dk, _ in _FKS
    ),
)
def foreign_keys(star):
    names = {n for f, _, d, _, _ in _FKS for n in (f, d)}
    return Q.check_fks({n: star.table(n) for n in names}, _FKS)


@query(
    "dq06_dimension_keys",
    "\nUNION ALL ".join(
        f"""SELECT '{n}' AS table_name, '{k}' AS key_name, count(*) AS row_count, count(*) - count({k}) AS missing_keys,
            count({k}) - count(DISTINCT {k}) AS duplicate_keys, count(*) = count(DISTINCT {k}) AS passed FROM {t}"""
        for n, k, t in (("products", "product_id", "t_products"), ("customers", "customer_id", "t_customers"),
                        ("regions", "region_id", "t_regions"), ("sales_reps", "sales_rep_id", "t_reps"))
    ),
)
def dimension_keys(star):
    return Q.check_dims(
        {
            "products": (star.products, "product_id"), "customers": (star.customers, "customer_id"),
            "regions": (star.regions, "region_id"), "sales_reps": (star.reps, "sales_rep_id"),
        }
    )


@query(
    "dq07_time_rules",
    _checks_sql(
        """(SELECT s.order_date, p.launch_date, c.customer_since, t.effective_launch_date, u.es FROM t_sales s
            JOIN t_products p ON p.product_id = s.product_id JOIN t_customers c ON c.customer_id = s.customer_id
            JOIN t_starts t ON t.product_id = s.product_id
            JOIN (SELECT a.customer_id, least(min(order_date), any_value(b.customer_since)) AS es FROM t_sales a
                  JOIN t_customers b ON b.customer_id = a.customer_id GROUP BY 1) u ON u.customer_id = s.customer_id)""",
        {
            "before_configured_launch": "order_date < launch_date",
            "before_configured_customer_start": "order_date < customer_since",
            "before_effective_launch": "order_date < effective_launch_date",
            "before_effective_customer_start": "order_date < es",
        },
    ),
)
def time_rules(star):
    sales = written(star).sales
    dated = (
        sales.select("product_id", "customer_id", "order_date")
        .join(star.products.select("product_id", "launch_date"), "product_id", "left")
        .join(star.customers.select("customer_id", "customer_since"), "customer_id", "left")
        .join(written(star).starts.select("product_id", "effective_launch_date"), "product_id", "left")
        .join(customer_starts(star.customers, sales).select("customer_id", "effective_customer_since"), "customer_id", "left")
    )
    day = F.col("order_date")
    return Q.check_none(
        dated,
        {
            "before_configured_launch": day < F.col("launch_date"),
            "before_configured_customer_start": day < F.col("customer_since"),
            "before_effective_launch": day < F.col("effective_launch_date"),
            "before_effective_customer_start": day < F.col("effective_customer_since"),
        },
    )


@query(
    "dq08_business_rules",
    _checks_sql(
        """(SELECT s.*, r.region_id AS rep_region FROM t_sales s LEFT JOIN t_reps r ON r.sales_rep_id = s.sales_rep_id)""",
        {
            "rep_in_sales_region": "sales_rep_id IS NOT NULL AND region_id <> rep_region",
            "discount_in_range": "discount_pct NOT BETWEEN 0 AND 0.38",
            "units_positive": "units <= 0",
            "revenue_formula": "abs(revenue_eur - units * asp_eur * (1 - coalesce(discount_pct, 0))) > greatest(1, abs(revenue_eur) * 0.001)",
            "profit_formula": "abs(gross_profit_eur - (revenue_eur - units * unit_cost_eur)) > greatest(1, abs(revenue_eur) * 0.001)",
        },
    ),
)
def business_rules(star):
    w = written(star)
    reps = star.reps.select("sales_rep_id", F.col("region_id").alias("rep_region"))
    sales = w.sales.join(reps, "sales_rep_id", "left")
    revenue, units = F.col("revenue_eur"), F.col("units")
    allowed = F.greatest(F.lit(1.0), F.abs(revenue) * 0.001)
    priced = units * F.col("asp_eur") * (1 - F.coalesce(F.col("discount_pct"), F.lit(0.0)))
    return Q.check_none(
        sales,
        {
            "rep_in_sales_region": F.col("sales_rep_id").isNotNull() & (F.col("region_id") != F.col("rep_region")),
            "discount_in_range": ~F.col("discount_pct").between(0, 0.38),
            "units_positive": units <= 0,
            "revenue_formula": F.abs(revenue - priced) > allowed,
            "profit_formula": F.abs(F.col("gross_profit_eur") - (revenue - units * F.col("unit_cost_eur"))) > allowed,
        },
    )


@query(
    "dq08_activity_rules",
    _checks_sql("t_opps", {"close_after_created": "expected_close_date <= day", "probability_in_range": "win_probability NOT BETWEEN 0 AND 1"})
    + "\nUNION ALL "
    + _checks_sql(
        "(SELECT l.*, o_orderdate FROM lineitem l JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')",
        {"return_after_sale": "CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE)"},
    )
    + "\nUNION ALL "
    + _checks_sql(
        """(SELECT r.returned, s.l_quantity AS sold FROM
              (SELECT l_orderkey, l_linenumber, ceil(round(l_quantity * (l_discount + l_tax) * 10, 6)) AS returned FROM lineitem WHERE l_returnflag = 'R') r
              JOIN lineitem s ON s.l_orderkey = r.l_orderkey AND s.l_linenumber = r.l_linenumber)""",
        {"returned_within_sold": "returned > sold"},
    )
    + "\nUNION ALL "
    + _checks_sql("t_crm", {"sentiment_in_range": "sentiment_score NOT BETWEEN -1 AND 1"}),
)
def activity_rules(star):
    opps = Q.check_none(
        star.opportunities,
        {
            "close_after_created": F.col("expected_close_date") <= F.col("created_date"),
            "probability_in_range": ~F.col("win_probability").between(0, 1),
        },
    )
    sold = star.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("sale_date"))
    returned = star.table("lineitem").where("l_returnflag = 'R'").join(sold, F.col("l_orderkey") == F.col("o_orderkey"))
    returns = Q.check_none(
        returned,
        {
            "return_after_sale": F.col("l_shipdate").cast("date") < F.col("sale_date"),
        },
    )
    # units sent back, by the line's rates, against the units of the sale with the same order and line
    back = F.ceil(F.round(F.col("l_quantity") * (F.col("l_discount") + F.col("l_tax")) * 10, 6))
    sent_back = star.table("lineitem").where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", back.alias("returned"))
    sale_lines = star.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("sold"))
    within = Q.check_none(sent_back.join(sale_lines, ["l_orderkey", "l_linenumber"]), {"returned_within_sold": F.col("returned") > F.col("sold")})
    crm = Q.check_none(star.crm, {"sentiment_in_range": ~F.col("sentiment_score").between(-1, 1)})
    return Q.union_all(opps, returns, within, crm)


@query(
    "dq09_sales_quality",
    """SELECT unnest(['row_count', 'transactions', 'first_month', 'last_month', 'negative_units', 'negative_revenue', 'missing_reps', 'missing_discounts']) AS metric,
              unnest([count(*), count(DISTINCT transaction_id), min(year(year_month) * 100 + month(year_month)),
                      max(year(year_month) * 100 + month(year_month)), count(*) FILTER (units < 0), count(*) FILTER (revenue < 0),
                      count(*) FILTER (sales_rep_id IS NULL), count(*) FILTER (discount_pct IS NULL)])::DOUBLE AS value FROM t_sales""",
    rounded="value",
)
def sales_quality(star):
    return P.kpis(
        written(star).sales,
        {
            "row_count": F.count(F.lit(1)), "transactions": F.count_distinct("transaction_id"),
            "first_month": F.min(D.month_key("year_month")), "last_month": F.max(D.month_key("year_month")),
            "negative_units": F.count_if(F.col("units") < 0), "negative_revenue": F.count_if(F.col("revenue") < 0),
            "missing_reps": F.count_if(F.col("sales_rep_id").isNull()), "missing_discounts": F.count_if(F.col("discount_pct").isNull()),
        },
    )


@query(
    "dq10_signal_checks",
    _checks_sql(
        "t_signals",
        {
            "no_missing_values": "market_demand_index IS NULL OR market_opportunity_score IS NULL",
            "binary_shock_flag": "demand_shock_flag NOT IN (0, 1)",
            "demand_in_range": "market_demand_index NOT BETWEEN 42 AND 180",
            "opportunity_in_range": "market_opportunity_score NOT BETWEEN 0 AND 100",
        },
    )
    + """ UNION ALL SELECT 'unique_key', count(*) = count(DISTINCT (year_month, product_line, product_category, region_id)),
          CAST(count(*) - count(DISTINCT (year_month, product_line, product_category, region_id)) AS VARCHAR) FROM t_signals
          UNION ALL SELECT 'all_months_present', count(*) = 0, CAST(count(*) AS VARCHAR) FROM
          (SELECT year_month FROM t_months EXCEPT SELECT year_month FROM t_signals)
          UNION ALL SELECT 'canonical_groups', count(*) = 0, CAST(count(*) AS VARCHAR) FROM
          (SELECT product_line, product_category FROM t_signals EXCEPT SELECT product_line, product_category FROM t_products)
          UNION ALL SELECT 'all_regions_present', count(*) = 0, CAST(count(*) AS VARCHAR) FROM
          (SELECT region_id FROM t_regions EXCEPT SELECT region_id FROM t_signals)
          UNION ALL SELECT 'expected_row_count', n = e, n || ' / ' || e FROM
          (SELECT (SELECT count(*) FROM t_signals) AS n,
                  (SELECT count(DISTINCT (product_line, product_category)) FROM t_products) * (SELECT count(*) FROM t_regions) * (SELECT count(*) FROM t_months) AS e)""",
)
def signal_checks(star):
    signals = written(star).market_signals()
    rules = Q.check_none(
        signals,
        {
            "no_missing_values": F.col("market_demand_index").isNull() | F.col("market_opportunity_score").isNull(),
            "binary_shock_flag": ~F.col("demand_shock_flag").isin(0, 1),
            "demand_in_range": ~F.col("market_demand_index").between(42, 180),
            "opportunity_in_range": ~F.col("market_opportunity_score").between(0, 100),
        },
    )
    grain = Q.check_grain(signals, ["year_month", "product_line", "product_category", "region_id"])
    unique = grain.select(F.lit("unique_key").alias("check_name"), "passed", F.col("duplicate_keys").cast("string").alias("detail"))
    lost = months(star.bounds).subtract(signals.select("year_month")).agg(F.count(F.lit(1)).alias("n"))
    present = lost.select(F.lit("all_months_present").alias("check_name"), (F.col("n") == 0).alias("passed"), F.col("n").cast("string").alias("detail"))
    group = ["product_line", "product_category"]
    groups = star.products.select(*group).distinct()
    strange = signals.select(*group).subtract(groups).agg(F.count(F.lit(1)).alias("n"))
    absent = star.regions.select("region_id").subtract(signals.select("region_id")).agg(F.count(F.lit(1)).alias("n"))
    gone = [
        t.select(F.lit(name).alias("check_name"), (F.col("n") == 0).alias("passed"), F.col("n").cast("string").alias("detail"))
        for name, t in (("canonical_groups", strange), ("all_regions_present", absent))
    ]
    count = lambda t: t.agg(F.count(F.lit(1))).scalar()
    wanted = count(groups) * count(star.regions) * count(months(star.bounds))
    size = signals.agg(F.count(F.lit(1)).alias("n")).select("n", wanted.alias("e")).select(
        F.lit("expected_row_count").alias("check_name"), (F.col("n") == F.col("e")).alias("passed"), F.concat_ws(" / ", "n", "e").alias("detail")
    )
    return Q.union_all(rules, unique, present, *gone, size)


_ACTIVITY_RULES = {
    "no_spend_without_campaign": "campaign_flag = 0 AND campaign_spend_eur <> 0",
    "no_impressions_without_campaign": "campaign_flag = 0 AND campaign_impressions <> 0",
    "no_clicks_without_campaign": "campaign_flag = 0 AND campaign_clicks <> 0",
    "clicks_within_impressions": "campaign_clicks > campaign_impressions",
    "ctr_in_range": "campaign_ctr_pct NOT BETWEEN 0 AND 100",
    "views_not_below_visits": "product_page_views < website_visits",
    "mqls_not_below_demos": "marketing_qualified_leads < demo_requests",
    "binary_campaign_flag": "campaign_flag NOT IN (0, 1)",
    "no_negative_values": """least(campaign_spend_eur, campaign_impressions, campaign_clicks, website_visits, product_page_views, demo_requests,
                             marketing_qualified_leads) < 0""",
    "no_unexpected_missing": """campaign_channel IS NULL OR campaign_flag IS NULL OR campaign_spend_eur IS NULL OR campaign_impressions IS NULL
        OR campaign_clicks IS NULL OR website_visits IS NULL OR product_page_views IS NULL OR demo_requests IS NULL OR marketing_qualified_leads IS NULL""",
}


@query(
    "dq11_activity_checks",
    _checks_sql("t_activity", _ACTIVITY_RULES)
    + """ UNION ALL SELECT 'unique_key', count(*) = count(DISTINCT (product_id, region_id, year_month)),
          CAST(count(*) - count(DISTINCT (product_id, region_id, year_month)) AS VARCHAR) FROM t_activity
          UNION ALL SELECT 'one_row_per_base_row', (SELECT count(*) FROM t_activity) = (SELECT count(*) FROM t_base),
          (SELECT count(*) FROM t_activity) || ' / ' || (SELECT count(*) FROM t_base)""",
)
def activity_checks(star):
    def c(name):
        return F.col(name)

    sums = ("campaign_spend_eur", "campaign_impressions", "campaign_clicks", "website_visits", "product_page_views", "demo_requests", "marketing_qualified_leads")
    idle = c("campaign_flag") == 0
    base = written(star)
    activity = market_activity_monthly(base.market_activity())
    rules = Q.check_none(
        activity,
        {
            "no_spend_without_campaign": idle & (c("campaign_spend_eur") != 0),
            "no_impressions_without_campaign": idle & (c("campaign_impressions") != 0),
            "no_clicks_without_campaign": idle & (c("campaign_clicks") != 0),
            "clicks_within_impressions": c("campaign_clicks") > c("campaign_impressions"),
            "ctr_in_range": ~c("campaign_ctr_pct").between(0, 100),
            "views_not_below_visits": c("product_page_views") < c("website_visits"),
            "mqls_not_below_demos": c("marketing_qualified_leads") < c("demo_requests"),
            "binary_campaign_flag": ~c("campaign_flag").isin(0, 1),
            "no_negative_values": F.least(*sums) < 0,
            "no_unexpected_missing": F.greatest(*(c(x).isNull() for x in ("campaign_channel", "campaign_flag", *sums))),
        },
    )
    grain = Q.check_grain(activity, KEYS).select(F.lit("unique_key").alias("check_name"), "passed", F.col("duplicate_keys").cast("string").alias("detail"))
    wanted = base.monthly_base.agg(F.count(F.lit(1))).scalar()
    size = activity.agg(F.count(F.lit(1)).alias("n")).select("n", wanted.alias("e")).select(
        F.lit("one_row_per_base_row").alias("check_name"), (F.col("n") == F.col("e")).alias("passed"), F.concat_ws(" / ", "n", "e").alias("detail")
    )
    return Q.union_all(rules, grain, size)


@query(
    "dq12_panel_check",
    """SELECT unnest(['panel_rows', 'zero_sales_rows', 'zero_sales_share_pct', 'first_month', 'last_month']) AS metric,
              unnest([count(*), count(*) FILTER (units_sold = 0), round(100.0 * avg(CAST(units_sold = 0 AS INTEGER)), 2),
                      min(year(year_month) * 100 + month(year_month)), max(year(year_month) * 100 + month(year_month))])::DOUBLE AS value FROM t_panel""",
    rounded="value",
)
def panel_check(star):
    empty = F.col("units_sold") == 0
    return P.kpis(
        panel(star),
        {
            "panel_rows": F.count(F.lit(1)), "zero_sales_rows": F.count_if(empty),
            "zero_sales_share_pct": F.round(F.avg(empty.cast("int")) * 100, 2),
            "first_month": F.min(D.month_key("year_month")), "last_month": F.max(D.month_key("year_month")),
        },
    )


_COVERED = ("opening_stock_units", "actual_unit_cost_eur", "return_units", "crm_activity_count", "pipeline_opportunities", "campaign_flag", "market_demand_index")


@query(
    "dq13_enrichment_coverage",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", 100.0 * count({c}) / count(*) AS available_rows_pct,
            100.0 * count(*) FILTER ({c} <> 0) / count(*) AS non_zero_rows_pct FROM t_full"""
        for c in _COVERED
    ),
    rounded="available_rows_pct non_zero_rows_pct",
)
def enrichment_coverage(star):
    return P.coverage_report(labelled(star), _COVERED)


_BINARY = ("risk_factor_sales_drop", "risk_factor_customer_drop", "risk_factor_volatility", "stockout_flag", "campaign_flag", "demand_shock_flag")


@query("dq15_domains", _checks_sql("t_labelled", {c: f"{c} NOT IN (0, 1)" for c in (*_BINARY, "next_month_risk_label")}))
def domains(star):
    return Q.check_domain(labelled(star), [*_BINARY, TARGET], [0, 1])


@query("dq17_last_rows_unlabelled", 
    """SELECT 'last_rows_unlabelled' AS check_name, count(*) FILTER (last AND next_month_risk_label IS NOT NULL) = 0 AS passed,
              CAST(count(*) FILTER (last AND next_month_risk_label IS NOT NULL) AS VARCHAR) AS detail
       FROM (SELECT *, lead(year_month) OVER (PARTITION BY product_id, region_id ORDER BY year_month) IS NULL AS last FROM t_labelled)""",
)
def last_rows_unlabelled(star):
    return Q.check_last_unlabelled(labelled(star), ["product_id", "region_id"], "year_month", TARGET)


@query(
    "dq18_chronology",
    "\nUNION ALL ".join(
        f"""SELECT '{a}_before_{b}' AS check_name, max(target_month) FILTER (split = '{a}') < min(target_month) FILTER (split = '{b}') AS passed,
            max(target_month) FILTER (split = '{a}') || ' / ' || min(target_month) FILTER (split = '{b}') AS detail FROM t_split"""
        for a, b in (("train", "validation"), ("validation", "test"))
    ),
)
def chronology(star):
    return Q.check_chronology(split_features(star), "split", "target_month", ["train", "validation", "test"])


@query(
    "dq19_matrix_quality",
    f"""SELECT split, count(*) AS row_count, {len(NUMERIC)} AS feature_count, 0 AS duplicate_names,
              CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in NUMERIC)} AS BIGINT) AS missing_feature_values,
              CAST({' + '.join(f'count(*) FILTER (isinf({c}))' for c in NUMERIC)} AS BIGINT) AS infinite_feature_values,
              count(*) FILTER (next_month_risk_label IS NULL) AS missing_target_values
       FROM t_prep GROUP BY 1""",
)
def matrix_quality(star):
    return Q.matrix_quality(prepared(star), NUMERIC, "split", TARGET)


@query(
    "dq19_raw_feature_quality",
    f"""SELECT split, count(*) AS row_count, {len(NUMERIC)} AS feature_count, 0 AS duplicate_names,
              CAST({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in NUMERIC)} AS BIGINT) AS missing_feature_values,
              CAST(0 AS BIGINT) AS infinite_feature_values, count(*) FILTER (next_month_risk_label IS NULL) AS missing_target_values
       FROM t_split GROUP BY 1""",
)
def raw_feature_quality(star):
    return Q.matrix_quality(split_features(star), NUMERIC, "split", TARGET)


@query(
    "dq21_score_range",
    _checks_sql("t_pressure", {"commercial_pressure_score_in_range": "commercial_pressure_score NOT BETWEEN 0 AND 100"}),
)
def score_range(star):
    return Q.check_range(features(star), "commercial_pressure_score", 0, 100)


@query(
    "dq23_final_checks",
    """WITH c AS (SELECT 'probabilities' AS check_name, count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) = 0 AS passed,
                         CAST(count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) AS VARCHAR) AS detail FROM t_pred
                  UNION ALL SELECT 'units_below_200', count(*) FILTER (units_sold >= 200) = 0, CAST(count(*) FILTER (units_sold >= 200) AS VARCHAR) FROM t_panel)
       SELECT * FROM c UNION ALL SELECT 'all_checks', bool_and(passed), CAST(count(*) FILTER (NOT passed) AS VARCHAR) FROM c""",
)
def final_checks(star):
    off = F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-6
    return Q.roll_up(
        Q.check_none(predictions(star), {"probabilities": off}),
        Q.check_none(panel(star), {"units_below_200": F.col("units_sold") >= 200}),
    )


@query(
    "dq24_input_summary",
    """SELECT unnest(['row_count', 'missing_products', 'missing_regions', 'missing_months', 'labelled_rows', 'scoring_rows']) AS metric,
              unnest([count(*), count(*) FILTER (product_id IS NULL), count(*) FILTER (region_id IS NULL), count(*) FILTER (year_month IS NULL),
                      count(next_month_risk_label), count(*) FILTER (next_month_risk_label IS NULL)])::DOUBLE AS value FROM t_labelled""",
    rounded="value",
)
def input_summary(star):
    return P.kpis(
        labelled(star),
        {
            "row_count": F.count(F.lit(1)), "missing_products": F.count_if(F.col("product_id").isNull()),
            "missing_regions": F.count_if(F.col("region_id").isNull()), "missing_months": F.count_if(F.col("year_month").isNull()),
            "labelled_rows": F.count(TARGET), "scoring_rows": F.count_if(F.col(TARGET).isNull()),
        },
    )


@query("dq25_mandatory_lookup", "SELECT o_custkey AS customer_id, count(*) AS orders FROM orders GROUP BY 1")
def mandatory_lookup(star):
    orders = star.table("orders").select(F.col("o_custkey").alias("customer_id"))
    return require_match(orders, star.customers, "customer_id").groupBy("customer_id").agg(F.count(F.lit(1)).alias("orders"))
