"""Projections, cleaning, predicates and scalar functions."""

from pyspark.sql import functions as F

from catalogue.base import labelled, panel, query, written
from riskloom import functions as fx
from riskloom.plans import sales as sl
from riskloom.plans.calendar import months
from riskloom.plans.features import scoring_rows as split_rows
from riskloom.plans.panel import after_launch, within
from riskloom.sources.staging import stage, stage_opportunities
from riskloom.sources.tables import (
    bad_values,
    numeric_or_default,
    require_parsed,
    select_existing,
)


def _orders_raw(star):
    """Orders as untyped text, with blanks and float-like ids."""
    k = F.col("o_orderkey")
    day = F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd")
    return star.table("orders").select(
        F.concat(F.lit(" "), k.cast("string"), F.when(k % 2 == 0, ".0").otherwise(" ")).alias("raw_id"),
        F.when(k % 5 == 0, "nan").when(k % 5 == 1, "None").otherwise(k.cast("string")).alias("gappy_id"),
        F.when(k % 4 == 0, F.substring(day, 1, 7)).when(k % 4 == 1, F.regexp_replace(day, "-", ""))
        .when(k % 4 == 2, "not a date").otherwise(day).alias("raw_day"),
        F.when(k % 3 == 0, F.concat(F.substring(day, 1, 4), F.substring(day, 6, 2)))
        .when(k % 3 == 1, F.substring(day, 1, 7)).otherwise(day).alias("raw_month"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("   x ")).alias("raw_label"),
        F.when(k % 3 == 0, " TRUE").when(k % 3 == 1, "yes ").otherwise("no").alias("raw_flag"),
        k.alias("k"),
        F.col("o_totalprice").alias("price"),
        "o_orderdate",
    )


_RAW = """
SELECT ' ' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE ' ' END AS raw_id, o_orderkey AS k,
       CASE o_orderkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'None' ELSE CAST(o_orderkey AS VARCHAR) END AS gappy_id,
       o_totalprice AS price, o_orderdate, o_orderpriority FROM orders
"""


@query(
    "prj01_staging_projection",
    """SELECT CAST(o_orderkey AS BIGINT) AS opportunity_id, CAST(o_orderdate AS DATE) AS created_date,
              CAST(o_custkey AS INTEGER) AS customer_id, o_orderpriority AS product_group,
              CASE WHEN o_orderkey % 3 = 0 THEN 'Closed Won' ELSE 'Closed Lost' END AS stage,
              CAST(o_totalprice AS DECIMAL(18,2)) AS expected_value_eur,
              CAST(o_orderdate AS DATE) + 30 AS expected_close_date, 30 AS days_to_close,
              CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS is_closed_won,
              CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE 1 END AS is_closed_lost FROM orders""",
    rounded="expected_value_eur",
)
def staging_projection(star):
    day = F.col("o_orderdate").cast("date")
    raw = star.table("orders").select(
        F.col("o_orderkey").cast("string").alias("opportunity_id"),
        day.cast("string").alias("created_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" ")).alias("product_group"),
        F.when(F.col("o_orderkey") % 3 == 0, " Closed Won ").otherwise("closed lost ").alias("stage"),
        F.format_string("%.2f", "o_totalprice").alias("expected_value_eur"),
        F.date_add(day, 30).cast("string").alias("expected_close_date"),
    )
    staged = stage_opportunities(raw)
    return staged.withColumn("stage", F.initcap("stage"))


@query(
    "prj02_trim_and_upper",
    """SELECT s_suppkey AS sales_rep_id, upper(s_name) AS sales_rep_code, 'Senior' AS seniority,
              CAST(s_acctbal AS DECIMAL(18,2)) AS annual_quota_eur FROM supplier""",
    rounded="annual_quota_eur",
)
def trim_and_upper(star):
    raw = star.table("supplier").select(
        F.col("s_suppkey").alias("sales_rep_id"),
        F.concat(F.lit(" "), F.lower("s_name"), F.lit("  ")).alias("sales_rep_code"),
        F.lit("  Senior ").alias("seniority"),
        F.col("s_acctbal").alias("annual_quota_eur"),
    )
    return stage(
        raw, {"sales_rep_id": "bigint", "sales_rep_code": "upper", "seniority": "text", "annual_quota_eur": "decimal(18,2)"}
    )


@query("prj03_strict_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders")
def strict_date(star):
    raw = star.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("date"))
    return stage(raw, {"o_orderkey": "bigint", "order_date<date": "strict_date"})


@query(
    "prj04_normalize_id",
    f"""SELECT k, CAST(k AS VARCHAR) AS id, CASE WHEN k % 5 > 1 THEN CAST(k AS VARCHAR) END AS gappy
        FROM ({_RAW})""",
)
def normalise_id(star):
    return _orders_raw(star).select("k", fx.normalize_id("raw_id").alias("id"), fx.normalize_id("gappy_id").alias("gappy"))


@query(
    "prj05_to_month",
    """SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 2 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS m
       FROM orders""",
)
def to_month(star):
    return _orders_raw(star).select("k", fx.to_month("raw_day").alias("m"))


@query("prj06_year_month_text", "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def year_month_text(star):
    df = _orders_raw(star)
    return require_parsed(df, "raw_month", fx.year_month_text("raw_month"), "year_month").select("k", "year_month")


@query(
    "prj06_bad_month_values",
    "SELECT DISTINCT 'not a date' AS value FROM orders WHERE o_orderkey % 4 = 2",
)
def bad_month_values(star):
    return bad_values(_orders_raw(star), "raw_day", fx.year_month_text("raw_day"))


@query(
    "prj07_lenient_number",
    """SELECT o_orderkey AS k, o_totalprice AS price_number, CASE WHEN o_orderkey % 5 > 1 THEN CAST(o_orderkey AS DOUBLE) END
       AS id_number, 7.0::DOUBLE AS absent FROM orders""",
    rounded="price_number id_number absent",
)
def lenient_number(star):
    df = _orders_raw(star)
    return df.select(
        "k", numeric_or_default(df, "price").alias("price_number"), numeric_or_default(df, "gappy_id").alias("id_number"),
        numeric_or_default(df, "nowhere", 7.0).alias("absent"),
    )


@query(
    "prj08_parse_number",
    """SELECT o_orderkey AS k, o_totalprice AS european, o_totalprice AS international, o_totalprice AS comma_only,
              o_orderkey % 100 / 100.0 AS share, NULL::DOUBLE AS unreadable FROM orders""",
    rounded="european international comma_only share unreadable",
)
def parse_number(star):
    plain = F.format_string("%.2f", "o_totalprice")
    grouped = F.format_number("o_totalprice", 2)
    swapped = F.translate(grouped, ".,", ",.")
    return star.table("orders").select(
        F.col("o_orderkey").alias("k"),
        fx.parse_number(F.concat(F.lit("€ "), swapped)).alias("european"),
        fx.parse_number(F.concat(F.lit("$"), grouped)).alias("international"),
        fx.parse_number(F.translate(plain, ".", ",")).alias("comma_only"),
        fx.parse_number(F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit(" %")), percent=True).alias("share"),
        fx.parse_number(F.lit("n/a")).alias("unreadable"),
    )


@query("prj09_integer_key", "SELECT o_orderkey AS k, o_custkey AS customer_key FROM orders")
def integer_key(star):
    df = star.table("orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").cast("string").alias("raw_key"))
    return require_parsed(df, "raw_key", F.col("raw_key").try_cast("bigint"), "customer_key").drop("raw_key")


@query("prj10_normalize_label", "SELECT o_orderkey AS k, o_orderpriority || ' x' AS label FROM orders")
def normalise_label(star):
    return _orders_raw(star).select("k", fx.normalize_label("raw_label").alias("label"))


@query("prj12_parse_bool", "SELECT o_orderkey AS k, o_orderkey % 3 < 2 AS is_set FROM orders")
def parse_bool(star):
    return _orders_raw(star).select("k", fx.parse_bool("raw_flag").alias("is_set"))


@query(
    "prj13_unknown_label",
    "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 5 = 0 THEN 'Unknown' ELSE o_orderpriority END AS label FROM orders",
)
def unknown_label(star):
    gap = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    return star.table("orders").select(F.col("o_orderkey").alias("k"), fx.unknown_if_null(gap).alias("label"))


@query("prj14_select_existing", "SELECT c_custkey AS customer_id, c_mktsegment AS customer_segment FROM customer")
def existing_columns(star):
    renamed = star.table("customer").withColumnsRenamed({"c_custkey": "customer_id", "c_mktsegment": "customer_segment"})
    return select_existing(renamed, ["customer_id", "industry", "customer_segment", "customer_code"])


@query(
    "prj15_finite",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_orderkey % 7 > 2 THEN l_extendedprice END AS price
       FROM lineitem""",
    rounded="l_quantity price",
)
def finite(star):
    k = F.col("l_orderkey") % 7
    noisy = (
        F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).when(k == 2, F.lit(float("-inf")))
        .otherwise(F.col("l_extendedprice"))
    )
    return star.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", fx.finite(noisy).alias("price"))


@query(
    "prj16_launch_from_year",
    "SELECT product_id, CASE WHEN b % 6 > 0 THEN make_date(1995 + b % 4, 1, 1) END AS launch FROM t_products",
)
def launch_from_year(star):
    b = F.substring("product_id", 7, 10).cast("int")
    year = F.when(b % 6 == 0, "unknown").otherwise((b % 4 + 1995).cast("string"))
    return star.products.select("product_id", fx.launch_from_year(year).alias("launch"))


@query("prj17_month_text", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS year_month FROM orders")
def month_text(star):
    return star.table("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("year_month"))


@query(
    "prj18_flags",
    """SELECT sales_rep_id, transaction_id, CAST(missing_sales_rep_flag AS INTEGER) AS missing_sales_rep_flag,
              missing_discount_flag, missing_margin_flag, units FROM t_sales""",
    rounded="units",
)
def missing_flags(star):
    return sl.sales_measures(star.raw_sales()).select(
        "sales_rep_id", "transaction_id", "missing_sales_rep_flag", "missing_discount_flag", "missing_margin_flag", "units"
    )


@query(
    "prj18_zero_stock_flag",
    "SELECT product_id, region_id, year_month, ending_stock_units, zero_stock_flag FROM t_inventory",
    rounded="ending_stock_units",
)
def zero_stock_flag(star):
    raw = written(star).inventory().select(
        "product_id", "region_id", "year_month", F.col("ending_stock_units").cast("string").alias("ending_stock_units")
    )
    staged = stage(raw, {"product_id": "text", "region_id": "int", "year_month": "date", "ending_stock_units": "double"})
    return staged.withColumn("zero_stock_flag", fx.flag(F.col("ending_stock_units") <= 0))


@query(
    "prj19_bands",
    """SELECT c_custkey AS k, CASE WHEN c_custkey % 20 >= 12 THEN 'High Churn Risk' WHEN c_custkey % 20 >= 7
              THEN 'Medium Churn Risk' ELSE 'Low Churn Risk' END AS churn,
              CASE WHEN c_custkey % 13 = 0 THEN 'At Risk' WHEN c_custkey % 101 >= 75 THEN 'Healthy'
                   WHEN c_custkey % 101 >= 50 THEN 'Neutral' ELSE 'At Risk' END AS health FROM customer""",
)
def bands(star):
    k = F.col("c_custkey")
    health = F.when(k % 13 != 0, k % 101)
    return star.table("customer").select(
        k.alias("k"), fx.band(k % 20 / 100.0, *sl.CHURN_BANDS).alias("churn"), fx.band(health, *sl.HEALTH_BANDS).alias("health")
    )


@query(
    "prj19_sales_bands",
    "SELECT transaction_id, units, gross_margin_pct, margin_category, order_size_category FROM t_sales",
    rounded="units gross_margin_pct",
)
def sales_bands(star):
    return sl.sales_measures(star.raw_sales()).select(
        "transaction_id", "units", "gross_margin_pct", "margin_category", "order_size_category"
    )


@query(
    "prj20_sales_measures",
    "SELECT transaction_id, units, cogs_eur, discount_value_eur FROM t_sales",
    rounded="units cogs_eur discount_value_eur",
)
def sales_measures(star):
    return sl.sales_measures(star.raw_sales()).select("transaction_id", "units", "cogs_eur", "discount_value_eur")


@query(
    "prj21_forecast_error",
    """SELECT o_orderkey, o_totalprice * 0.1 AS forecast_error_eur,
              CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_totalprice * 0.1 / (o_totalprice * 0.9) END AS forecast_error_pct
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN o_totalprice * 10 ELSE o_totalprice END AS o_totalprice
             FROM orders)""",
    rounded="forecast_error_eur forecast_error_pct",
)
def forecast_error(star):
    zero = F.col("o_orderkey") % 9 == 0
    df = star.table("orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("forecast_revenue_eur"),
        F.when(zero, 0.0).otherwise(F.col("o_totalprice") * 0.9).alias("actual_revenue_eur"),
    )
    return sl.forecast_error(df).select("o_orderkey", "forecast_error_eur", "forecast_error_pct")


@query(
    "prj22_cost_variance",
    "SELECT product_id, year_month, cost_variance_eur, cost_variance_pct FROM t_costs",
    rounded="cost_variance_eur cost_variance_pct",
)
def cost_variance(star):
    return written(star).costs().select("product_id", "year_month", "cost_variance_eur", "cost_variance_pct")


@query(
    "prj23_days_to_close",
    "SELECT opportunity_id, expected_close_date, CAST(days_to_close AS INTEGER) AS days_to_close FROM t_opps",
)
def days_to_close(star):
    return star.opportunities.select("opportunity_id", "expected_close_date", "days_to_close")


@query(
    "prj24_commercial_measures",
    """SELECT transaction_id, units, units * asp_eur AS revenue_eur, units * asp_eur - units * unit_cost_eur AS gross_profit_eur,
              (units * asp_eur - units * unit_cost_eur) / nullif(units * asp_eur, 0) AS gross_margin_pct,
              units * asp_eur / fx_to_eur AS revenue_local_currency
       FROM t_sales JOIN t_regions USING (region_id)""",
    rounded="units revenue_eur gross_profit_eur gross_margin_pct revenue_local_currency", digits=4,
)
def commercial_measures(star):
    base = star.raw_sales().join(star.regions.select("region_id", "fx_to_eur"), "region_id")
    return sl.commercial_measures(base).select(
        "transaction_id", "units", "revenue_eur", "gross_profit_eur", "gross_margin_pct", "revenue_local_currency"
    )


@query(
    "prj24_weighted_and_returned_value",
    """SELECT transaction_id, units, revenue_eur * floor(units / 2) / units AS returned_value,
              CASE transaction_id % 3 WHEN 0 THEN revenue_eur * 0.45 WHEN 1 THEN revenue_eur ELSE 0 END AS weighted
       FROM t_sales""",
    rounded="units returned_value weighted",
)
def weighted_and_returned_value(star):
    k = F.col("transaction_id") % 3
    df = star.raw_sales().withColumns(
        {
            "return_units": F.floor(F.col("units") / 2),
            "stage": F.when(k == 0, "Proposal").when(k == 1, "Closed Won").otherwise("Closed Lost"),
        }
    )
    return df.select(
        "transaction_id", "units", sl.prorated_return_value().alias("returned_value"),
        sl.weighted_value("stage", "revenue_eur").alias("weighted"),
    )


@query(
    "prj25_stock_flow",
    "SELECT product_id, region_id, year_month, ending_stock_units, stockout AS stockout_flag FROM t_inventory",
    rounded="ending_stock_units",
)
def stock_flow(star):
    return written(star).inventory().select("product_id", "region_id", "year_month", "ending_stock_units", "stockout_flag")


@query(
    "prj26_effective_start",
    """SELECT customer_id, min(order_date) AS observed_first_customer_sale,
              least(min(order_date), any_value(customer_since)) AS effective_customer_since
       FROM t_sales JOIN (SELECT customer_id, customer_since FROM t_customers) USING (customer_id) GROUP BY 1""",
)
def effective_start(star):
    return sl.customer_starts(star.customers, star.raw_sales()).select(
        "customer_id", "observed_first_customer_sale", "effective_customer_since"
    )


@query(
    "prj27_date_keys",
    """SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key,
              CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS month_key FROM orders""",
)
def date_keys(star):
    return star.table("orders").select(
        "o_orderkey", fx.date_key("o_orderdate").alias("date_key"), fx.month_key("o_orderdate").alias("month_key")
    )


# --- filters ---------------------------------------------------------------

def _gappy_sales(star):
    k = F.col("transaction_id")
    return star.raw_sales().select(
        "transaction_id",
        F.when(k % 19 != 0, F.col("product_id")).alias("product_id"),
        "region_id",
        F.when(k % 23 != 0, F.col("year_month")).alias("year_month"),
        F.col("units").alias("units_sold"),
        F.col("revenue_eur").alias("revenue"),
    )


@query(
    "flt01_rejected_sales",
    """SELECT transaction_id, units AS units_sold, product_id, year_month FROM (
         SELECT transaction_id, units, CASE WHEN transaction_id % 19 <> 0 THEN product_id END AS product_id,
                CASE WHEN transaction_id % 23 <> 0 THEN year_month END AS year_month FROM t_sales)
       WHERE product_id IS NULL OR year_month IS NULL""",
    rounded="units_sold",
)
def rejected_sales(star):
    _, rejected = sl.split_valid(_gappy_sales(star))
    return rejected.select("transaction_id", "units_sold", "product_id", "year_month")


@query(
    "flt01_valid_sales",
    """SELECT product_id, count(*) AS row_count FROM t_sales
       WHERE transaction_id % 19 <> 0 AND transaction_id % 23 <> 0 GROUP BY 1""",
)
def valid_sales(star):
    valid, _ = sl.split_valid(_gappy_sales(star))
    return valid.groupBy("product_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "flt02_within_horizon",
    """SELECT return_id, year_month FROM (SELECT l_orderkey AS return_id,
              CAST(date_trunc('month', l_shipdate) AS DATE) AS year_month FROM lineitem WHERE l_returnflag = 'R')
       WHERE year_month IN (SELECT year_month FROM t_months)""",
)
def within_horizon(star):
    returned = star.table("lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("return_id"), fx.month_start(F.col("l_shipdate").cast("date")).alias("year_month")
    )
    return within(returned, months(star.bounds)).select("return_id", "year_month")


@query(
    "flt03_after_launch",
    """SELECT product_id, region_id, year_month, units_sold FROM t_panel
       WHERE year_month >= date_trunc('month', launch_date)""",
    rounded="units_sold",
)
def after_configured_launch(star):
    return after_launch(panel(star), "launch_date").select("product_id", "region_id", "year_month", "units_sold")


@query(
    "flt04_drop_missing",
    "SELECT transaction_id, sales_rep_id, discount_pct FROM t_sales WHERE sales_rep_id IS NOT NULL AND discount_pct IS NOT NULL",
    rounded="discount_pct",
)
def drop_missing(star):
    return star.raw_sales().dropna(subset=["sales_rep_id", "discount_pct"]).select(
        "transaction_id", "sales_rep_id", "discount_pct"
    )


@query(
    "flt05_guarded_flag",
    "SELECT product_id, region_id, year_month, risk_factor_volatility FROM t_flags",
)
def guarded_flag(star):
    return labelled(star).select(
        "product_id", "region_id", "year_month", fx.flag(F.round("volatility_3m", 9) > 0.45).alias("risk_factor_volatility")
    )


@query(
    "flt06_null_keeping_flag",
    """SELECT product_id, region_id, year_month, CASE WHEN volatility_3m IS NULL OR avg_discount_pct IS NULL THEN NULL
              WHEN volatility_3m > 0.3 AND avg_discount_pct > 0.05123 THEN 1 ELSE 0 END AS f FROM t_flags""",
)
def null_keeping_flag(star):
    v, d = F.col("volatility_3m"), F.col("avg_discount_pct")
    return labelled(star).select(
        "product_id", "region_id", "year_month", fx.flag_or_null((v > 0.3) & (d > 0.05123), v, d).alias("f")
    )


@query(
    "flt07_contains_any",
    """SELECT activity_id, CASE WHEN activity_type IN ('Product Demo', 'Site Visit', 'Meeting') THEN 1 ELSE 0 END AS demo_like
       FROM t_crm""",
)
def contains_any(star):
    return star.crm.select("activity_id", fx.contains_any("activity_type", "demo|visit|meeting|presentation").alias("demo_like"))


@query(
    "flt08_closed_range",
    "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount BETWEEN 0.02 AND 0.07",
    rounded="l_discount",
)
def closed_range(star):
    return star.table("lineitem").where(fx.in_range("l_discount", 0.02, 0.07)).select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "flt09_scoring_rows",
    "SELECT product_id, region_id, year_month FROM t_labelled WHERE next_month_risk_label IS NULL",
)
def scoring_rows(star):
    _, waiting = split_rows(labelled(star))
    return waiting.select("product_id", "region_id", "year_month")


# --- scalar functions ------------------------------------------------------

@query(
    "fn01_safe_divide",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / nullif(l_orderkey % 4, 0) AS q FROM lineitem""",
    rounded="l_quantity q",
)
def safe_divide(star):
    return star.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", fx.safe_divide("l_extendedprice", F.col("l_orderkey") % 4).alias("q")
    )


@query(
    "fn02_clip",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 6 > 0 THEN least(greatest(l_quantity, 10), 40) END AS q,
              CASE WHEN l_orderkey % 6 > 0 THEN greatest(l_quantity, 25) END AS lo FROM lineitem""",
    rounded="q lo",
)
def clip(star):
    v = F.when(F.col("l_orderkey") % 6 > 0, F.col("l_quantity"))
    return star.table("lineitem").select(
        "l_orderkey", "l_linenumber", fx.clip(v, 10.0, 40.0).alias("q"), fx.clip(v, 25.0).alias("lo")
    )


@query(
    "fn03_row_sum_min",
    """SELECT transaction_id, units, coalesce(discount_pct, 0) + units AS s, least(discount_pct, units) AS m FROM t_sales""",
    rounded="units s m",
)
def row_sum_min(star):
    return star.raw_sales().select(
        "transaction_id", "units", fx.row_sum(["discount_pct", "units"]).alias("s"), fx.row_min(["discount_pct", "units"]).alias("m")
    )


@query(
    "fn04_select_case",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 'big' WHEN l_discount > 0.05 THEN 'cheap' ELSE 'plain' END
       AS kind FROM lineitem""",
)
def select_case(star):
    kind = fx.select_case([F.col("l_quantity") > 40, F.col("l_discount") > 0.05], [F.lit("big"), F.lit("cheap")], F.lit("plain"))
    return star.table("lineitem").select("l_orderkey", "l_linenumber", kind.alias("kind"))


@query(
    "fn05_numeric",
    """SELECT o_orderkey, ln(1 + o_totalprice) AS lg, pow(1.03, o_orderkey % 20) AS growth,
              round_even(o_orderkey % 100 / 8.0, 2) AS half_even FROM orders""",
    rounded="lg growth half_even",
)
def numeric_functions(star):
    return star.table("orders").select(
        "o_orderkey", F.log1p("o_totalprice").alias("lg"), F.pow(F.lit(1.03), F.col("o_orderkey") % 20).alias("growth"),
        F.bround(F.col("o_orderkey") % 100 / 8.0, 2).alias("half_even"),
    )


@query(
    "fn06_close_to",
    """SELECT l_orderkey, l_linenumber, abs(l_tax - l_discount) <= 0.015 AS near FROM lineitem""",
)
def close_to(star):
    return star.table("lineitem").select("l_orderkey", "l_linenumber", fx.close_to("l_tax", "l_discount", 0.015).alias("near"))


@query(
    "fn07_text",
    """SELECT c_custkey, trim(c_name) AS t, regexp_replace(c_name, '#0*', '-') AS r, lower(c_mktsegment) AS l,
              contains(c_name, '99') AS has, lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS padded,
              concat('C', c_custkey) AS joined, left(c_mktsegment, 3) AS head FROM customer""",
)
def text_functions(star):
    k = F.col("c_custkey")
    return star.table("customer").select(
        k, F.trim("c_name").alias("t"), F.regexp_replace("c_name", "#0*", "-").alias("r"), F.lower("c_mktsegment").alias("l"),
        F.contains("c_name", F.lit("99")).alias("has"), F.lpad(k.cast("string"), 8, "0").alias("padded"),
        F.concat(F.lit("C"), k.cast("string")).alias("joined"), F.left("c_mktsegment", F.lit(3)).alias("head"),
    )


@query(
    "fn08_date_parts",
    """SELECT o_orderkey, CAST(year(d) AS INTEGER) AS y, CAST(quarter(d) AS INTEGER) AS q, CAST(month(d) AS INTEGER) AS m,
              CAST(day(d) AS INTEGER) AS dd, monthname(d) AS mn, dayname(d) AS wd, CAST(date_trunc('month', d) AS DATE) AS ms,
              last_day(d) AS me, CAST(weekofyear(d) AS INTEGER) AS iso
       FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def date_parts(star):
    d = F.col("o_orderdate").cast("date")
    return star.table("orders").select(
        "o_orderkey", F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.dayofmonth(d).alias("dd"),
        F.date_format(d, "MMMM").alias("mn"), F.date_format(d, "EEEE").alias("wd"), fx.month_start(d).alias("ms"),
        F.last_day(d).alias("me"), F.weekofyear(d).alias("iso"),
    )


@query(
    "fn09_us_week",
    """SELECT o_orderkey, CAST(1 + date_diff('day', y - CAST(dayofweek(y) AS INTEGER), d) // 7 AS INTEGER) AS w FROM (
         SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS y FROM orders)""",
)
def us_week(star):
    return star.table("orders").select("o_orderkey", fx.us_week(F.col("o_orderdate").cast("date")).alias("w"))


@query(
    "fn10_weekdays",
    """SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS sun1, CAST(isodow(o_orderdate) AS INTEGER) AS mon1
       FROM orders""",
)
def weekdays(star):
    return star.table("orders").select(
        "o_orderkey", fx.dow_sun1("o_orderdate").alias("sun1"), fx.dow_mon1("o_orderdate").alias("mon1")
    )


@query(
    "fn11_period_ends",
    """SELECT o_orderkey, d = last_day(d) AS month_end, d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS quarter_end,
              isodow(d) >= 6 AS weekend FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def period_ends(star):
    d = F.col("o_orderdate").cast("date")
    return star.table("orders").select(
        "o_orderkey", fx.is_month_end(d).alias("month_end"), fx.is_quarter_end(d).alias("quarter_end"), fx.is_weekend(d).alias("weekend")
    )


@query(
    "fn12_months_between",
    """SELECT o_orderkey, CAST(date_diff('month', DATE '1997-05-20', o_orderdate) AS INTEGER) AS gap,
              CAST(greatest(date_diff('month', DATE '1997-05-20', o_orderdate), 0) AS INTEGER) AS age FROM orders""",
)
def months_between(star):
    day = F.lit("1997-05-20").cast("date")
    return star.table("orders").select(
        "o_orderkey", fx.months_diff("o_orderdate", day).alias("gap"), fx.months_diff("o_orderdate", day, floor=0).alias("age")
    )


@query(
    "fn13_next_month",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS nm FROM orders",
)
def next_month(star):
    return star.table("orders").select("o_orderkey", fx.next_month("o_orderdate").alias("nm"))


@query(
    "fn14_bool_to_int",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity >= 48 AS INTEGER) AS outlier FROM lineitem",
)
def bool_to_int(star):
    return star.table("lineitem").select("l_orderkey", "l_linenumber", fx.as_int(F.col("l_quantity") >= 48).alias("outlier"))
