"""Joins, set operations, ordering and calendar queries."""

from pyspark.sql import functions as F

from catalogue.base import labelled, panel, query, written
from riskloom.functions import dates as D
from riskloom.functions.scalars import map_values
from riskloom.operators import joins as J, sets as S
from riskloom.plans import calendar as cal
from riskloom.plans.market import group_grid, month_region_grid
from riskloom.plans.panel import active_panel, grid, supply_fields, zero_fill
from riskloom.plans.sales import launch_issue
from riskloom.sources.star import brand_number

KEYS = ["product_id", "region_id", "year_month"]


@query(
    "jn01_lookup",
    """SELECT transaction_id, units, product_id, product_line, product_category, lifecycle_stage
       FROM t_sales LEFT JOIN t_products USING (product_id)""",
    rounded="units",
)
def lookup(star):
    sales = star.raw_sales().select("transaction_id", "units", "product_id")
    return J.lookup(
        sales, star.products, "product_id", ["product_line", "product_category", "lifecycle_stage"], enforce=True
    )


@query(
    "jn01_salted_lookup",
    """SELECT transaction_id, units, region, currency FROM t_sales LEFT JOIN t_regions USING (region_id)""",
    rounded="units",
)
def salted_lookup(star):
    sales = star.raw_sales().select("transaction_id", "units", "region_id")
    return J.lookup(sales, star.regions, "region_id", ["region", "currency"], salt=8, salt_by=["transaction_id"]).drop("region_id")


@query(
    "jn02_one_to_one",
    """SELECT product_id, region_id, year_month, units_sold, opening_stock_units
       FROM t_panel LEFT JOIN t_inventory USING (product_id, region_id, year_month)""",
    rounded="units_sold opening_stock_units",
)
def one_to_one(star):
    stock = written(star).inventory().select(*KEYS, "opening_stock_units")
    return J.one_to_one(panel(star).select(*KEYS, "units_sold"), stock, KEYS, enforce=True)


@query(
    "jn03_row_count_invariance",
    """SELECT b AS rows_before, a AS rows_after, a = b AS passed
       FROM (SELECT count(*) AS b FROM lineitem), (SELECT count(*) AS a FROM t_sales s LEFT JOIN t_regions r ON s.region_id = r.region_id)""",
)
def row_count_invariance(star):
    sales = star.raw_sales()
    return J.join_growth(star.table("lineitem"), J.lookup(sales, star.regions, "region_id", ["region"]))


@query(
    "jn04_composite_key",
    """SELECT p.product_id, p.region_id, p.year_month, o.pipeline_opportunities
       FROM t_panel p LEFT JOIN t_opps_month o ON o.year_month = p.year_month AND o.region_id = p.region_id
         AND o.product_category = p.product_category""",
)
def composite_key(star):
    keys = ["year_month", "region_id", "product_category"]
    opps = star.sources(written(star).monthly_base)["opportunities"].select(*keys, "pipeline_opportunities")
    return J.lookup(panel(star).select(*KEYS, "product_category"), opps, keys).drop("product_category")


@query(
    "jn05_domain_grid",
    """SELECT product_category, region_id, year_month FROM (SELECT DISTINCT product_category FROM t_products)
       CROSS JOIN t_regions CROSS JOIN t_months""",
)
def domain_grid(star):
    return group_grid(cal.months(star.bounds), star.products, star.regions)


@query(
    "jn06_anti_join",
    """SELECT DISTINCT product_id, region_id, year_month FROM t_panel p WHERE NOT EXISTS (
         SELECT 1 FROM t_sales s WHERE s.product_id = p.product_id AND s.region_id = p.region_id AND s.year_month = p.year_month)""",
)
def anti_join(star):
    return J.missing_keys(panel(star), written(star).sales, KEYS)


@query(
    "jn07_orphans",
    """SELECT count(*) AS orphan_rows FROM orders WHERE o_orderkey % 11 <> 0
         AND CASE WHEN o_orderkey % 29 = 0 THEN -1 ELSE o_custkey END NOT IN (SELECT c_custkey FROM customer)""",
)
def orphan_count(star):
    k = F.col("o_orderkey")
    key = F.when(k % 11 != 0, F.when(k % 29 == 0, F.lit(-1)).otherwise(F.col("o_custkey")))
    facts = star.table("orders").select(key.alias("customer_id"))
    return J.orphans(facts, star.customers, "customer_id", nullable=True).agg(F.count(F.lit(1)).alias("orphan_rows"))


@query("jn08_region_fallback", "SELECT opportunity_id, customer_id, region_id FROM t_opps")
def region_fallback(star):
    return star.opportunities.select("opportunity_id", "customer_id", "region_id")


@query(
    "jn09_dictionary_lookup",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2 WHEN 'O' THEN 1 ELSE -1 END AS code FROM orders""",
)
def dictionary_lookup(star):
    return star.table("orders").select("o_orderkey", map_values("o_orderstatus", {"F": 2, "O": 1}, -1).alias("code"))


@query(
    "jn10_join_back",
    """SELECT transaction_id, units, 100 * units / sum(units) OVER (PARTITION BY product_id) AS pct,
              min(order_date) OVER (PARTITION BY product_id) AS first_sale FROM t_sales""",
    rounded="units pct",
)
def join_back(star):
    sales = star.raw_sales().select("transaction_id", "units", "product_id", "order_date")
    out = J.join_back(sales, ["product_id"], {"total": F.sum("units"), "first_sale": F.min("order_date")})
    return out.select("transaction_id", "units", (F.col("units") * 100 / F.col("total")).alias("pct"), "first_sale")


@query(
    "jn11_coverage",
    """SELECT count(*) AS row_count, count(*) FILTER (hit) AS matched_rows, 100.0 * avg(CAST(hit AS INTEGER)) AS coverage_pct
       FROM (SELECT EXISTS (SELECT 1 FROM (SELECT DISTINCT product_id, region_id, year_month FROM t_lines l,
               (SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS year_month, l_orderkey AS ok, l_linenumber AS ln,
                       l_partkey AS pk, l_suppkey AS sk, l_shipdate AS sd FROM lineitem WHERE l_returnflag = 'R') d
               WHERE d.ok = l.l_orderkey AND d.ln = l.l_linenumber AND d.pk = l.l_partkey AND d.sk = l.l_suppkey AND d.sd = l.l_shipdate
                 AND l.l_returnflag = 'R') r
             WHERE r.product_id = s.product_id AND r.region_id = s.region_id AND r.year_month = s.year_month) AS hit
             FROM (SELECT product_id, region_id, year_month FROM t_sales) s)""",
    rounded="coverage_pct",
)
def coverage(star):
    return J.coverage(written(star).sales, star.returns, KEYS)


@query(
    "jn11_unmatched_keys",
    """SELECT DISTINCT product_id, region_id, year_month FROM t_panel
       EXCEPT SELECT product_id, region_id, year_month FROM t_returns""",
)
def unmatched_keys(star):
    return J.missing_keys(panel(star), star.returns, KEYS)


@query(
    "jn12_return_to_sale",
    """SELECT r.l_orderkey AS return_id, r.l_linenumber, r.l_quantity AS return_units, CAST(o_orderdate AS DATE) AS sale_date,
              CAST(r.l_shipdate AS DATE) AS return_date, r.l_shipdate >= o_orderdate AS in_order
       FROM lineitem r JOIN orders ON r.l_orderkey = o_orderkey WHERE r.l_returnflag = 'R'""",
    rounded="return_units",
)
def return_to_sale(star):
    returned = star.table("lineitem").where("l_returnflag = 'R'").alias("returned")
    sold = star.table("orders").alias("sold")
    joined = returned.join(sold, F.col("returned.l_orderkey") == F.col("sold.o_orderkey"))
    sale, back = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return joined.select(
        F.col("l_orderkey").alias("return_id"), "l_linenumber", F.col("l_quantity").alias("return_units"),
        sale.alias("sale_date"), back.alias("return_date"), (back >= sale).alias("in_order"),
    )


@query(
    "jn13_market_grain",
    """SELECT p.product_id, p.region_id, p.year_month, g.market_demand_index, coalesce(g.market_signal_available_flag, 0) AS available
       FROM t_panel p LEFT JOIN t_signals g ON g.year_month = p.year_month AND g.product_line = p.product_line
         AND g.product_category = p.product_category AND g.region_id = p.region_id""",
    rounded="market_demand_index",
)
def market_grain(star):
    return labelled(star).select(*KEYS, "market_demand_index", F.col("market_signal_available_flag").alias("available"))


@query(
    "prj11_canonical_label",
    "SELECT o_orderkey, o_orderpriority AS label FROM orders",
)
def canonical_label(star):
    labels = star.table("orders").select(F.col("o_orderpriority").alias("label")).distinct()
    noisy = star.table("orders").select("o_orderkey", F.lower("o_orderpriority").alias("label"))
    return J.canonical_label(noisy, labels, "label").select("o_orderkey", "label")


@query(
    "prj11_collapsing_labels",
    """SELECT lower(p_name) AS label_key, count(DISTINCT n) AS spellings FROM (
         SELECT p_name, CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE upper(p_name) END AS n FROM part)
       GROUP BY 1 HAVING count(DISTINCT n) > 1""",
)
def collapsing_labels(star):
    names = star.table("part").select(
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(F.upper("p_name")).alias("label")
    )
    return J.collapsing_labels(names, "label")


@query(
    "prj11_unknown_labels",
    """SELECT lower(p_brand) AS label_key, count(*) AS row_count FROM part
       WHERE lower(p_brand) NOT IN (SELECT lower(p_brand) FROM part WHERE p_size <= 2) GROUP BY 1""",
)
def unknown_labels(star):
    part = star.table("part")
    return J.unknown_labels(part.select(F.upper("p_brand").alias("label")), part.where("p_size <= 2").select(F.col("p_brand").alias("label")), "label")


# --- set operations ----------------------------------------------------------

@query(
    "st01_union_all",
    """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS day, 'order' AS kind FROM orders
       UNION ALL SELECT user_id, CAST(ts AS DATE), 'event' FROM events""",
)
def union_all(star):
    a = star.table("orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("day"), F.lit("order").alias("kind")
    )
    b = star.table("events").select(
        F.col("user_id").alias("customer_id"), F.col("ts").cast("date").alias("day"), F.lit("event").alias("kind")
    )
    return S.union_all(a, b)


@query(
    "st02_union_distinct",
    "SELECT p_brand AS product_id FROM part UNION SELECT product_id FROM t_sales",
)
def union_distinct(star):
    return S.union_distinct(star.products.select("product_id"), star.raw_sales().select("product_id"))


@query(
    "st03_except",
    """SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS year_month FROM lineitem
       EXCEPT SELECT year_month FROM t_months""",
)
def except_months(star):
    shipped = star.table("lineitem").select(D.month_start(F.col("l_shipdate").cast("date")).alias("year_month"))
    return S.except_keys(shipped, cal.months(star.bounds))


@query(
    "st04_set_equal",
    """SELECT (SELECT count(*) FROM (SELECT product_id FROM t_sales EXCEPT SELECT product_id FROM t_products WHERE b % 5 > 0)) AS only_left,
              (SELECT count(*) FROM (SELECT product_id FROM t_products WHERE b % 5 > 0 EXCEPT SELECT product_id FROM t_sales)) AS only_right,
              FALSE AS passed""",
)
def set_equal(star):
    listed = star.products.where(brand_number("product_id") % 5 > 0).select("product_id")
    return S.set_equal(star.raw_sales().select("product_id"), listed)


@query(
    "st05_date_bounds",
    """SELECT least((SELECT min(o_orderdate) FROM orders), (SELECT min(l_shipdate) FROM lineitem))::DATE AS first_date,
              greatest((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem))::DATE AS last_date""",
)
def date_bounds(star):
    return S.date_bounds(
        (star.table("orders"), F.col("o_orderdate").cast("date")), (star.table("lineitem"), F.col("l_shipdate").cast("date"))
    )


# --- ordering ------------------------------------------------------------------

@query(
    "sl01_sorted",
    "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey",
    rounded="c_acctbal",
)
def sorted_customers(star):
    return S.sort_by(star.table("customer").select("c_custkey", "c_mktsegment", "c_acctbal"), "c_mktsegment", "-c_acctbal", "c_custkey")


@query(
    "sl02_top_n",
    """SELECT product_id, region_id, year_month, revenue FROM t_monthly ORDER BY round(revenue, 4) DESC, product_id, region_id, year_month
       LIMIT 25""",
    rounded="revenue",
)
def top_months(star):
    rows = panel(star).select(*KEYS, F.round("revenue", 4).alias("revenue"))
    return S.top_n(rows, ["-revenue", *KEYS], 25)


@query(
    "sl03_dominant_column",
    """SELECT l_orderkey, l_linenumber, l_quantity, CASE WHEN l_discount >= l_tax AND l_discount >= l_quantity / 500 THEN 'l_discount'
              WHEN l_tax >= l_quantity / 500 THEN 'l_tax' ELSE 'q' END AS winner FROM lineitem""",
    rounded="l_quantity",
)
def dominant_column(star):
    df = star.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", (F.col("l_quantity") / 500).alias("q")
    )
    return df.select("l_orderkey", "l_linenumber", "l_quantity", S.argmax_column(["l_discount", "l_tax", "q"]).alias("winner"))


@query(
    "sl04_best_row",
    """SELECT product_id, total_units, last_sale FROM (SELECT product_id, sum(units) AS total_units, max(order_date) AS last_sale
       FROM t_sales GROUP BY 1) ORDER BY total_units DESC, last_sale DESC, product_id LIMIT 1""",
    rounded="total_units",
)
def best_product(star):
    totals = star.raw_sales().groupBy("product_id").agg(F.sum("units").alias("total_units"), F.max("order_date").alias("last_sale"))
    return S.best_row(totals, ["-total_units", "-last_sale", "product_id"])


# --- calendar and panel ---------------------------------------------------------

@query(
    "cp01_calendar",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS "DateKey", d AS "Date", CAST(year(d) AS INTEGER) AS "Year",
              CAST(quarter(d) AS INTEGER) AS "Quarter", 'Q' || quarter(d) AS "QuarterName", CAST(month(d) AS INTEGER) AS "Month",
              monthname(d) AS "MonthName", left(monthname(d), 3) AS "MonthShortName", strftime(d, '%Y-%m') AS "YearMonth",
              CAST(strftime(d, '%Y%m') AS INTEGER) AS "YearMonthKey", CAST(date_trunc('month', d) AS DATE) AS "MonthStartDate",
              last_day(d) AS "MonthEndDate", CAST(day(d) AS INTEGER) AS "Day", CAST(dayofweek(d) + 1 AS INTEGER) AS "DayOfWeek",
              dayname(d) AS "DayName",
              CAST(1 + date_diff('day', y - CAST(dayofweek(y) AS INTEGER), d) // 7 AS INTEGER) AS "WeekOfYear",
              CAST(weekofyear(d) AS INTEGER) AS "ISOWeek", isodow(d) >= 6 AS "IsWeekend"
       FROM (SELECT d, make_date(CAST(year(d) AS INTEGER), 1, 1) AS y FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS d FROM orders))""",
)
def reporting_calendar(star):
    return cal.describe_days(cal.date_span(star.table("orders"), F.col("o_orderdate").cast("date")))


@query(
    "cp02_source_calendar",
    """SELECT DISTINCT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date, CAST(year(d) AS INTEGER) AS year,
              CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
              strftime(d, '%Y-%m') AS year_month, CAST(isodow(d) AS INTEGER) AS day_of_week,
              CAST(weekofyear(d) AS INTEGER) AS week_of_year, d = last_day(d) AS is_month_end,
              d = last_day(d) AND month(d) % 3 = 0 AS is_quarter_end
       FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)""",
)
def operational_calendar(star):
    return cal.source_calendar(star.table("lineitem").select(F.col("l_shipdate").cast("date").alias("d")))


@query("cp03_months", "SELECT year_month FROM t_months")
def month_list(star):
    return cal.months(star.bounds)


@query(
    "cp04_dense_panel",
    """SELECT product_id, region_id, year_month, region, product_line, product_category, observed_first_sale_date,
              effective_launch_date, units_sold, revenue, unique_customers, order_count, active_sales_reps, avg_discount_pct,
              covered_annual_quota_eur, enterprise_customer_count, no_sales_flag FROM t_panel""",
    rounded="units_sold revenue avg_discount_pct covered_annual_quota_eur",
)
def dense_panel(star):
    return written(star).panel().select(
        *KEYS, "region", "product_line", "product_category", "observed_first_sale_date", "effective_launch_date",
        "units_sold", "revenue", "unique_customers", "order_count", "active_sales_reps", "avg_discount_pct",
        "covered_annual_quota_eur", "enterprise_customer_count", "no_sales_flag",
    )


@query(
    "cp04_grid_from_configured_launch",
    """SELECT product_id, region_id, year_month FROM t_products CROSS JOIN t_regions CROSS JOIN t_months
       WHERE year_month >= launch_date""",
)
def configured_grid(star):
    return grid(star.products, star.regions.select("region_id"), star.bounds, "launch_date").select(*KEYS)


@query(
    "cp05_zero_fill",
    "SELECT product_id, region_id, year_month, units_sold, revenue, avg_discount_pct, no_sales_flag FROM t_panel WHERE units_sold = 0",
    rounded="units_sold revenue avg_discount_pct",
)
def zero_filled(star):
    cells = panel(star).select(*KEYS)
    monthly = written(star).monthly.select(*KEYS, "units_sold", "revenue", "avg_discount_pct")
    filled = zero_fill(cells.join(monthly, KEYS, "left"))
    return filled.withColumn("no_sales_flag", (F.col("units_sold") == 0).cast("int")).where("no_sales_flag = 1")


@query(
    "cp06_availability_flags",
    """SELECT product_id, region_id, year_month, inventory_available_flag, market_activity_available_flag,
              market_signal_available_flag FROM t_full""",
)
def availability_flags(star):
    return labelled(star).select(
        *KEYS, "inventory_available_flag", "market_activity_available_flag", "market_signal_available_flag"
    )


@query(
    "cp07_attach_calendar",
    """SELECT product_id, region_id, year_month, CAST(year(year_month) AS INTEGER) AS "Year",
              CAST(quarter(year_month) AS INTEGER) AS "Quarter", CAST(month(year_month) AS INTEGER) AS "Month",
              monthname(year_month) AS "MonthName", CAST(strftime(year_month, '%Y%m') AS INTEGER) AS "YearMonthKey" FROM t_panel""",
)
def attach_calendar(star):
    # the date table covers only the even order keys' dates, so some months use the fallback
    days = star.table("orders").where(F.month("o_orderdate") % 2 == 0).select(F.col("o_orderdate").cast("date").alias("d"))
    return cal.attach_calendar(panel(star).select(*KEYS), cal.describe_days(days))


@query(
    "cp08_active_panel",
    """SELECT year_month, product_id, region_id, launch AS effective_launch_month,
              CASE WHEN sold THEN 'sales' ELSE 'eligible' END AS source
       FROM (SELECT m.year_month, p.product_id, g.region_id, least(p.launch_date, f.first_month) AS launch,
                    s.product_id IS NOT NULL AS sold, m.year_month >= p.launch_date AS eligible
             FROM t_products p CROSS JOIN t_regions g CROSS JOIN t_months m
             LEFT JOIN (SELECT product_id, min(year_month) AS first_month FROM t_sales GROUP BY 1) f ON f.product_id = p.product_id
             LEFT JOIN (SELECT DISTINCT product_id, region_id, year_month FROM t_sales) s
               ON s.product_id = p.product_id AND s.region_id = g.region_id AND s.year_month = m.year_month)
       WHERE sold OR eligible""",
)
def active_cells(star):
    sales = written(star).sales
    launches = launch_issue(star.products, sales)
    eligible = grid(launches, star.regions.select("region_id"), star.bounds, "launch_date")
    return active_panel(eligible, sales, launches)


@query(
    "cp09_supply_fields",
    "SELECT product_id, region_id, year_month, backorder_units, supply_coverage_ratio, stockout_flag, zero_stock_flag FROM t_full",
    rounded="backorder_units supply_coverage_ratio",
)
def supply(star):
    stock = star.sources(written(star).monthly_base)["inventory"]
    joined = panel(star).select(*KEYS, "units_sold").join(stock, KEYS, "left")
    return supply_fields(joined).select(*KEYS, "backorder_units", "supply_coverage_ratio", "stockout_flag", "zero_stock_flag")


@query(
    "jn05_month_region_grid",
    "SELECT region_id, year_month FROM t_regions CROSS JOIN t_months",
)
def region_months(star):
    return month_region_grid(cal.months(star.bounds), star.regions)


