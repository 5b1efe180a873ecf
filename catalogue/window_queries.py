"""History windows, shares, ranks and de-duplication."""

from pyspark.sql import functions as F

from catalogue.base import features, labelled, panel, query
from riskloom.operators import ranks as R, windows as W
from riskloom.plans.features import market_changes

KEYS = ["product_id", "region_id", "year_month"]


@query(
    "wn01_lags",
    "SELECT product_id, region_id, year_month, units_lag_1m, units_lag_3m, revenue_lag_1m, customers_lag_1m FROM t_hist",
    rounded="units_lag_1m units_lag_3m revenue_lag_1m",
)
def lags(star):
    h = W.History()
    return panel(star).select(
        *KEYS, h.lag("units_sold").alias("units_lag_1m"), h.lag("units_sold", 3).alias("units_lag_3m"),
        h.lag("revenue").alias("revenue_lag_1m"), h.lag("unique_customers").alias("customers_lag_1m"),
    )


@query(
    "wn02_leads",
    """SELECT p.product_id, p.region_id, p.year_month, n.units_sold AS future_units, n.unique_customers AS future_customers,
              n.volatility_3m AS future_volatility, n.e AS future_expected_units, n.stockout_flag AS future_stockout
       FROM t_flags p LEFT JOIN t_flags n ON n.product_id = p.product_id AND n.region_id = p.region_id AND n.mi = p.mi + 1""",
    rounded="future_units future_volatility future_expected_units",
)
def leads(star):
    return labelled(star).select(
        *KEYS, "future_units", "future_customers", "future_volatility", "future_expected_units", "future_stockout"
    )


@query(
    "wn03_rolling_means",
    "SELECT product_id, region_id, year_month, rolling_units_mean_3m, rolling_units_mean_6m FROM t_hist",
    rounded="rolling_units_mean_3m rolling_units_mean_6m",
)
def rolling_means(star):
    h = W.History()
    return panel(star).select(
        *KEYS, h.rolling("units_sold", 3, 2).alias("rolling_units_mean_3m"), h.rolling("units_sold", 6, 3).alias("rolling_units_mean_6m")
    )


@query(
    "wn04_rolling_std",
    """SELECT product_id, region_id, year_month, rolling_units_std_3m, rolling_units_std_6m, rolling_revenue_std_3m FROM t_hist""",
    rounded="rolling_units_std_3m rolling_units_std_6m rolling_revenue_std_3m",
)
def rolling_std(star):
    h = W.History()
    return panel(star).select(
        *KEYS, h.rolling("units_sold", 3, 2, "std").alias("rolling_units_std_3m"),
        h.rolling("units_sold", 6, 3, "std").alias("rolling_units_std_6m"),
        h.rolling("revenue", 3, 2, "std").alias("rolling_revenue_std_3m"),
    )


@query(
    "wn05_rolling_sum",
    """SELECT p.product_id, p.region_id, p.year_month, sum(w.units_sold) AS s
       FROM t_panel p LEFT JOIN t_panel w ON w.product_id = p.product_id AND w.region_id = p.region_id
         AND w.mi BETWEEN p.mi - 3 AND p.mi - 1 GROUP BY 1, 2, 3""",
    rounded="s",
)
def rolling_sum(star):
    return panel(star).select(*KEYS, W.History().rolling("units_sold", 3, 1, "sum").alias("s"))


@query(
    "wn06_slopes",
    "SELECT product_id, region_id, year_month, trend_slope_3m, trend_slope_6m FROM t_hist",
    rounded="trend_slope_3m trend_slope_6m",
)
def slopes(star):
    h = W.History()
    return panel(star).select(
        *KEYS, h.slope("units_sold", 3).alias("trend_slope_3m"), h.slope("units_sold", 6).alias("trend_slope_6m")
    )


@query(
    "wn07_gapped_baseline",
    """SELECT p.product_id, p.region_id, p.year_month, CASE WHEN count(w.units_sold) >= 2 THEN avg(w.units_sold) END AS base
       FROM t_panel p LEFT JOIN t_panel w ON w.product_id = p.product_id AND w.region_id = p.region_id
         AND w.mi BETWEEN p.mi - 7 AND p.mi - 2 GROUP BY 1, 2, 3""",
    rounded="base",
)
def gapped_baseline(star):
    return panel(star).select(*KEYS, W.History().rolling("units_sold", 6, 2, gap=2).alias("base"))


@query(
    "wn08_growth",
    "SELECT product_id, region_id, year_month, mom_units_growth_pct, customer_count_growth_pct FROM t_flags",
    rounded="mom_units_growth_pct customer_count_growth_pct",
)
def growth(star):
    h = W.History()
    return panel(star).select(
        *KEYS, h.growth("units_sold").alias("mom_units_growth_pct"), h.growth("unique_customers").alias("customer_count_growth_pct")
    )


@query(
    "wn09_clipped_pct_change",
    """SELECT p.product_id, p.region_id, p.year_month,
              CAST(round_even(CAST(least(greatest(coalesce((p.units_sold - w.units_sold) / nullif(w.units_sold, 0) * 100, 0), -50), 50) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS pct
       FROM t_panel p LEFT JOIN t_panel w ON w.product_id = p.product_id AND w.region_id = p.region_id AND w.mi = p.mi - 1""",
    rounded="pct",
)
def clipped_pct_change(star):
    return panel(star).select(*KEYS, W.History().pct_change("units_sold").alias("pct"))


@query(
    "wn10_acceleration",
    """SELECT p.product_id, p.region_id, p.year_month, p.trend_slope_3m - w.trend_slope_3m AS acceleration
       FROM t_hist p LEFT JOIN t_hist w ON w.product_id = p.product_id AND w.region_id = p.region_id
         AND w.year_month = p.year_month - INTERVAL 1 MONTH""",
    rounded="acceleration",
)
def acceleration(star):
    return labelled(star).select(*KEYS, W.History().diff("trend_slope_3m").alias("acceleration"))


@query(
    "wn11_dense_rank",
    """SELECT product_id, region_id, year_month, dense_rank() OVER (PARTITION BY product_category, region_id, year_month
              ORDER BY units_sold DESC) AS r FROM t_panel""",
)
def dense_rank(star):
    by = ["product_category", "region_id", "year_month"]
    ranks = R.group_ranks(panel(star), by, "units_sold", descending=True)
    return panel(star).join(ranks, [*by, "units_sold"], "left").select(*KEYS, F.col("dense_rank").alias("r"))


@query(
    "wn12_average_rank_share",
    """SELECT p.event_id, (SELECT count(*) FILTER (e.value < p.value) + (count(*) FILTER (e.value = p.value) + 1) / 2.0 FROM events e
              WHERE e.event_type = p.event_type) / (SELECT count(*) FROM events e WHERE e.event_type = p.event_type) AS pct FROM events p""",
    rounded="pct",
)
def average_rank_share(star):
    events = star.table("events").select("event_id", "event_type", "value")
    ranks = R.group_ranks(events, ["event_type"], "value").select("event_type", "value", F.col("rank_share").alias("pct"))
    return events.join(ranks, ["event_type", "value"], "left").select("event_id", "pct")


@query(
    "wn13_index_to_mean",
    """SELECT product_id, region_id, year_month, CAST(round_even(CAST(least(greatest(coalesce(100.0 * order_count
              / nullif(avg(order_count) OVER (PARTITION BY year_month), 0), 0), 0), 250) AS DECIMAL(18, 9)), 2) AS DOUBLE) AS idx FROM t_panel""",
    rounded="idx",
)
def index_to_mean(star):
    return W.index_to_mean(panel(star).select(*KEYS, "order_count"), "order_count", ["year_month"], "idx", 250.0).drop("order_count")


@query(
    "wn14_last_rows",
    """SELECT product_id, region_id, max(year_month) AS year_month FROM t_panel GROUP BY 1, 2""",
)
def last_rows(star):
    marked = panel(star).select(*KEYS, W.History().is_last().alias("is_last"))
    return marked.where("is_last").drop("is_last")


@query(
    "wn15_keep_one",
    """SELECT o_custkey, max(o_orderdate)::DATE AS last_day, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order
       FROM orders GROUP BY 1""",
)
def keep_last_order(star):
    orders = star.table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("last_day"), F.col("o_orderkey").alias("last_order"))
    return W.keep_one(orders, ["o_custkey"], [F.col("last_day"), F.col("last_order")], last=True)


@query(
    "wn16_group_share",
    """SELECT product_id, region_id, year_month, revenue / nullif(sum(revenue) OVER (PARTITION BY product_category, region_id, year_month), 0)
              AS share FROM t_panel""",
    rounded="share",
)
def group_share(star):
    base = panel(star).select(*KEYS, "product_category", "revenue")
    return W.share_of_group(base, "revenue", ["product_category", "region_id", "year_month"], "share").select(*KEYS, "share")


_CHANGE = "(s.{0} - w.{0}) / nullif(w.{0}, 0)"


@query(
    "wn17_market_grain_change",
    f"""SELECT p.product_id, p.region_id, p.year_month, {_CHANGE.format('market_demand_index')} AS market_demand_change_pct
        FROM t_panel p
        LEFT JOIN t_signals s ON s.year_month = p.year_month AND s.product_line = p.product_line
          AND s.product_category = p.product_category AND s.region_id = p.region_id
        LEFT JOIN t_signals w ON w.year_month = p.year_month - INTERVAL 1 MONTH AND w.product_line = p.product_line
          AND w.product_category = p.product_category AND w.region_id = p.region_id""",
    rounded="market_demand_change_pct",
)
def market_grain_change(star):
    return market_changes(labelled(star)).select(*KEYS, "market_demand_change_pct")


@query(
    "wn18_minmax_log",
    """SELECT p_partkey, (ln(1 + p_retailprice) - (SELECT min(ln(1 + p_retailprice)) FROM part))
              / greatest((SELECT max(ln(1 + p_retailprice)) - min(ln(1 + p_retailprice)) FROM part), 1e-9) AS price_score FROM part""",
    rounded="price_score",
)
def minmax_log(star):
    return W.minmax_log(star.table("part").select("p_partkey", "p_retailprice"), "p_retailprice", "price_score").drop("p_retailprice")


@query(
    "wn19_global_row_number",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_number FROM orders""",
)
def global_row_number(star):
    orders = star.table("orders").select("o_orderkey", "o_totalprice")
    return R.numbered(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "row_number")


@query(
    "wn20_volatility",
    """SELECT product_id, region_id, year_month, rolling_units_std_3m / nullif(rolling_units_mean_3m, 0) AS volatility_3m,
              rolling_units_std_6m / nullif(rolling_units_mean_6m, 0) AS rolling_units_cv_6m,
              rolling_revenue_std_3m / nullif(rolling_revenue_mean_3m, 0) AS revenue_volatility_3m FROM t_hist""",
    rounded="volatility_3m rolling_units_cv_6m revenue_volatility_3m",
)
def volatility(star):
    return features(star).select(*KEYS, "volatility_3m", "rolling_units_cv_6m", "revenue_volatility_3m")


