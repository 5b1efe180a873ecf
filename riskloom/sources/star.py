"""Sales star model over an order-and-lineitem schema.

Maps parquet tables region, nation, customer, supplier, part, orders, lineitem
and events to the model's dimensions and facts. A brand is a product and the
customer's region is the sales region. Attributes the source tables lack are
derived from their keys by fixed rules.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions import dates as D
from riskloom.functions.scalars import band, flag, safe_divide, select_case
from riskloom.operators.joins import region_with_fallback
from riskloom.plans.market import opportunity_score, seasonality_index
from riskloom.plans.monthly import (
    PANEL_KEYS,
    SIGNAL_KEYS,
    cost_monthly,
    crm_region_month,
    customer_mix,
    customer_product_monthly,
    inventory_monthly,
    market_activity_monthly,
    market_signals_monthly,
    opportunity_monthly,
    returns_monthly,
    sales_by_panel_key,
)
from riskloom.plans.panel import attach_sources, build_panel
from riskloom.plans.sales import CHURN_BANDS, cost_variance, product_starts, sales_measures, stock_flow, weighted_value
from riskloom.plans.history import labelled_panel
from riskloom.plans.features import add_side_tables, derived_features, side_tables
from riskloom.session import materialize, materialize_all

ENTERPRISE = "BUILDING"
DISTRIBUTOR = "MACHINERY"


def brand_number(c: str = "p_brand") -> Column:
    return F.substring(F.col(c), 7, 10).cast("int")


def _cycle(number: Column, *labels: str) -> Column:
    """Label by ``number`` modulo the number of labels."""
    n = len(labels)
    return select_case([number % n == i for i in range(n - 1)], [F.lit(x) for x in labels[:-1]], F.lit(labels[-1]))


class Star:
    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    # --- dimensions ---------------------------------------------------------

    @cached_property
    def regions(self) -> DataFrame:
        key = F.col("r_regionkey")
        even = key % 2 == 0
        return self.table("region").select(
            key.alias("region_id"),
            F.col("r_name").alias("region"),
            F.when(even, "EUR").otherwise("USD").alias("currency"),
            F.when(even, 1.0).otherwise(0.9).alias("fx_to_eur"),
            (1 + key / 20.0).alias("market_growth_factor"),
            (1 - key / 50.0).alias("margin_factor"),
        )

    @cached_property
    def products(self) -> DataFrame:
        brands = self.table("part").groupBy(F.col("p_brand").alias("product_id")).agg(
            F.min("p_retailprice").alias("base_list_price_eur")
        )
        b = brand_number("product_id")
        stage = _cycle(b, "New", "Growth", "Mature", "Decline")
        return brands.select(
            "product_id",
            F.concat(F.lit("Line "), b % 2).alias("product_line"),
            F.concat(F.lit("Category "), b % 5).alias("product_category"),
            F.concat(F.lit("SKU-"), b).alias("sku"),
            stage.alias("lifecycle_stage"),
            F.make_date(b % 4 + 1995, F.lit(1), F.lit(1)).alias("launch_date"),
            "base_list_price_eur",
            (F.col("base_list_price_eur") * 0.5).alias("base_unit_cost_eur"),
            ((b % 5 * 2 + 25) / 100.0).alias("target_margin_pct"),
            ((b + 90) / 100.0).alias("product_growth_factor"),
            flag(stage == "Decline").alias("is_declining_product"),
            flag(stage == "New").alias("is_new_product"),
        )

    @cached_property
    def nation_regions(self) -> DataFrame:
        return self.table("nation").select("n_nationkey", F.col("n_regionkey").alias("region_id"))

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        churn = key % 20 / 100.0
        located = self.table("customer").join(
            self.nation_regions, F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        return located.select(
            key.alias("customer_id"),
            F.col("c_mktsegment").alias("customer_segment"),
            "region_id",
            F.make_date((key % 3 + 1995).cast("int"), (key % 12 + 1).cast("int"), F.lit(1)).alias("customer_since"),
            F.col("c_acctbal").alias("customer_size_score"),
            churn.alias("base_churn_probability"),
            band(churn, *CHURN_BANDS).alias("churn_risk_band"),
        )

    @cached_property
    def reps(self) -> DataFrame:
        located = self.table("supplier").join(
            self.nation_regions, F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        return located.select(
            F.col("s_suppkey").alias("sales_rep_id"),
            "region_id",
            _cycle(F.col("s_suppkey"), "Junior", "Professional", "Senior").alias("seniority"),
            F.col("s_acctbal").alias("annual_quota_eur"),
        )

    # --- sales ----------------------------------------------------------------

    @cached_property
    def rep_levels(self) -> DataFrame:
        """One row per representative: seniorities of all its rows, so that looking them up keeps the line count."""
        known = self.reps.where(F.col("sales_rep_id").isNotNull())
        return known.groupBy("sales_rep_id").agg(F.collect_list(F.coalesce("seniority", F.lit("Unknown"))).alias("rep_levels"))

    def order_lines(self) -> DataFrame:
        """Line items with brand, order date, customer, region and representative.

        Orders meet their customers first, so the fact side is shuffled once per
        large table; columns are pruned in every scan. Lines meet the
        representatives first, while they are narrow, and leave in the order of
        their order keys. Measures are left to the readers.
        """
        buyers = self.customers.select(
            "customer_id", "region_id", "customer_segment", "customer_size_score",
            "base_churn_probability", "churn_risk_band",
        )
        orders = self.table("orders").select(
            "o_orderkey", F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").cast("date").alias("order_date")
        ).join(buyers, "customer_id")
        brands = self.table("part").select("p_partkey", F.col("p_brand").alias("product_id"))
        returned = F.col("l_returnflag") == "R"
        lines = self.table("lineitem").select(
            "l_orderkey", "l_partkey", F.when(F.col("l_suppkey") % 17 != 0, F.col("l_suppkey")).alias("sales_rep_id"),
            "l_quantity", "l_extendedprice", "l_discount", returned.alias("returned"),
            F.when(returned, F.col("l_shipdate").cast("date")).alias("return_date"),
        )
        return (
            lines.join(self.rep_levels, "sales_rep_id", "left")
            .join(brands, F.col("l_partkey") == F.col("p_partkey"))
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .drop("l_partkey", "p_partkey", "o_orderkey")
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines that sales and returns are read from."""
        return self.order_lines()

    def raw_sales(self) -> DataFrame:
        """Order lines under the sales model's names, before staging measures."""
        price, units = F.col("l_extendedprice"), F.col("l_quantity")
        revenue = price * (1 - F.col("l_discount"))
        profit = revenue - price * 0.7
        return self.lines.select(
            "sales_rep_id",
            F.col("l_orderkey").alias("transaction_id"),
            "order_date",
            D.month_start("order_date").alias("year_month"),
            "customer_id",
            "product_id",
            "region_id",
            units.alias("units"),
            safe_divide(price, units).alias("asp_eur"),
            F.when(F.col("l_orderkey") % 13 != 0, F.col("l_discount")).alias("discount_pct"),
            revenue.alias("revenue_eur"),
            safe_divide(price * 0.7, units).alias("unit_cost_eur"),
            profit.alias("gross_profit_eur"),
            safe_divide(profit, revenue).alias("gross_margin_pct"),
            (units >= 48).alias("is_outlier_order"),
            "customer_segment",
            "churn_risk_band",
            "customer_size_score",
            "base_churn_probability",
            "rep_levels",
        )

    @cached_property
    def sales(self) -> DataFrame:
        """Canonical sales with measures and representative seniority, one row per line and matching representative."""
        measured = sales_measures(self.raw_sales())
        return (
            measured.select(*[c for c in measured.columns if c != "rep_levels"], F.explode_outer("rep_levels").alias("seniority"))
            .withColumns(
                {
                    "seniority": F.coalesce("seniority", F.lit("Unknown")),
                    "units_sold": F.col("units"),
                    "revenue": F.col("revenue_eur"),
                    "avg_discount_pct": F.col("discount_pct"),
                }
            )
        )

    @cached_property
    def bounds(self) -> DataFrame:
        """First and last order date; a one-column scan."""
        d = F.col("o_orderdate").cast("date")
        return self.table("orders").agg(F.min(d).alias("first_date"), F.max(d).alias("last_date"))

    @cached_property
    def returns(self) -> DataFrame:
        return self.lines.where("returned").select(
            F.col("l_orderkey").alias("return_id"),
            F.col("l_orderkey").alias("sales_id"),
            "return_date",
            D.month_start("return_date").alias("year_month"),
            "product_id",
            "region_id",
            F.col("l_quantity").alias("return_units"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("return_value_eur"),
        )

    # --- activity from orders ---------------------------------------------------

    def _order_activity(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
            F.col("o_orderdate").cast("date").alias("day"),
            D.month_start(F.col("o_orderdate").cast("date")).alias("year_month"),
            F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey")).alias("customer_id"),
            (F.col("o_orderkey") % 10).alias("sales_rep_id"),
        )

    @cached_property
    def opportunities(self) -> DataFrame:
        key = F.col("o_orderkey")
        stage = select_case(
            [F.col("o_orderstatus") == "F", F.col("o_orderstatus") == "P"],
            [F.lit("Closed Won"), F.lit("Closed Lost")],
            _cycle(key, "Lead", "Qualified", "Proposal", "Negotiation"),
        )
        shaped = self._order_activity().select(
            key.alias("opportunity_id"),
            F.col("day").alias("created_date"),
            "year_month",
            "customer_id",
            "sales_rep_id",
            F.concat(F.lit("Category "), key % 5).alias("product_category"),
            stage.alias("stage"),
            F.col("o_totalprice").alias("expected_value_eur"),
            F.date_add("day", (key % 200 + 20).cast("int")).alias("expected_close_date"),
        ).withColumns(
            {
                "win_probability": weighted_value("stage", "expected_value_eur") / F.col("expected_value_eur"),
                "weighted_pipeline_eur": weighted_value(),
                "days_to_close": F.datediff("expected_close_date", "created_date"),
                "is_closed_won": flag(F.col("stage") == "Closed Won"),
                "is_closed_lost": flag(F.col("stage") == "Closed Lost"),
            }
        )
        return region_with_fallback(shaped, self.customers, self.reps)

    @cached_property
    def crm(self) -> DataFrame:
        key = F.col("o_orderkey")
        kinds = {
            "1-URGENT": "Product Demo", "2-HIGH": "Site Visit", "3-MEDIUM": "Email",
            "4-NOT SPECIFIED": "Call", "5-LOW": "Meeting",
        }
        priority = F.col("o_orderpriority")
        shaped = self._order_activity().select(
            key.alias("activity_id"),
            F.col("day").alias("activity_date"),
            "year_month",
            "customer_id",
            "sales_rep_id",
            select_case([priority == k for k in kinds], [F.lit(v) for v in kinds.values()], F.lit(None)).alias("activity_type"),
            (key % 50 + 10).alias("activity_minutes"),
            ((key % 201 - 100) / 100.0).alias("sentiment_score"),
            (key % 101).cast("double").alias("customer_health_score"),
        )
        return region_with_fallback(shaped, self.customers, self.reps)

    @cached_property
    def event_activity(self) -> DataFrame:
        """Event stream as daily regional activity."""
        return self.table("events").select(
            F.col("event_id").alias("activity_id"),
            F.col("ts").cast("date").alias("day"),
            (F.col("user_id") % 5).alias("region_id"),
            F.col("event_type").alias("activity_type"),
            F.lit(1).alias("activity_minutes"),
            (F.col("value") / 100.0).alias("sentiment_score"),
            F.col("value").alias("customer_health_score"),
        )

    # --- monthly sources derived from sales ----------------------------------------

    @cached_property
    def monthly_base(self) -> DataFrame:
        """Units, orders and cost per panel key; money is rounded to its stored precision.

        Orders are counted apart from the sums, so that an order travels as its key only.
        """
        groups = self.sales.groupBy(*PANEL_KEYS)
        sums = groups.agg(F.sum("units").alias("units"), F.round(F.sum("cogs_eur"), 4).alias("cogs"))
        orders = groups.agg(F.count_distinct("transaction_id").alias("orders")).select(
            *[F.col(k).alias(f"_{k}") for k in PANEL_KEYS], "orders"
        )
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in PANEL_KEYS]
        return sums.join(orders, same).select(*PANEL_KEYS, "units", "orders", "cogs")

    def inventory(self, base: DataFrame | None = None) -> DataFrame:
        base = base if base is not None else self.monthly_base
        k = (brand_number("product_id") * 31 + F.col("region_id") * 7 + D.month_index("year_month")) % 40
        flows = stock_flow(
            base.withColumns(
                {
                    "opening_stock_units": F.floor(F.col("units") * 0.6 + k).cast("double"),
                    "production_units": F.floor(F.col("units") * 0.5).cast("double"),
                    "actual_units": F.col("units"),
                }
            )
        )
        return flows.select(
            *PANEL_KEYS, "opening_stock_units", "production_units", "ending_stock_units", "stockout_flag",
            (F.col("ending_stock_units") * 10).alias("inventory_value_eur"),
            flag(F.col("ending_stock_units") <= 0).alias("zero_stock_flag"),
        )

    def costs(self, base: DataFrame | None = None) -> DataFrame:
        base = base if base is not None else self.monthly_base
        actual = base.groupBy("product_id", "year_month").agg(
            safe_divide(F.round(F.sum("cogs"), 4), F.sum("units")).alias("actual_unit_cost_eur")
        )
        standard = self.products.select("product_id", F.col("base_unit_cost_eur").alias("standard_unit_cost_eur"))
        return cost_variance(actual.join(standard, "product_id", "left"))

    def market_activity(self, base: DataFrame | None = None) -> DataFrame:
        base = base if base is not None else self.monthly_base
        b, units, orders = brand_number("product_id"), F.col("units"), F.col("orders")
        on = flag((b + F.col("region_id") * 2 + D.month_index("year_month")) % 3 == 0)
        channel = _cycle(b + F.col("region_id"), "Search", "Social", "Email")
        demos = F.floor(units / 10)
        return base.select(
            *PANEL_KEYS,
            on.alias("campaign_flag"),
            F.when(on == 1, channel).otherwise("No campaign").alias("campaign_channel"),
            (on * (units * 1.5 + 10)).alias("campaign_spend_eur"),
            (on * units * 20).alias("campaign_impressions"),
            (on * units).alias("campaign_clicks"),
            (units * 3 + orders).alias("website_visits"),
            (units * 6 + orders * 2).alias("product_page_views"),
            demos.cast("double").alias("demo_requests"),
            (demos + orders).cast("double").alias("marketing_qualified_leads"),
            (orders * 25).cast("double").alias("regional_crm_activity_index"),
            (orders * 10).cast("double").alias("pipeline_interest_index"),
        )

    def market_signals(self, base: DataFrame | None = None) -> DataFrame:
        base = base if base is not None else self.monthly_base
        lines = self.products.select("product_id", "product_line", "product_category")
        u = F.col("u")
        grouped = base.join(lines, "product_id").groupBy(*SIGNAL_KEYS).agg(F.sum("units").cast("long").alias("u"))
        shaped = grouped.select(
            *SIGNAL_KEYS,
            (u % 90 + 60).cast("double").alias("market_demand_index"),
            ((u % 41 - 20) / 10.0).alias("market_growth_pct"),
            (u * 7 % 60 + 30).cast("double").alias("competitor_pressure_index"),
            seasonality_index(F.month("year_month")).alias("seasonality_index"),
            (D.month_index("year_month") % 21 + 90).cast("double").alias("macro_business_index"),
            (u * 3 % 75 + 20).cast("double").alias("supply_pressure_index"),
            (u * 11 % 150).cast("double").alias("pipeline_interest_index"),
            flag(u % 29 == 0).alias("demand_shock_flag"),
            (1 + F.col("region_id") / 20.0).alias("regional_market_growth_factor"),
        )
        return shaped.withColumn("market_opportunity_score", opportunity_score())

    # --- composed stages --------------------------------------------------------------

    @cached_property
    def starts(self) -> DataFrame:
        return product_starts(self.products, self.sales)

    @cached_property
    def monthly(self) -> DataFrame:
        orders = self.monthly_base.select(*PANEL_KEYS, F.col("orders").alias("order_count"))
        return sales_by_panel_key(self.sales, self.reps, ENTERPRISE, [orders])

    def panel(self, monthly: DataFrame | None = None) -> DataFrame:
        """Dense panel with sales attached."""
        return build_panel(
            self.products, self.starts, self.regions.select("region_id", "region"), self.bounds,
            monthly if monthly is not None else self.monthly,
        )

    def sources(self, base: DataFrame | None = None) -> dict[str, DataFrame]:
        return {
            "inventory": inventory_monthly(self.inventory(base)),
            "costs": cost_monthly(self.costs(base)),
            "returns": returns_monthly(self.returns),
            "activity": market_activity_monthly(self.market_activity(base)),
            "crm": crm_region_month(self.crm),
            "opportunities": opportunity_monthly(self.opportunities),
            "signals": market_signals_monthly(self.market_signals(base)),
        }

    def written(self, keep: Callable[[DataFrame, str], DataFrame] = materialize) -> "Star":
        """Same model with the representatives, the order lines and the monthly base written by ``keep`` when first read.

        The five-table join is then paid for once instead of by every aggregate
        that reads sales or returns; measures are computed from the narrow lines
        as they are read. The representatives' exact size lets Spark choose how
        to join them.
        """
        return _WrittenStar(self, keep)

    def labelled(self, base: DataFrame | None = None) -> DataFrame:
        """Panel with every source, history features and the next-month label."""
        return labelled_panel(attach_sources(self.panel(), self.sources(base)))

    def features(self, panel: DataFrame | None = None, cpm: DataFrame | None = None) -> DataFrame:
        """Full feature table of a star whose sales are written (see ``written``).

        The panel, the monthly sources and the side tables are written first:
        they are far smaller than the facts, are read more than once, and give
        the wide plan exact sizes to choose its joins from. The wide rows are
        then exchanged twice, for the panel-key joins and the history windows.
        """
        cpm = cpm if cpm is not None else customer_product_monthly(self.sales)
        inputs = {**self.sources(self.monthly_base), "mix": customer_mix(cpm, DISTRIBUTOR)}
        if panel is None:
            inputs["panel"] = self.panel()
        tables = materialize_all(inputs)
        panel = panel if panel is not None else tables["panel"]
        side = materialize_all(side_tables(panel, tables["signals"]))
        wide = add_side_tables(attach_sources(panel, tables), {**side, "mix": tables["mix"]})
        return derived_features(labelled_panel(wide))


class _WrittenStar(Star):
    def __init__(self, star: Star, keep: Callable[[DataFrame, str], DataFrame]):
        super().__init__(star.spark, star.directory)
        self._keep = keep

    @cached_property
    def reps(self) -> DataFrame:
        return self._keep(super().reps, "reps")

    @cached_property
    def rep_levels(self) -> DataFrame:
        return self._keep(super().rep_levels, "rep-levels")

    @cached_property
    def lines(self) -> DataFrame:
        return self._keep(super().lines, "lines")

    @cached_property
    def monthly_base(self) -> DataFrame:
        return self._keep(super().monthly_base, "monthly-base")
