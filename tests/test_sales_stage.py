"""What the stages under the feature table write and exchange, on rows of its own."""

import tempfile
from datetime import datetime

import pytest

from riskloom.plans import monthly as mo
from riskloom.session import dealt
from riskloom.sources.star import Star

TABLES = {
    "region": ("r_regionkey long, r_name string", [(0, "R0"), (1, "R1")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey long", [(0, "N0", 0), (1, "N1", 1)]),
    "customer": (
        "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        [(1, "a", 0, 5.0, "BUILDING"), (2, "b", 1, 7.0, "MACHINERY")],
    ),
    # representative 3 comes twice, 17 is never looked up, 9 is unknown
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(3, "x", 0, 10.0), (3, "y", 1, 20.0), (4, "z", 1, 40.0)]),
    "part": ("p_partkey long, p_brand string, p_retailprice double", [(1, "Brand#11", 9.0), (2, "Brand#12", 8.0)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        [(1, 1, "F", 100.0, datetime(1996, 1, 5), "5-LOW"), (2, 2, "O", 50.0, datetime(1996, 1, 9), "1-URGENT")],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [
            (1, 1, 3, 1, 2.0, 20.0, 0.1, 0.0, "R", "F", datetime(1996, 2, 1)), (1, 1, 4, 2, 3.0, 30.0, 0.0, 0.0, "N", "F", datetime(1996, 2, 2)),
            (2, 2, 17, 1, 4.0, 40.0, 0.0, 0.0, "R", "F", None), (2, 2, 9, 2, 5.0, 50.0, 0.0, 0.0, None, "F", datetime(1996, 2, 3)),
        ],
    ),
}


@pytest.fixture(scope="module")
def small(spark):
    folder = tempfile.mkdtemp(prefix="riskloom-test-")
    for name, (columns, rows) in TABLES.items():
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return Star(spark, folder)


def _plan(df):
    """Physical plan without adaptive execution's later changes."""
    conf = df.sparkSession.conf
    previous = conf.get("spark.sql.adaptive.enabled")
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.adaptive.enabled", previous)


def test_sales_and_returns_read_one_written_table(small):
    w = small.written()
    for df in (w.sales, w.returns):
        assert "Join" not in _plan(df) and len(df.inputFiles()) > 0
        assert all("/lines-" in f for f in df.inputFiles())
    assert not {"cogs_eur", "margin_category", "revenue", "units_sold"} & set(w.lines.columns)


@pytest.mark.parametrize("written", [False, True])
def test_a_repeated_representative_repeats_sales_but_not_returns(small, written):
    s = small.written() if written else small
    got = sorted((r.transaction_id, r.sales_rep_id or 0, r.seniority, r.units) for r in s.sales.collect())
    level = {r.sales_rep_id: r.seniority for r in small.reps.collect()}
    assert got == [(1, 3, level[3], 2.0), (1, 3, level[3], 2.0), (1, 4, level[4], 3.0), (2, 0, "Unknown", 4.0), (2, 9, "Unknown", 5.0)]
    back = sorted((r.return_id, str(r.return_date), r.return_units) for r in s.returns.collect())
    assert back == [(1, "1996-02-01", 2.0), (2, "None", 4.0)]
    base = {r.product_id: (r.units, r.orders) for r in s.monthly_base.collect()}
    assert base == {"Brand#11": (7.0, 1), "Brand#12": (9.0, 1)}
    monthly = {r.product_id: r for r in s.monthly.collect()}
    assert (monthly["Brand#11"].active_sales_reps, monthly["Brand#11"].covered_annual_quota_eur) == (2, 70.0)
    assert (monthly["Brand#12"].active_sales_reps, monthly["Brand#12"].order_count, monthly["Brand#12"].unique_customers) == (1, 1, 1)


def test_panel_sales_agree_with_the_functions_alone(small):
    keys = mo.PANEL_KEYS
    sales, reps = small.sales, small.reps
    joined = (
        mo.monthly_sales(sales).join(mo.customer_month_features(sales, "BUILDING"), keys, "left").join(mo.quota_month(sales, reps), keys, "left")
    )
    together = mo.sales_by_panel_key(sales, reps, "BUILDING")
    assert together.columns == joined.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, joined.collect()))


def test_distinct_counts_repeat_no_rows(small):
    assert "Expand" not in _plan(mo.monthly_sales(small.written().sales))


def test_customer_months_exchange_rows_once(small):
    assert _plan(mo.customer_product_monthly(small.written().sales)).count("Exchange ") == 1


def test_dealt_grows_with_the_input(spark):
    few = spark.range(10).selectExpr("id", "id % 3 AS k")
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert dealt(few, "k").rdd.getNumPartitions() <= usual
    many = spark.range(usual * (4 << 20) // 16 * 2).selectExpr("id", "id % 3 AS k")
    assert dealt(many, "k").rdd.getNumPartitions() > usual
    assert dealt(many, "k", most=1).rdd.getNumPartitions() <= usual
    assert sorted(map(tuple, dealt(few, "k").collect())) == [(i, i % 3) for i in range(10)]
