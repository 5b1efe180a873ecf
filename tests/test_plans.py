from datetime import date

import pytest
from pyspark.sql import functions as F

from riskloom.operators.profiles import reconcile
from riskloom.plans import features as fe, history as H, learning as L, metrics as M, panel as PN, sales as SL
from riskloom.plans.forest import fit_one_forest, path_contributions


@pytest.fixture(scope="module")
def panel(star):
    from riskloom.session import materialize

    return materialize(star.panel(), "test-panel")


def test_panel_is_dense_and_reconciles(star, panel):
    keys = ["product_id", "region_id", "year_month"]
    assert panel.select(*keys).distinct().count() == panel.count()
    spans = panel.groupBy("product_id", "region_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("year_month").alias("lo"), F.max("year_month").alias("hi")
    ).collect()
    for r in spans:
        assert r.n == (r.hi.year - r.lo.year) * 12 + r.hi.month - r.lo.month + 1
    assert all(r.passed for r in reconcile(star.sales, panel, ["units_sold", "revenue", "gross_profit_eur"]).collect())


def test_grid_starts_at_launch(spark):
    products = spark.createDataFrame([("a", date(2024, 3, 15)), ("b", date(2020, 1, 1)), ("c", date(2025, 1, 1)), ("d", None)], "product_id string, effective_launch_date date")
    regions = spark.createDataFrame([(1,), (2,)], "region_id int")
    bounds = spark.createDataFrame([(date(2024, 2, 10), date(2024, 4, 2))], "first_date date, last_date date")
    got = sorted({(r.product_id, r.year_month.month) for r in PN.grid(products, regions, bounds).collect()})
    assert got == [("a", 3), ("a", 4), ("b", 2), ("b", 3), ("b", 4), ("d", 2), ("d", 3), ("d", 4)]
    assert PN.grid(products, regions, bounds).count() == 16


def test_labels(panel):
    labelled = H.labelled_panel(panel.withColumn("stockout_flag", F.lit(0)))
    last = labelled.groupBy("product_id", "region_id").agg(F.max_by(H.TARGET, "year_month").alias("y"))
    assert last.where("y IS NOT NULL").count() == 0
    odd = labelled.where(
        f"{H.TARGET} IS NOT NULL AND {H.TARGET} != CASE WHEN target_risk_score >= 3 THEN 2 WHEN target_risk_score >= 1 THEN 1 ELSE 0 END"
    )
    assert odd.count() == 0
    relabelled = H.risk_label(
        labelled.drop(H.TARGET, "target_risk_score", "target_month").withColumn("_is_last", F.lit(False)), medium_min=2
    )
    assert relabelled.where(f"target_risk_score = 1 AND {H.TARGET} != 0").count() == 0


def test_split_valid_and_effective_start(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "x string, y int")
    ok, rejected = SL.split_valid(df, ["x", "y"])
    assert (ok.count(), rejected.count()) == (1, 2)
    dim = spark.createDataFrame([(1, date(2024, 5, 1)), (2, None)], "k int, configured date")
    facts = spark.createDataFrame([(1, date(2024, 3, 9)), (1, date(2024, 8, 1)), (2, date(2024, 2, 2))], "k int, d date")
    got = {r.k: r.effective for r in SL.effective_start(dim, facts, "k", "configured", "d", "seen", "effective").collect()}
    assert got == {1: date(2024, 3, 9), 2: date(2024, 2, 2)}


def test_supply_fields_need_known_inventory(spark):
    df = spark.createDataFrame(
        [(10.0, 3.0, 2.0, 1), (10.0, None, None, None), (0.0, 5.0, 1.0, 0)],
        "units_sold double, opening_stock_units double, production_units double, stockout_flag int",
    ).withColumn("zero_stock_flag", F.lit(None).cast("int"))
    got = [tuple(r) for r in PN.supply_fields(df).select("inventory_available_flag", "backorder_units", "supply_coverage_ratio", "stockout_flag").collect()]
    assert got == [(1, 5.0, 0.5, 1), (0, 0.0, 0.0, 0), (1, 0.0, None, 0)]


def test_scores_saturate_and_keep_nulls(spark):
    row = dict(stockout_flag=1, zero_stock_flag=1, backorder_rate=3.0, supply_pressure_index=500.0)
    df = spark.createDataFrame([row, {k: None for k in row}], "stockout_flag int, zero_stock_flag int, backorder_rate double, supply_pressure_index double")
    assert [r.supply_pressure_score for r in fe.supply_pressure_score(df).collect()] == [100.0, 10.0]


def test_published_counts_give_published_metrics(spark):
    # 699 of 771 high-risk rows found among 1,646 alerts in 20,000 rows
    cells = M.counts_frame(spark, {"c22": 699, "c20": 72, "c02": 947, "c00": 18282})
    row = cells.select(*[c.alias(n) for n, c in M.summary_columns().items()]).first()
    assert row.high_risk_precision == pytest.approx(0.4247, abs=5e-5)
    assert row.high_risk_recall == pytest.approx(0.9066, abs=5e-5)
    assert row.high_risk_f1 == pytest.approx(0.5784, abs=5e-5)
    assert row.high_risk_f2 == pytest.approx(0.7389, abs=5e-5)
    assert row.high_risk_alert_rate == pytest.approx(0.0823, abs=5e-5)
    assert row.false_alarm_rate == pytest.approx(0.0492, abs=5e-5)
    lo, hi = M.wilson(F.lit(699), F.lit(771))
    assert spark.range(1).select(lo, hi).first() == pytest.approx((0.8840, 0.9252), abs=5e-5)
    lo, hi = M.wilson(F.lit(699), F.lit(1646))
    assert spark.range(1).select(lo, hi).first() == pytest.approx((0.4010, 0.4487), abs=5e-5)


def test_ranking_metrics_by_brute_force(spark):
    import random

    rnd = random.Random(11)
    rows = []
    for _ in range(400):
        y = rnd.choice([0, 1, 2])
        a, b = rnd.randint(0, 10), rnd.randint(0, 10)
        p2, p1 = a / 25, b / 25
        rows.append((y, p2, p1, 1 - p1 - p2))
    df = spark.createDataFrame(rows, "actual_label int, p2 double, p1 double, p0 double")
    auc = {r.label: r.roc_auc for r in M.roc_auc(df).collect()}
    ap = {r.label: r.average_precision for r in M.avg_precision(df).collect()}
    for k, i in ((1, 2), (2, 1)):
        pos = [r[i] for r in rows if r[0] == k]
        neg = [r[i] for r in rows if r[0] != k]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert auc[k] == pytest.approx(wins / len(pos) / len(neg))
        total, seen, hits = 0.0, 0, 0
        for t in sorted({r[i] for r in rows}, reverse=True):
            h = sum(1 for p in pos if p == t)
            seen += h + sum(1 for n in neg if n == t)
            hits += h
            total += h / len(pos) * hits / seen
        assert ap[k] == pytest.approx(total)


def test_time_split_and_preparation(spark):
    rows = [(m, i % 3, float(i) if i % 4 else None, "x" if i % 5 else None) for m in range(20) for i in range(6)]
    df = spark.createDataFrame(rows, "m int, y int, v double, c string").withColumn(
        "target_month", F.add_months(F.lit("2020-01-01").cast("date"), F.col("m"))
    ).withColumn(H.TARGET, F.when(F.col("m") < 19, F.col("y")))
    split = L.time_split(df)
    got = {r.split: r.n for r in split.groupBy("split").agg(F.count_distinct("m").alias("n")).collect()}
    assert got == {"train": 13, "validation": 2, "test": 4, "scoring": 1}
    with pytest.raises(ValueError, match="12"):
        L.time_split(df.where("m < 8"))
    prep = L.fit_preparation(split.where("split = 'train'"), ["v"], ["c"])
    # per month the values are 1, 2, 3, 5 and two gaps, so the median is 2.5
    assert prep.numeric["v"][0] == 2.5
    assert prep.categorical["c"] == ("x", ["x"]) and prep.feature_names == ["v", "c__x", "c____UNSEEN__"]
    unseen = L.transform(spark.createDataFrame([(None, "new")], "v double, c string"), prep).first()
    assert (unseen["c__x"], unseen["c____UNSEEN__"]) == (0, 1)


def test_naive_bayes_probabilities(spark):
    import math

    train = spark.createDataFrame([(0, 0.0), (0, 2.0), (1, 5.0), (1, 7.0)], f"{H.TARGET} int, a double")
    state = L.fit_gnb(train, ["a"], smoothing=0.0)
    row = L.score_gnb(spark.createDataFrame([(3.0,)], "a double"), state).first()
    like = [math.exp(-((3 - m) ** 2) / 2) for m in (1, 6)]
    assert row.p0 == pytest.approx(like[0] / sum(like)) and row.p2 == 0.0 and row.predicted_label == 0


def test_path_contributions_sum_to_prediction(spark):
    import random

    rnd = random.Random(2)
    rows = []
    for i in range(300):
        a, b = rnd.random(), rnd.random()
        rows.append((i, a, b, 2 if a > 0.7 else (1 if b > 0.5 else 0)))
    df = spark.createDataFrame(rows, f"id int, a double, b double, {H.TARGET} int")
    matrix = L.vectorised(df, ["a", "b"], ["id", H.TARGET])
    model = fit_one_forest(matrix, numTrees=5, maxDepth=4)
    scored = L.score_model(matrix, model)
    contributions, check = path_contributions(model, scored, ["id"], ["a", "b"])
    assert check.where("NOT passed").count() == 0 and check.count() == 300
    assert {r.feature for r in contributions.select("feature").distinct().collect()} == {"a", "b"}


def test_output_contract(panel):
    with pytest.raises(ValueError, match="contract"):
        fe.output_contracts(panel)


def test_varying_labels_keep_one_row_per_key(spark):
    from riskloom.plans import monthly as mo

    columns = "year_month string, customer_id int, product_id string, region_id int, transaction_id int, units_sold double, revenue double, avg_discount_pct double, gross_profit_eur double, customer_segment string, churn_risk_band string, customer_size_score double, base_churn_probability double"
    rows = [
        ("m", 1, "p", 1, 10, 1.0, 5.0, 0.1, 1.0, "A", "High", 1.0, 0.5), ("m", 1, "p", 1, 10, 2.0, 5.0, None, 1.0, "B", None, 2.0, 0.5),
        ("m", 1, "p", 1, 11, 3.0, 5.0, 0.3, 1.0, "B", None, 2.0, 0.5), ("m", None, "p", 1, 12, 4.0, 5.0, None, 1.0, None, None, None, None),
    ]
    sales = spark.createDataFrame(rows, columns)
    got = {r.customer_id: r for r in mo.customer_product_monthly(sales).collect()}
    assert len(got) == 2 and mo.customer_product_monthly(sales).count() == 2
    assert (got[1].customer_segment, got[1].churn_risk_band, got[1].order_count, got[1].units_sold) == ("B", "High", 2, 6.0)
    assert got[1].avg_discount_pct == pytest.approx(0.2)
    assert (got[None].customer_segment, got[None].churn_risk_band, got[None].order_count) == ("Unknown", "Unknown", 1)
    mix = mo.customer_month_features(sales, "A", ["year_month", "product_id", "region_id"]).first()
    assert mix.enterprise_customer_count == 1 and mix.avg_customer_size_score == 1.0


def test_customer_months_exchange_sales_by_key_only(spark):
    from riskloom.plans import monthly as mo

    columns = "year_month string, customer_id int, product_id string, region_id int, transaction_id int, units_sold double, revenue double, avg_discount_pct double, gross_profit_eur double, customer_segment string, churn_risk_band string"
    sales = spark.createDataFrame([("m", 1, "p", 1, 10, 1.0, 5.0, 0.1, 1.0, "A", "High")], columns)
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = mo.customer_product_monthly(sales)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
    # the sales rows once per branch by the key, and the two sides of the null-safe join
    assert plan.count("Exchange ") <= 4
