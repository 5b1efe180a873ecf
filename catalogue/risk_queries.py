"""Threshold, interpretation and operational output queries."""

from pyspark.sql import functions as F

from catalogue.base import features, fitted, labelled, matrix, predictions, query
from catalogue.learning_queries import SUMMARY, summary_sql
from riskloom.operators.profiles import label_distribution
from riskloom.plans import forest as RF, learning as L, metrics as M, outputs as O

KEYS = ["product_id", "region_id", "year_month"]
_K = "product_id, region_id, year_month"
_LAB = "(SELECT * FROM t_pred WHERE actual_label IS NOT NULL)"
CONTEXT = ["product_category", "region", "lifecycle_stage", "mom_units_growth_pct"]

def _judged(star):
    return predictions(star).where(F.col("actual_label").isNotNull())


def _forest(star):
    table, names = matrix(star)
    return fitted(star, "forest", lambda: RF.fit_one_forest(table.where("split = 'train'"))), table, names


@query("ro01_forest_candidates")
def forest_candidates(star):
    table, _ = matrix(star)
    grid = [{"balanced": True}, {"maxDepth": 8, "balanced": False}]
    _, ranked = RF.fit_forest(table.where("split = 'train'"), table.where("split = 'validation'"), grid)
    return ranked


_GRID = f"""(SELECT t AS threshold, actual_label, CASE WHEN p2 >= t THEN 2 WHEN p1 > p0 THEN 1 ELSE 0 END AS predicted_label
             FROM {_LAB} CROSS JOIN (SELECT unnest(range(5, 96)) / 100.0 AS t))"""
_TRADE = summary_sql("REL").replace("SELECT CAST(count(*)", "SELECT threshold, CAST(count(*)").replace("FROM REL", f"FROM {_GRID} GROUP BY threshold")
_TRADE = "SELECT threshold, " + _TRADE[len("SELECT "):]


@query(
    "ro02_tuned_threshold",
    f"""SELECT * FROM ({_TRADE}) WHERE high_risk_recall >= 0.7 ORDER BY round(high_risk_f2, 9) DESC, round(high_risk_precision, 9) DESC,
        round(macro_f1, 9) DESC, round(false_alarm_rate, 9), threshold LIMIT 1""",
    rounded="threshold " + SUMMARY,
)
def tuned_threshold(star):
    return M.tune_threshold(_judged(star), min_recall=0.7)


@query(
    "ro03_thresholded_labels",
    f"SELECT {_K}, CASE WHEN p2 >= 0.43 THEN 2 WHEN p1 > p0 THEN 1 ELSE 0 END AS predicted_label FROM t_pred",
)
def thresholded_labels(star):
    return M.apply_threshold(predictions(star), 0.43).select(*KEYS, "predicted_label")


_WILSON = """SELECT '{m}' AS metric, k AS successes, n AS trials, k / CAST(n AS DOUBLE) AS estimate,
  (k / CAST(n AS DOUBLE) + 1.9208 / n - 1.96 * sqrt((k / CAST(n AS DOUBLE)) * (1 - k / CAST(n AS DOUBLE)) / n + 0.9604 / (CAST(n AS DOUBLE) * n))) / (1 + 3.8416 / n) AS lower,
  (k / CAST(n AS DOUBLE) + 1.9208 / n + 1.96 * sqrt((k / CAST(n AS DOUBLE)) * (1 - k / CAST(n AS DOUBLE)) / n + 0.9604 / (CAST(n AS DOUBLE) * n))) / (1 + 3.8416 / n) AS upper
  FROM (SELECT count(*) FILTER (actual_label = 2 AND predicted_label = 2) AS k, count(*) FILTER ({c} = 2) AS n FROM {r})"""


@query(
    "ro04_wilson_intervals",
    _WILSON.format(m="high_risk_recall", c="actual_label", r=_LAB) + " UNION ALL "
    + _WILSON.format(m="high_risk_precision", c="predicted_label", r=_LAB),
    rounded="estimate lower upper",
)
def wilson_intervals(star):
    return M.high_risk_intervals(_judged(star))


@query("ro05_impurity_importance")
def impurity_importance(star):
    model, _, names = _forest(star)
    return RF.impurity_importance(star.spark, model, names)


@query("ro05_family_importance")
def family_importance(star):
    model, _, names = _forest(star)
    return RF.family_importance(RF.impurity_importance(star.spark, model, names))


@query("ro06_permutation_importance")
def permutation_importance(star):
    model, table, names = _forest(star)
    return RF.permutation_importance(model, table.where("split = 'validation'"), names, KEYS)


@query("ro07_path_contributions")
def path_contributions(star):
    model, table, names = _forest(star)
    scored = L.score_model(table.where("split = 'scoring'"), model)
    contributions, _ = RF.path_contributions(model, scored, KEYS, names)
    return RF.top_drivers(contributions, KEYS)


@query("ro07_path_sum_check")
def path_sum_check(star):
    model, table, names = _forest(star)
    scored = L.score_model(table.where("split = 'scoring'"), model)
    _, check = RF.path_contributions(model, scored, KEYS, names)
    return check


_IND = f"""SELECT {_K}, product_category, region, lifecycle_stage, mom_units_growth_pct, risk_factor_under_trend AS ind_below_trend,
  risk_factor_customer_drop AS ind_customer_decline,
  CASE WHEN gross_margin_pct - target_margin_pct < 0 THEN 1 ELSE 0 END AS ind_margin_pressure, stockout_flag AS ind_stockout,
  CASE WHEN competitor_pressure_index >= 70 THEN 1 ELSE 0 END AS ind_competitor_pressure,
  CASE WHEN campaign_spend_eur > 0 AND coalesce(demo_requests, 0) = 0 THEN 1 ELSE 0 END AS ind_campaign_not_converting FROM t_labelled"""
_NAMES = ("below_trend", "customer_decline", "margin_pressure", "stockout", "competitor_pressure", "campaign_not_converting")
_COUNT = " + ".join(f"ind_{n}" for n in _NAMES)
_LIST = "concat_ws(', ', " + ", ".join(f"CASE WHEN ind_{n} = 1 THEN '{n}' END" for n in _NAMES) + ")"


@query(
    "ro08_risk_indicators",
    f"""SELECT {_K}, {', '.join(f'ind_{n}' for n in _NAMES)}, {_COUNT} AS indicator_count, {_LIST} AS indicators FROM ({_IND})""",
)
def risk_indicators(star):
    return O.risk_indicators(features(star)).select(
        *KEYS, *[f"ind_{n}" for n in O.INDICATORS], "indicator_count", "indicators"
    )


_LABEL = "CASE {c} WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Medium Risk' WHEN 2 THEN 'High Risk' END"


@query(
    "ro09_dashboard_history",
    f"""SELECT p.product_id, p.region_id, p.year_month, target_month, actual_label, predicted_label, p0, p1, p2,
               l.product_category, l.region, l.lifecycle_stage, l.mom_units_growth_pct,
               {_LABEL.format(c='actual_label')} AS actual_label_name, {_LABEL.format(c='predicted_label')} AS predicted_label_name,
               5 * p1 + 10 * p2 AS risk_score_0_10,
               CASE WHEN actual_label IS NOT NULL THEN CAST(actual_label = predicted_label AS INTEGER) END AS correct_flag
        FROM t_pred p LEFT JOIN t_labelled l ON l.product_id = p.product_id AND l.region_id = p.region_id AND l.year_month = p.year_month""".replace(
        "target_month, actual", "p.target_month, actual"
    ),
    rounded="p0 p1 p2 mom_units_growth_pct risk_score_0_10",
)
def dashboard_history(star):
    pred = predictions(star).drop("revenue_at_risk_proxy", "revenue", "units_sold")
    return O.dashboard_history(pred, labelled(star), CONTEXT)


_CURRENT = f"""SELECT p.product_id, p.region_id, p.year_month, p.p0, p.p1, p.p2, p.predicted_label, p.revenue_at_risk_proxy,
  i.product_category, i.region, i.lifecycle_stage, i.mom_units_growth_pct, {_COUNT} AS indicator_count, {_LIST} AS indicators,
  CASE WHEN ind_stockout = 1 THEN 'Secure supply' WHEN ind_customer_decline = 1 THEN 'Contact lost customers'
       WHEN ind_below_trend = 1 THEN 'Review sales plan' WHEN ind_margin_pressure = 1 THEN 'Review price and cost'
       WHEN ind_competitor_pressure = 1 THEN 'Prepare competitive offer'
       WHEN ind_campaign_not_converting = 1 THEN 'Rework campaign' ELSE 'Monitor' END AS recommended_action,
  {_LABEL.format(c='predicted_label')} AS predicted_label_name, 5 * p1 + 10 * p2 AS risk_score_0_10
  FROM t_pred p LEFT JOIN ({_IND}) i ON i.product_id = p.product_id AND i.region_id = p.region_id AND i.year_month = p.year_month
  WHERE p.actual_label IS NULL"""


def _current(star):
    pred = predictions(star).drop("revenue", "units_sold", "target_month")
    return O.current_output(pred, features(star), CONTEXT).drop("actual_label")


@query("ro10_current_output", _CURRENT, rounded="p0 p1 p2 revenue_at_risk_proxy mom_units_growth_pct risk_score_0_10")
def current_output(star):
    return _current(star)


@query(
    "ro11_alert_queue",
    f"""SELECT {_K}, predicted_label, p2, recommended_action, row_number() OVER (ORDER BY predicted_label DESC, p2 DESC,
               round(revenue_at_risk_proxy, 6) DESC NULLS LAST, {_K}) AS priority FROM ({_CURRENT}) WHERE predicted_label > 0""",
    rounded="p2",
)
def alert_queue(star):
    exposed = _current(star).withColumn("revenue_at_risk_proxy", F.round("revenue_at_risk_proxy", 6))
    return O.alert_queue(exposed).select(*KEYS, "predicted_label", "p2", "recommended_action", "priority")


@query(
    "ro12_top_high_risk",
    f"""SELECT {_K}, p2, units_sold FROM t_pred WHERE predicted_label = 2 AND year_month = (SELECT max(year_month) FROM t_pred)
        ORDER BY p2 DESC, {_K} LIMIT 20""",
    rounded="p2 units_sold",
)
def top_high_risk(star):
    return O.top_high_risk(predictions(star), 20).select(*KEYS, "p2", "units_sold")


@query(
    "ro13_monthly_monitoring",
    f"""SELECT target_month, count(*) AS row_count, count(*) FILTER (predicted_label > 0) AS alerts,
               count(*) FILTER (predicted_label = 2) AS high_risk_alerts,
               count(*) FILTER (predicted_label = 2 AND actual_label = 2) / nullif(count(*) FILTER (actual_label = 2), 0) AS high_risk_recall,
               count(*) FILTER (predicted_label = 2 AND actual_label = 2) / nullif(count(*) FILTER (predicted_label = 2), 0) AS high_risk_precision,
               avg(p2) AS mean_high_risk_probability FROM {_LAB} GROUP BY 1""",
    rounded="high_risk_recall high_risk_precision mean_high_risk_probability",
)
def monthly_monitoring(star):
    return M.monitor_by_month(_judged(star))


@query("ro14_threshold_tradeoff", _TRADE, rounded="threshold " + SUMMARY)
def threshold_tradeoff(star):
    return M.threshold_tradeoff(_judged(star))


@query(
    "ro15_lift_by_capacity",
    f"""WITH g AS (SELECT p2, count(*) AS n, count(*) FILTER (actual_label = 2) AS pos FROM {_LAB} GROUP BY 1),
        c AS (SELECT *, (SELECT coalesce(sum(h.n), 0) FROM g h WHERE h.p2 > g.p2) AS before, (SELECT sum(n) FROM g) AS total, (SELECT sum(pos) FROM g) AS allpos FROM g)
        SELECT capacity, CAST(sum(n) AS BIGINT) AS reviewed_rows, CAST(sum(pos) AS BIGINT) AS captured_high_risk,
               sum(pos) / sum(n) AS precision_at_capacity, sum(pos) / any_value(allpos) AS recall_at_capacity,
               (sum(pos) / sum(n)) / (any_value(allpos) / any_value(total)) AS lift
        FROM c CROSS JOIN (SELECT unnest([0.01, 0.02, 0.05, 0.10, 0.20, 0.30])::DOUBLE AS capacity)
        WHERE before < ceil(total * capacity) GROUP BY 1""",
    rounded="capacity precision_at_capacity recall_at_capacity lift",
)
def lift_by_capacity(star):
    return M.lift_table(_judged(star))


@query(
    "ro16_output_checks",
    """SELECT unnest(['probabilities_sum_to_one', 'score_in_range', 'labels_valid', 'prediction_reproduced']) AS check_name,
              unnest([count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) = 0, count(*) FILTER (5 * p1 + 10 * p2 NOT BETWEEN 0 AND 10) = 0,
                      count(*) FILTER (predicted_label NOT IN (0, 1, 2)) = 0, TRUE]) AS passed,
              unnest([CAST(count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) AS VARCHAR), CAST(count(*) FILTER (5 * p1 + 10 * p2 NOT BETWEEN 0 AND 10) AS VARCHAR),
                      CAST(count(*) FILTER (predicted_label NOT IN (0, 1, 2)) AS VARCHAR), '0']) AS detail FROM t_pred""",
)
def output_checks(star):
    return O.output_checks(predictions(star))


@query(
    "ro17_class_counts",
    """SELECT label, count(*) FILTER (predicted_label = label) AS row_count, count(*) FILTER (predicted_label = label) / CAST(count(*) AS DOUBLE) AS share
       FROM t_pred CROSS JOIN (SELECT unnest([0, 1, 2]) AS label) WHERE actual_label IS NULL GROUP BY 1""",
    rounded="share",
)
def class_counts(star):
    return label_distribution(predictions(star).where(F.col("actual_label").isNull()), "predicted_label", L.RISK_LABELS)


