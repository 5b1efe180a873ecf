"""Split, preparation, classifiers and metrics."""

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import functions as F

from catalogue.base import (
    MODEL_CATEGORICAL,
    features,
    fitted,
    labelled,
    matrix,
    predictions,
    prepared,
    query,
    split_features,
    written,
)
from catalogue.model_sql import NUMERIC
from riskloom.functions.scalars import flag
from riskloom.operators.profiles import label_distribution, melt
from riskloom.operators.sets import union_all
from riskloom.plans import learning as L, metrics as M
from riskloom.plans.history import TARGET
from riskloom.session import shared_dir

KEYS = ["product_id", "region_id", "year_month"]
_K = "product_id, region_id, year_month"


# --- split ---------------------------------------------------------------------

@query("ml01_time_split", f"SELECT {_K}, target_month, split FROM t_split")
def time_split(star):
    return split_features(star).select(*KEYS, "target_month", "split")


@query(
    "ml02_split_summary",
    """SELECT split, count(*) AS row_count, min(year_month) AS observation_start, max(year_month) AS observation_end,
              min(target_month) AS target_start, max(target_month) AS target_end FROM t_split GROUP BY 1""",
)
def split_summary(star):
    return L.split_summary(split_features(star))


@query(
    "ml02_split_target_distribution",
    """SELECT split, label, count(*) FILTER (next_month_risk_label = label) AS row_count,
              count(*) FILTER (next_month_risk_label = label) / CAST(count(*) AS DOUBLE) AS share
       FROM t_split CROSS JOIN (SELECT unnest([0, 1, 2]) AS label) WHERE split <> 'scoring' GROUP BY 1, 2""",
    rounded="share",
)
def split_target_distribution(star):
    return label_distribution(split_features(star).where("split <> 'scoring'"), TARGET, L.RISK_LABELS, "split")


# --- preparation -----------------------------------------------------------------

@query(
    "ml03_numeric_state",
    "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, m_{c} AS median, a_{c} AS mean, s_{c} AS std FROM t_fit" for c in NUMERIC
    ),
    rounded="median mean std",
)
def numeric_state(star):
    return L.numeric_state(split_features(star).where("split = 'train'"), NUMERIC)


_STATE = "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM t_split WHERE split = 'train'" for c in MODEL_CATEGORICAL
)


@query(
    "ml03_categorical_state",
    f"""WITH raw AS ({_STATE}),
        modes AS (SELECT feature, first(v ORDER BY n DESC, v) AS mode FROM (
                    SELECT feature, v, count(*) AS n FROM raw WHERE v IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
        SELECT feature, coalesce(v, mode) AS level, count(*) AS n, coalesce(v, mode) = mode AS is_mode
        FROM raw JOIN modes USING (feature) GROUP BY 1, 2, 4""",
)
def categorical_state(star):
    return L.categorical_state(split_features(star).where("split = 'train'"), MODEL_CATEGORICAL)


_STAGES = ("Decline", "Growth", "Mature", "New")


@query(
    "ml04_transform",
    f"""SELECT {_K}, {', '.join(NUMERIC)},
               {', '.join(f'CAST(lifecycle_stage = {chr(39)}{v}{chr(39)} AS INTEGER) AS "lifecycle_stage__{v}"' for v in _STAGES)},
               0 AS "lifecycle_stage____UNSEEN__"
        FROM t_prep JOIN (SELECT {_K}, lifecycle_stage FROM t_panel) USING ({_K})""",
    rounded=" ".join(NUMERIC),
)
def transform(star):
    rows = split_features(star)
    state = L.fit_preparation(rows.where("split = 'train'"), NUMERIC, ["lifecycle_stage"])
    return L.transform(rows, state, KEYS)


@query(
    "ml04_unseen_level",
    f"""SELECT {_K}, CAST(p.product_category = 'Category 1' AS INTEGER) AS "product_category__Category 1",
               CAST(p.product_category = 'Category 2' AS INTEGER) AS "product_category__Category 2",
               CAST(p.product_category NOT IN ('Category 1', 'Category 2') AS INTEGER) AS "product_category____UNSEEN__"
        FROM t_panel p""",
)
def unseen_level(star):
    known = split_features(star).where(F.col("product_category").isin("Category 1", "Category 2"))
    state = L.fit_preparation(known, [], ["product_category"])
    return L.transform(features(star), state, KEYS)


_CATALOG = {
    "volatility_3m": ("momentum & stability", "current month available at prediction time"),
    "units_lag_1m": ("existing preprocessed feature", "current vs prior / prior-only history"),
    "risk_factor_volatility": ("momentum & stability", "current month available at prediction time"),
    "campaign_spend_eur": ("marketing & digital", "current month available at prediction time"),
    "gross_margin_pct": ("lifecycle & profitability", "current month available at prediction time"),
}


@query(
    "ml06_feature_catalog",
    "\nUNION ALL ".join(
        f"""SELECT '{c}' AS feature, '{fam}' AS feature_family,
            CASE WHEN count(*) FILTER ({c} NOT IN (0, 1)) = 0 THEN 'binary' ELSE 'numeric' END AS feature_type, '{timing}' AS timing,
            round(avg(CAST({c} IS NULL AS INTEGER)), 4) AS missing_rate, FALSE AS engineered, 'ok' AS leakage_status,
            TRUE AS included_in_model FROM t_labelled"""
        for c, (fam, timing) in _CATALOG.items()
    )
    + """ UNION ALL SELECT 'campaign_channel', 'marketing & digital', 'categorical', 'current month available at prediction time',
          round(avg(CAST(campaign_channel IS NULL AS INTEGER)), 4), FALSE, 'ok', TRUE FROM t_labelled""",
    rounded="missing_rate",
)
def feature_catalog(star):
    return L.feature_catalog(labelled(star), list(_CATALOG), ["campaign_channel"])


@query("ml06_full_feature_catalog")
def full_feature_catalog(star):
    table = features(star)
    numeric, categorical = L.select_features(table)
    # Only the names of the labelled columns are needed: the plan gives them without writing that stage.
    base = written(star).labelled().columns
    return L.feature_catalog(table, numeric, categorical, [c for c in table.columns if c not in base])


# --- classifiers -------------------------------------------------------------------

@query(
    "ml08_majority",
    """SELECT next_month_risk_label AS label, count(*) AS row_count FROM t_split WHERE split = 'train' GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 1""",
)
def majority(star):
    return L.fit_majority(split_features(star).where("split = 'train'"))


_LOGS = ", ".join(
    "max(CASE WHEN label = {k} THEN prior END) + "
    "sum(CASE WHEN label = {k} THEN -0.5 * ln(2 * pi() * v) - (x - mean) * (x - mean) / (2 * v) END) AS l{k}".format(k=k)
    for k in L.RISK_LABELS
)
_CELLS = "\nUNION ALL ".join(f"SELECT {_K}, '{c}' AS feature, {c} AS x FROM t_prep WHERE split = 'test'" for c in NUMERIC)


@query(
    "ml09_gaussian_naive_bayes",
    f"""WITH cells AS ({_CELLS}),
        state AS (SELECT feature, label, mean, var + 1e-4 * (SELECT max(spread * spread) FROM t_class) AS v,
                         ln(n / sum(n) OVER (PARTITION BY feature)) AS prior FROM t_class),
        logs AS (SELECT {_K}, {_LOGS} FROM cells JOIN state USING (feature) GROUP BY ALL)
        SELECT {_K}, exp(l0 - m) / z AS p0, exp(l1 - m) / z AS p1, exp(l2 - m) / z AS p2,
               CASE WHEN l0 >= l1 AND l0 >= l2 THEN 0 WHEN l1 >= l2 THEN 1 ELSE 2 END AS predicted_label
        FROM (SELECT *, exp(l0 - m) + exp(l1 - m) + exp(l2 - m) AS z FROM (SELECT *, greatest(l0, l1, l2) AS m FROM logs))""",
    # a log-likelihood adds 96 terms of up to thousands, so rounding in the variances shows in the probabilities' seventh place
    rounded="p0 p1 p2",
    digits=3,
)
def gaussian_naive_bayes(star):
    rows = prepared(star)
    state = L.fit_gnb(rows.where("split = 'train'"), list(NUMERIC))
    return L.score_gnb(rows.where("split = 'test'"), state).select(*KEYS, "p0", "p1", "p2", "predicted_label")


@query(
    "ml10_class_weights",
    """SELECT next_month_risk_label, count(*) AS row_count, (SELECT count(*) FROM t_split WHERE split = 'train') / (3.0 * count(*)) AS weight
       FROM t_split WHERE split = 'train' GROUP BY 1""",
    rounded="weight",
)
def class_weights(star):
    weighted = L.balanced_weights(split_features(star).where("split = 'train'"))
    return weighted.groupBy(TARGET).agg(F.count(F.lit(1)).alias("row_count"), F.max("weight").alias("weight"))


def _logistic(star):
    table, names = matrix(star)
    return fitted(star, "logistic", lambda: L.fit_logistic(table.where("split = 'train'"))), table, names


@query("ml10_logistic_regression")
def logistic_regression(star):
    model, table, _ = _logistic(star)
    scored = L.score_model(table.where("split = 'validation'"), model).withColumn("actual_label", F.col(TARGET))
    return M.evaluate(scored, "class_weighted_logistic_regression", "validation")


@query("ml11_aligned_probabilities")
def aligned_probabilities(star):
    model, table, _ = _logistic(star)
    return L.align_probabilities(model.transform(table.where("split = 'test'"))).select(*KEYS, "p0", "p1", "p2")


# --- metrics -------------------------------------------------------------------------

def _judged(star):
    return predictions(star).where(F.col("actual_label").isNotNull())


_LAB = "(SELECT * FROM t_pred WHERE actual_label IS NOT NULL)"


def summary_sql(relation: str) -> str:
    """Summary metrics of a relation with actual_label and predicted_label, from their definitions."""
    per = []
    for k in L.RISK_LABELS:
        per.append(
            f"""count(*) FILTER (actual_label = {k} AND predicted_label = {k}) AS tp{k},
                count(*) FILTER (actual_label = {k}) AS s{k}, count(*) FILTER (predicted_label = {k}) AS c{k}"""
        )
    p = {k: f"coalesce(tp{k} / nullif(c{k}, 0), 0)" for k in L.RISK_LABELS}
    r = {k: f"coalesce(tp{k} / nullif(s{k}, 0), 0)" for k in L.RISK_LABELS}
    f = {k: f"coalesce(2 * {p[k]} * {r[k]} / nullif({p[k]} + {r[k]}, 0), 0)" for k in L.RISK_LABELS}
    return f"""SELECT (tp0 + tp1 + tp2) / n AS accuracy, ({r[0]} + {r[1]} + {r[2]}) / 3 AS balanced_accuracy,
        ({f[0]} + {f[1]} + {f[2]}) / 3 AS macro_f1, ({f[0]} * s0 + {f[1]} * s1 + {f[2]} * s2) / n AS weighted_f1,
        {p[2]} AS high_risk_precision, {r[2]} AS high_risk_recall, {f[2]} AS high_risk_f1,
        coalesce(5 * {p[2]} * {r[2]} / nullif(4 * {p[2]} + {r[2]}, 0), 0) AS high_risk_f2,
        (c1 + c2) / n AS alert_rate, c2 / n AS high_risk_alert_rate, (c2 - tp2) / nullif(n - s2, 0) AS false_alarm_rate
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n, {', '.join(per)} FROM {relation})"""


SUMMARY = (
    "accuracy balanced_accuracy macro_f1 weighted_f1 high_risk_precision high_risk_recall high_risk_f1 high_risk_f2 "
    "alert_rate high_risk_alert_rate false_alarm_rate"
)


@query(
    "ml12_confusion",
    f"""SELECT a AS actual_label, p AS predicted_label, count(*) FILTER (actual_label = a AND predicted_label = p) AS row_count
        FROM {_LAB} CROSS JOIN (SELECT unnest([0, 1, 2]) AS a) CROSS JOIN (SELECT unnest([0, 1, 2]) AS p) GROUP BY 1, 2""",
)
def confusion(star):
    return M.confusion(_judged(star))


@query(
    "ml13_class_report",
    f"""SELECT k AS label, coalesce(tp / nullif(c, 0), 0) AS precision, coalesce(tp / nullif(s, 0), 0) AS recall,
               coalesce(2.0 * tp / nullif(c + s, 0), 0) AS f1_score, s AS support
        FROM (SELECT k, count(*) FILTER (actual_label = k AND predicted_label = k) AS tp, count(*) FILTER (actual_label = k) AS s,
                     count(*) FILTER (predicted_label = k) AS c
              FROM {_LAB} CROSS JOIN (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1)""",
    rounded="precision recall f1_score",
)
def class_report(star):
    return M.class_report(_judged(star))


@query("ml14_summary_metrics", summary_sql(_LAB), rounded=SUMMARY)
def summary_metrics(star):
    return M.summary_metrics(_judged(star))


@query(
    "ml15_roc_auc",
    "WITH "
    + ", ".join(
        f"""g{k} AS (SELECT p{k}, count(*) FILTER (actual_label = {k}) AS pos, count(*) FILTER (actual_label <> {k}) AS neg
            FROM {_LAB} GROUP BY 1)"""
        for k in L.RISK_LABELS
    )
    + " UNION ALL ".join(
        f""" SELECT {k} AS label, (SELECT sum(g.pos * (coalesce((SELECT sum(h.neg) FROM g{k} h WHERE h.p{k} < g.p{k}), 0)
               + g.neg / 2.0)) FROM g{k} g) / (SELECT CAST(sum(pos) AS DOUBLE) * sum(neg) FROM g{k}) AS roc_auc"""
        for k in L.RISK_LABELS
    ),
    rounded="roc_auc",
)
def roc_auc(star):
    return M.roc_auc(_judged(star))


@query(
    "ml16_average_precision",
    "\nUNION ALL ".join(
        f"""SELECT {k} AS label, sum(pos * (cp / CAST(cn AS DOUBLE))) / any_value(total) AS average_precision FROM (
              SELECT pos, sum(pos) OVER (ORDER BY p{k} DESC) AS cp, sum(n) OVER (ORDER BY p{k} DESC) AS cn, sum(pos) OVER () AS total
              FROM (SELECT p{k}, count(*) AS n, count(*) FILTER (actual_label = {k}) AS pos FROM {_LAB} GROUP BY 1))"""
        for k in L.RISK_LABELS
    ),
    rounded="average_precision",
)
def average_precision(star):
    return M.avg_precision(_judged(star))


@query(
    "ml17_log_loss",
    f"""SELECT -avg(ln(greatest(least(CASE actual_label WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END, 1 - 2.220446049250313e-16),
               2.220446049250313e-16))) AS log_loss FROM {_LAB}""",
    rounded="log_loss",
)
def log_loss(star):
    return M.log_loss(_judged(star))


_MODELS = {"argmax": None, "threshold_43": 0.43, "threshold_25": 0.25}


def _results(star, rows):
    parts = []
    for name, t in _MODELS.items():
        pred = rows if t is None else M.apply_threshold(rows, t)
        parts.append(M.summary_metrics(pred).select(F.lit(name).alias("model"), "*"))
    return union_all(*parts)


def _results_sql(relation: str) -> str:
    parts = []
    for name, t in _MODELS.items():
        rel = relation if t is None else (
            f"(SELECT actual_label, CASE WHEN p2 >= {t} THEN 2 WHEN p1 > p0 THEN 1 ELSE 0 END AS predicted_label FROM {relation})"
        )
        parts.append(f"SELECT '{name}' AS model, * FROM ({summary_sql(rel)})")
    return "\nUNION ALL ".join(parts)


@query(
    "ml18_selected_model",
    f"""SELECT * FROM ({_results_sql(_LAB)}) WHERE model <> 'majority_class'
        ORDER BY round(high_risk_f2, 9) DESC, round(macro_f1, 9) DESC, round(high_risk_precision, 9) DESC, model LIMIT 1""",
    rounded=SUMMARY,
)
def selected_model(star):
    return M.select_model(_results(star, _judged(star)))


_TEST = """(SELECT p.* FROM t_pred p JOIN t_split s ON s.product_id = p.product_id AND s.region_id = p.region_id
            AND s.year_month = p.year_month WHERE s.split = 'test')"""


@query("ml19_test_results", _results_sql(_TEST), rounded=SUMMARY)
def test_results(star):
    test = split_features(star).where("split = 'test'").select(*KEYS)
    return _results(star, predictions(star).join(test, KEYS, "left_semi"))


@query(
    "ml20_f_scores",
    """SELECT feature, sum(n * (mean - grand) * (mean - grand)) / 2 / (sum(n * var) / greatest(sum(n) - 3, 1) + 1e-12) AS f_score,
              row_number() OVER (ORDER BY round(sum(n * (mean - grand) * (mean - grand)) / 2 / (sum(n * var) / greatest(sum(n) - 3, 1) + 1e-12), 6) DESC NULLS LAST,
                feature) AS rank FROM t_class GROUP BY feature""",
    rounded="f_score",
)
def f_scores(star):
    return L.f_scores(prepared(star).where("split = 'train'"), list(NUMERIC))


@query(
    "ml21_class_drivers",
    """SELECT feature, max(mean) FILTER (label = 0) AS class_0_mean, max((mean - grand) / spread) FILTER (label = 0) AS standardized_difference_class_0,
              max(mean) FILTER (label = 1) AS class_1_mean, max((mean - grand) / spread) FILTER (label = 1) AS standardized_difference_class_1,
              max(mean) FILTER (label = 2) AS class_2_mean, max((mean - grand) / spread) FILTER (label = 2) AS standardized_difference_class_2,
              max(abs(mean)) AS max_abs_class_mean, max(abs((mean - grand) / spread)) AS max_abs_standardized_difference
       FROM t_class GROUP BY 1 ORDER BY round(max(abs((mean - grand) / spread)), 6) DESC NULLS LAST, feature LIMIT 30""",
    rounded="""class_0_mean standardized_difference_class_0 class_1_mean standardized_difference_class_1 class_2_mean
               standardized_difference_class_2 max_abs_class_mean max_abs_standardized_difference""",
)
def class_drivers(star):
    return L.gnb_drivers(prepared(star).where("split = 'train'"), list(NUMERIC))


@query("ml22_logistic_coefficients")
def logistic_coefficients(star):
    model, _, names = _logistic(star)
    return L.lr_coefficients(model, names, star.spark)


@query("ml23_prediction_table")
def prediction_table(star):
    rows = prepared(star)
    train, valid = rows.where("split = 'train'"), rows.where("split = 'validation'")
    scored = {
        "majority_class": L.score_majority(valid, L.fit_majority(train)),
        "gaussian_naive_bayes": L.score_gnb(valid, L.fit_gnb(train, list(NUMERIC))),
    }
    return L.prediction_table(scored, [*KEYS, "target_month"])


@query(
    "ml24_current_scores",
    f"""SELECT {_K}, 'rule' AS model_name, p0, p1, p2, predicted_label,
               CASE predicted_label WHEN 0 THEN 'Low Risk' WHEN 1 THEN 'Medium Risk' ELSE 'High Risk' END AS predicted_risk_label_name,
               5 * p1 + 10 * p2 AS predicted_risk_score_0_10, CAST(predicted_label > 0 AS INTEGER) AS alert_flag,
               CAST(predicted_label = 2 AS INTEGER) AS high_risk_alert_flag
        FROM t_pred WHERE actual_label IS NULL""",
    rounded="p0 p1 p2 predicted_risk_score_0_10",
)
def current_scores(star):
    waiting = predictions(star).where(F.col("actual_label").isNull())
    return L.score_current(waiting.select(*KEYS, "p0", "p1", "p2", "predicted_label"), "rule")


@query("ml24_refit_and_score")
def refit_and_score(star):
    """The selected classifier fitted on every labelled row, scoring the latest month."""
    rows = prepared(star)
    state = L.fit_gnb(rows.where(F.col(TARGET).isNotNull()), list(NUMERIC))
    scored = L.score_gnb(rows.where(F.col(TARGET).isNull()), state)
    return L.score_current(scored, "gaussian_naive_bayes").drop(*NUMERIC)


@query(
    "ml25_imbalance",
    """SELECT count(*) FILTER (next_month_risk_label = 2) AS high_risk_rows,
              avg(CASE WHEN next_month_risk_label = 2 THEN 1.0 ELSE 0.0 END) AS high_risk_share,
              count(*) FILTER (next_month_risk_label = 0) / nullif(count(*) FILTER (next_month_risk_label = 2), 0) AS low_to_high_ratio
       FROM t_split WHERE split = 'train'""",
    rounded="high_risk_share low_to_high_ratio",
)
def imbalance(star):
    return L.imbalance(split_features(star).where("split = 'train'"))


@query(
    "ml27_melt",
    f"""SELECT model, metric, value FROM ({_results_sql(_LAB)}) UNPIVOT (value FOR metric IN (macro_f1, high_risk_recall, alert_rate))""",
    rounded="value",
)
def melted_results(star):
    return melt(
        _results(star, _judged(star)).select("model", "macro_f1", "high_risk_recall", "alert_rate"), ["model"],
        ["macro_f1", "high_risk_recall", "alert_rate"],
    )


@query("ml29_saved_model")
def saved_model(star):
    model, table, _ = _logistic(star)
    path = L.save_model(model, f"{shared_dir(star.spark)}/riskloom/logistic-{model.uid}")
    loaded = LogisticRegressionModel.load(path)
    test = table.where("split = 'test'")
    a = L.score_model(test, model).select(*KEYS, F.col("p2").alias("original"))
    b = L.score_model(test, loaded).select(*KEYS, F.col("p2").alias("reloaded"))
    return a.join(b, KEYS).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(flag(F.col("original") != F.col("reloaded"))).alias("different_rows")
    )


@query(
    "ml30_probability_sums",
    """SELECT count(*) AS row_count, count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) AS bad_rows,
              count(*) FILTER (abs(p0 + p1 + p2 - 1) > 1e-6) = 0 AS passed FROM t_pred""",
)
def probability_sums(star):
    return M.check_proba(predictions(star))
