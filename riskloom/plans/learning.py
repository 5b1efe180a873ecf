"""Chronological split, train-fitted preparation and baseline classifiers."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.functions.scalars import flag, map_values
from riskloom.operators.quantiles import exact_medians
from riskloom.operators.sets import argmax_column, union_all
from riskloom.plans.history import TARGET

RISK_LABELS = (0, 1, 2)
LABEL_NAMES = {0: "Low Risk", 1: "Medium Risk", 2: "High Risk"}
SPLITS = ("train", "validation", "test", "scoring")

# Columns that never become features.
IDENTIFIERS = (
    "product_id", "region_id", "year_month", "target_month", "product_name", "sku", "country", "currency",
)
AUDIT_DATES = (
    "launch_date", "effective_launch_date", "observed_first_sale_date", "MonthStartDate", "MonthEndDate", "YearMonthKey",
)
AUDIT_COUNTS = (
    "missing_sales_rep_count", "missing_discount_count", "missing_margin_count",
    "market_activity_available_flag", "market_signal_available_flag", "inventory_available_flag",
)
CATEGORICAL = (
    "product_line", "product_category", "region", "lifecycle_stage", "dominant_margin_category",
    "dominant_order_size_category", "dominant_rep_seniority", "campaign_channel",
)

# Feature families and the name parts that select them, first match wins.
FAMILY_TOKENS = {
    "lifecycle & profitability": ("lifecycle", "product_age", "margin", "gross_profit", "cost_"),
    "marketing & digital": ("campaign", "website", "page_view", "demo_", "mql_", "digital_", "click_"),
    "supply & returns": ("inventory", "stock", "supply", "backorder", "return_", "production_"),
    "market context": ("market_", "competitor", "seasonality", "macro_", "demand_"),
    "peer benchmark": (
        "category_region", "product_unit_share", "product_revenue_share", "customer_share", "unit_share",
        "unit_rank", "revenue_percentile",
    ),
    "customer mix": ("customer_size", "customer_churn", "distributor_", "churn_risk_customer", "avg_order_"),
    "momentum & stability": ("growth", "acceleration", "rolling_", "volatility", "vs_lag", "vs_6m"),
    "interaction & risk": (
        "pressure_score", "commercial_pressure", "revenue_at_risk", "engagement_to_pipeline",
        "pipeline_value_per_customer", "efficiency_score", "mismatch",
    ),
}
PRIOR_TOKENS = ("lag_", "rolling_", "change_pct", "growth_pct")
STATIC_FEATURES = ("product_line", "product_category", "region", "lifecycle_stage")


# --- split -----------------------------------------------------------------

def time_split(
    df: DataFrame, train: float = 0.70, validation: float = 0.15, target: str = TARGET, period: str = "target_month",
    min_months: int = 12, enforce: bool = True,
) -> DataFrame:
    """Adds ``split`` by ordered target month; unlabelled rows are ``scoring``.

    Only the distinct labelled months (one per calendar month) are ordered, in a
    scalar subquery; every row then looks up its position in that short list.
    """
    labelled = F.col(target).isNotNull() & F.col(period).isNotNull()
    distinct = df.where(labelled).select(period).distinct()
    if enforce and distinct.limit(min_months).count() < min_months:
        raise ValueError(f"at least {min_months} labelled target months are needed")
    ordered = distinct.agg(F.array_sort(F.collect_list(period)).alias("m")).scalar()
    months = F.col("_months")
    n = F.size(months)
    n_train = F.greatest(F.lit(1), F.floor(n * F.lit(train)))
    n_valid = F.greatest(F.lit(1), F.floor(n * F.lit(validation)))
    position = F.array_position(months, F.col(period))
    split = (
        F.when(F.col(target).isNull(), "scoring")
        .when(position <= n_train, "train")
        .when(position <= n_train + n_valid, "validation")
        .when(position > 0, "test")
    )
    return df.withColumn("_months", ordered).withColumn("split", split).drop("_months")


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("year_month").alias("observation_start"),
        F.max("year_month").alias("observation_end"),
        F.min("target_month").alias("target_start"),
        F.max("target_month").alias("target_end"),
    )


def imbalance(df: DataFrame, target: str = TARGET) -> DataFrame:
    """High-risk rows, their share, and low-to-high ratio (null without high-risk rows)."""
    return df.agg(
        F.count_if(F.col(target) == 2).alias("high_risk_rows"),
        F.avg(flag(F.col(target) == 2)).alias("high_risk_share"),
        (F.count_if(F.col(target) == 0) / F.nullif(F.count_if(F.col(target) == 2), F.lit(0))).alias("low_to_high_ratio"),
    )


# --- feature roles ---------------------------------------------------------

def select_features(df: DataFrame, target: str = TARGET) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names by role and type (schema only)."""
    categorical = [c for c in CATEGORICAL if c in df.columns]
    excluded = {*IDENTIFIERS, *AUDIT_DATES, *AUDIT_COUNTS, target, "target_risk_score", "split", *categorical}
    numeric_types = ("integer", "long", "short", "byte", "double", "float", "boolean")
    numeric = [
        f.name
        for f in df.schema.fields
        if f.name not in excluded
        and not f.name.startswith("future_")
        and "next_month" not in f.name
        and (f.dataType.typeName() in numeric_types or f.dataType.typeName().startswith("decimal"))
    ]
    return numeric, categorical


def feature_family(name: str) -> str:
    for family, tokens in FAMILY_TOKENS.items():
        if any(t in name for t in tokens):
            return family
    return "existing preprocessed feature"


def feature_timing(name: str) -> str:
    if any(t in name for t in PRIOR_TOKENS):
        return "current vs prior / prior-only history"
    if name in STATIC_FEATURES:
        return "static/current dimension"
    return "current month available at prediction time"


def feature_catalog(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], engineered: Sequence[str] = ()
) -> DataFrame:
    """One row per feature: family, type, timing and missing rate; one aggregate over the data."""
    names = [*numeric, *categorical]
    aggs = []
    for c in names:
        aggs.append(F.avg(F.col(c).isNull().cast("int")).alias(f"m__{c}"))
        if c in numeric:
            aggs.append(F.count_if(~F.col(c).cast("double").isin(0.0, 1.0)).alias(f"o__{c}"))
    flat = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(feature_family(c)).alias("feature_family"),
            (F.lit("categorical") if c in categorical
             else F.when(F.col(f"o__{c}") == 0, "binary").otherwise("numeric")).alias("feature_type"),
            F.lit(feature_timing(c)).alias("timing"),
            F.round(F.col(f"m__{c}"), 4).alias("missing_rate"),
            F.lit(c in engineered).alias("engineered"),
            F.lit("ok").alias("leakage_status"),
            F.lit(True).alias("included_in_model"),
        )
        for c in names
    ]
    return flat.select(F.inline(F.array(*rows)))


# --- preparation -----------------------------------------------------------

@dataclass
class Preparation:
    """Fitted state, the size of the schema: one entry per feature or category level."""

    numeric: dict[str, tuple[float, float, float]]  # median, mean, std
    categorical: dict[str, tuple[str, list[str]]]  # mode, levels
    unseen: bool = True
    feature_names: list[str] = field(default_factory=list)

    def __post_init__(self):
        names = list(self.numeric)
        for c, (_, levels) in self.categorical.items():
            names += [f"{c}__{level}" for level in levels]
            if self.unseen:
                names.append(f"{c}____UNSEEN__")
        self.feature_names = names


def numeric_state(train: DataFrame, numeric: Sequence[str]) -> DataFrame:
    """(feature, median, mean, std): exact medians first, then moments of the imputed values."""
    doubles = train.select(*[F.col(c).cast("double").alias(c) for c in numeric])
    medians = exact_medians(doubles, [], numeric).select(
        F.struct(*[F.coalesce(F.col(f"median_{c}"), F.lit(0.0)).alias(c) for c in numeric])
    )
    filled = doubles.withColumn("_med", medians.scalar())
    imputed = {c: F.coalesce(F.col(c), F.col(f"_med.{c}")) for c in numeric}
    flat = filled.agg(
        F.first("_med").alias("_med"),
        *[F.avg(e).alias(f"mean__{c}") for c, e in imputed.items()],
        *[F.stddev_samp(e).alias(f"std__{c}") for c, e in imputed.items()],
    )
    return flat.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"_med.{c}").alias("median"),
                        F.col(f"mean__{c}").alias("mean"),
                        F.coalesce(F.nullif(F.col(f"std__{c}"), F.lit(0.0)), F.lit(1.0)).alias("std"),
                    )
                    for c in numeric
                ]
            )
        )
    )


def categorical_state(train: DataFrame, categorical: Sequence[str]) -> DataFrame:
    """(feature, level, n, is_mode): counts per observed level after filling gaps with the mode.

    The mode is the most frequent level, the smallest on ties; ``Unknown`` for an all-null column.
    """
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level")) for c in categorical]
    counts = train.select(F.inline(F.array(*cells))).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("level").isNotNull()
    tops = counts.groupBy("feature").agg(F.max(F.when(known, F.col("n"))).alias("_top"))
    best = counts.join(tops, "feature").groupBy("feature").agg(
        F.coalesce(F.min(F.when(F.col("n") == F.col("_top"), F.col("level"))), F.lit("Unknown")).alias("mode")
    )
    return (
        counts.join(best, "feature")
        .withColumn("level", F.coalesce("level", "mode"))
        .groupBy("feature", "level", "mode")
        .agg(F.sum("n").alias("n"))
        .select("feature", "level", "n", (F.col("level") == F.col("mode")).alias("is_mode"))
    )


def fit_preparation(
    train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], unseen: bool = True
) -> Preparation:
    """Fit on training rows. Reads back one row per feature and per category level."""
    fitted = numeric_state(train, numeric).collect() if numeric else []
    nums = {r["feature"]: (r["median"], r["mean"], r["std"]) for r in fitted}
    levels: dict[str, list[str]] = {c: [] for c in categorical}
    modes: dict[str, str] = {}
    if categorical:
        for r in categorical_state(train, categorical).collect():
            levels[r["feature"]].append(r["level"])
            if r["is_mode"]:
                modes[r["feature"]] = r["level"]
    cats = {c: (modes.get(c, "Unknown"), sorted(levels[c])) for c in categorical}
    return Preparation({c: nums[c] for c in numeric}, cats, unseen)


def prepared_columns(prep: Preparation) -> dict[str, Column]:
    """Imputed, standardised and one-hot expressions in feature order."""
    out: dict[str, Column] = {}
    for c, (median, mean, std) in prep.numeric.items():
        value = F.coalesce(F.col(c).cast("double"), F.lit(float(median)))
        out[c] = (value - F.lit(float(mean))) / F.lit(float(std))
    for c, (mode, levels) in prep.categorical.items():
        text = F.coalesce(F.col(c).cast("string"), F.lit(mode))
        for level in levels:
            out[f"{c}__{level}"] = (text == level).cast("int")
        if prep.unseen:
            out[f"{c}____UNSEEN__"] = (~text.isin(*levels)).cast("int") if levels else F.lit(1)
    return out


def transform(df: DataFrame, prep: Preparation, keep: Sequence[str] = (), prefix: str = "") -> DataFrame:
    """Kept columns plus the prepared features, in one projection."""
    return df.select(*keep, *[e.alias(prefix + c) for c, e in prepared_columns(prep).items()])


def vectorised(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Kept columns and one ``features`` vector; identifiers never enter the vector."""
    safe = {c: f"x{i}" for i, c in enumerate(features)}
    renamed = df.select(*keep, *[F.col(f"`{c}`").alias(s) for c, s in safe.items()])
    return VectorAssembler(inputCols=list(safe.values()), outputCol="features").transform(renamed).select(*keep, "features")


# --- classifiers -----------------------------------------------------------

def fit_majority(train: DataFrame, target: str = TARGET) -> DataFrame:
    """Most frequent class (lowest on ties) as a one-row frame."""
    counts = train.groupBy(F.col(target).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), "label").limit(1)


def score_majority(df: DataFrame, majority: DataFrame) -> DataFrame:
    """Every row gets the majority class with probability 1."""
    scored = df.withColumn("predicted_label", majority.select("label").scalar().cast("int"))
    return scored.withColumns({f"p{k}": flag(F.col("predicted_label") == k).cast("double") for k in RISK_LABELS})


@dataclass
class GaussianState:
    """Class log-priors, means and smoothed variances per feature."""

    features: list[str]
    classes: dict[int, tuple[float, list[float], list[float]]]


def gnb_moments(train: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """(label, feature, n, mean, var) per class: one aggregate, then a small reshape."""
    flat = train.groupBy(F.col(target).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.var_pop(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(features)],
    )
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("mean"), F.col(f"v{i}").alias("var"))
        for i, c in enumerate(features)
    ]
    return flat.select("label", "n", F.inline(F.array(*cells)))


def fit_gnb(train: DataFrame, features: Sequence[str], smoothing: float = 1e-4, target: str = TARGET) -> GaussianState:
    """Closed-form Gaussian naive Bayes; smoothing is a share of the largest feature variance."""
    spread = train.agg(*[F.var_pop(F.col(f"`{c}`")).alias(f"v{i}") for i, c in enumerate(features)]).first()
    epsilon = smoothing * max(v or 0.0 for v in spread)
    per_class: dict[int, dict[str, tuple[float, float]]] = {}
    sizes: dict[int, int] = {}
    for r in gnb_moments(train, features, target).collect():
        per_class.setdefault(int(r["label"]), {})[r["feature"]] = (r["mean"], r["var"])
        sizes[int(r["label"])] = r["n"]
    total = sum(sizes.values())
    classes = {
        k: (
            math.log(sizes[k] / total),
            [m[c][0] for c in features],
            [m[c][1] + epsilon for c in features],
        )
        for k, m in per_class.items()
    }
    return GaussianState(list(features), classes)


def _gnb_log_likelihood(state: GaussianState, label: int) -> Column:
    """Log prior plus summed Gaussian log densities, folded over the feature array."""
    prior, means, variances = state.classes[label]
    constant = prior - 0.5 * sum(math.log(2 * math.pi * v) for v in variances)
    deviations = F.zip_with(
        F.col("_x"), F.array(*[F.struct(F.lit(m).alias("m"), F.lit(v).alias("v")) for m, v in zip(means, variances)]),
        lambda x, s: (x - s["m"]) * (x - s["m"]) / s["v"],
    )
    return F.lit(constant) - F.aggregate(deviations, F.lit(0.0), lambda acc, d: acc + d) * 0.5


def score_gnb(df: DataFrame, state: GaussianState) -> DataFrame:
    """Class probabilities p0, p1, p2 (0 for an unseen class) and the predicted label."""
    labels = sorted(state.classes)
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in state.features])
    logs = df.withColumn("_x", x).withColumns({f"_l{k}": _gnb_log_likelihood(state, k) for k in labels})
    top = F.greatest(*[F.col(f"_l{k}") for k in labels]) if len(labels) > 1 else F.col(f"_l{labels[0]}")
    shifted = logs.withColumn("_top", top)
    weights = {k: F.exp(F.col(f"_l{k}") - F.col("_top")) for k in labels}
    total = sum(weights.values(), F.lit(0.0))
    probs = {f"p{k}": (weights[k] / total if k in labels else F.lit(0.0)) for k in RISK_LABELS}
    out = shifted.withColumns(probs).drop("_x", "_top", *[f"_l{k}" for k in labels])
    return out.withColumn("predicted_label", arg_max_label())


def arg_max_label(columns: Sequence[str] = ("p0", "p1", "p2")) -> Column:
    """Label of the largest probability; the lower label wins a tie."""
    return F.regexp_extract(argmax_column(columns, absolute=False), r"(\d+)$", 1).cast("int")


def balanced_weights(train: DataFrame, target: str = TARGET, out: str = "weight") -> DataFrame:
    """Row weight n / (classes × n_class), looked up in a map of the few classes (no join)."""
    counts = train.groupBy(target).agg(F.count(F.lit(1)).alias("n_class"))
    sizes = counts.agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(target), F.col("n_class")))).alias("m")
    ).scalar()
    by_class = F.col("_sizes")
    total = F.aggregate(F.map_values(by_class), F.lit(0).cast("long"), lambda a, b: a + b)
    return train.withColumn("_sizes", sizes).withColumn(
        out, total / (F.size(by_class) * F.element_at(by_class, F.col(target)))
    ).drop("_sizes")


def fit_logistic(
    train: DataFrame, target: str = TARGET, c: float = 1.0, max_iter: int = 2000, tol: float = 1e-4
) -> LogisticRegressionModel:
    """Multinomial logistic regression with balanced weights and an L2 penalty.

    ``train`` has ``features`` and the target. The penalty of strength 1/c on a
    summed loss is 1/(c·n) on Spark's mean loss, the weights summing to n. Spark's ``tol``
    bounds the change of the loss; ``stationarity`` measures the gradients.
    """
    weighted = balanced_weights(train, target).withColumn("label", F.col(target).cast("double"))
    n = train.count()
    return LogisticRegression(
        family="multinomial", weightCol="weight", regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0,
        standardization=False, maxIter=max_iter, tol=tol,
    ).fit(weighted)


def align_probabilities(df: DataFrame, classes: Sequence[int] = RISK_LABELS, column: str = "probability") -> DataFrame:
    """Probability vector (position = class index) to p0, p1, p2; absent classes are 0."""
    cells = vector_to_array(F.col(column))
    position = {label: i for i, label in enumerate(classes)}
    return df.withColumns(
        {
            f"p{k}": (F.coalesce(F.get(cells, F.lit(position[k])), F.lit(0.0)) if k in position else F.lit(0.0))
            for k in RISK_LABELS
        }
    )


def score_model(df: DataFrame, model) -> DataFrame:
    """Rows with p0..p2 and the predicted label of a fitted Spark classifier."""
    scored = align_probabilities(model.transform(df))
    return scored.withColumn("predicted_label", F.col("prediction").cast("int")).drop(
        "rawPrediction", "probability", "prediction"
    )


def unpacked(df: DataFrame, size: int) -> DataFrame:
    """Adds the elements of the ``features`` vector as columns x0, x1, …"""
    cells = df.withColumn("_cells", vector_to_array("features"))
    return cells.select("*", *[F.get("_cells", F.lit(i)).alias(f"x{i}") for i in range(size)]).drop("_cells")


MAJORITY, NAIVE_BAYES, LOGISTIC = "majority_class", "gaussian_naive_bayes", "class_weighted_logistic_regression"


def fit_models(
    train: DataFrame, size: int, names: Sequence[str] = (MAJORITY, NAIVE_BAYES, LOGISTIC), target: str = TARGET
) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Classifiers by name, fitted on rows with a ``features`` vector of ``size`` elements.

    Each is a function that adds p0, p1, p2 and ``predicted_label`` to rows with such a vector.
    """
    columns = [f"x{i}" for i in range(size)]
    models: dict[str, Callable[[DataFrame], DataFrame]] = {}
    if MAJORITY in names:
        majority = fit_majority(train, target)
        models[MAJORITY] = lambda df: score_majority(df, majority)
    if NAIVE_BAYES in names:
        state = fit_gnb(unpacked(train, size), columns, target=target)
        models[NAIVE_BAYES] = lambda df: score_gnb(unpacked(df, size), state).drop(*columns)
    if LOGISTIC in names:
        model = fit_logistic(train, target)
        models[LOGISTIC] = lambda df: score_model(df, model)
    return models


def stationarity(
    train: DataFrame, coefficients: Sequence[Sequence[float]], intercepts: Sequence[float], features: Sequence[str],
    target: str = TARGET, c: float = 1.0, tolerance: float = 1e-4,
) -> DataFrame:
    """Gradient of the penalised objective of ``fit_logistic`` at the given coefficients, by feature and class.

    A certificate of optimality: the objective is convex, so coefficients are its minimum
    where every gradient is zero, whatever fitted them. ``train`` has ``features`` and the
    target; class k of the target has row k of ``coefficients``. One aggregate, combined
    before its shuffle to one row per feature; the intercept is the feature ``(intercept)``.
    """
    classes = range(len(intercepts))
    x = F.col("_x")
    margins = [
        F.aggregate(F.zip_with(x, F.lit([float(b), *map(float, w)]), lambda a, v: a * v), F.lit(0.0), lambda s, v: s + v)
        for w, b in zip(coefficients, intercepts)
    ]
    rows = (
        balanced_weights(train, target)
        .select(target, "weight", F.concat(F.array(F.lit(1.0)), vector_to_array("features")).alias("_x"))
        .withColumns({f"_m{k}": margins[k] for k in classes})
        .withColumn("_top", F.greatest(*[F.col(f"_m{k}") for k in classes]))
    )
    exps = [F.exp(F.col(f"_m{k}") - F.col("_top")) for k in classes]
    share = rows.withColumns({f"_e{k}": e for k, e in enumerate(exps)}).withColumn("_z", sum((F.col(f"_e{k}") for k in classes), F.lit(0.0)))
    residual = {f"_r{k}": F.col("weight") * (F.col(f"_e{k}") / F.col("_z") - flag(F.col(target) == k)) for k in classes}
    sums = (
        share.withColumns(residual)
        .select("weight", *residual, F.posexplode("_x").alias("_at", "_v"))
        .groupBy("_at")
        .agg(F.sum("weight").alias("_n"), *[F.sum(F.col(r) * F.col("_v")).alias(f"_g{k}") for k, r in enumerate(residual)])
    )
    # the penalty is 1/(c·n) on the mean loss and spares the intercept
    gradients = {
        f"gradient_class_{k}": F.col(f"_g{k}") / F.col("_n") + F.get(F.lit([0.0, *map(float, coefficients[k])]), F.col("_at")) / (F.col("_n") * c)
        for k in classes
    }
    largest = F.greatest(*[F.abs(F.col(g)) for g in gradients])
    return sums.select(F.get(F.lit(["(intercept)", *features]), F.col("_at")).alias("feature"), *[e.alias(g) for g, e in gradients.items()]).withColumns(
        {"residual": largest, "stationary": largest <= tolerance}
    )


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


# --- diagnostics -----------------------------------------------------------

def f_scores(train: DataFrame, features: Sequence[str], target: str = TARGET, labels: Sequence[int] = RISK_LABELS) -> DataFrame:
    """Univariate F-score per feature and its rank.

    Class moments come from one wide aggregate; only (class × feature) rows are
    reshaped, never the data.
    """
    moments = gnb_moments(train, features, target)
    totals = moments.groupBy("feature").agg(
        F.sum("n").alias("n_all"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand")
    )
    joined = moments.join(totals, "feature")
    between = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)) / max(len(labels) - 1, 1)
    within = F.sum(F.col("n") * F.col("var")) / F.greatest(F.max("n_all") - len(labels), F.lit(1))
    scored = joined.groupBy("feature").agg((between / (within + F.lit(1e-12))).alias("f_score"))
    return ranked_features(scored, "f_score")


def ranked_features(df: DataFrame, score: str) -> DataFrame:
    """Rank by score at six decimals, then by name; one row per feature, so a single ordered window is small."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(F.round(score, 6).desc_nulls_last(), "feature")))


def gnb_drivers(train: DataFrame, features: Sequence[str], top: int = 30, target: str = TARGET) -> DataFrame:
    """Standardised class-mean differences, largest first."""
    moments = gnb_moments(train, features, target)
    overall = train.agg(
        *[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(F.col(f"`{c}`")).alias(f"s{i}") for i, c in enumerate(features)],
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        F.col(f"m{i}").alias("grand"),
                        F.coalesce(F.nullif(F.col(f"s{i}"), F.lit(0.0)), F.lit(1.0)).alias("spread"),
                    )
                    for i, c in enumerate(features)
                ]
            )
        )
    )
    deltas = moments.join(overall, "feature").withColumn("diff", (F.col("mean") - F.col("grand")) / F.col("spread"))
    per_class = []
    for k in RISK_LABELS:
        hit = F.col("label") == k
        per_class.append(F.max(F.when(hit, F.col("mean"))).alias(f"class_{k}_mean"))
        per_class.append(F.max(F.when(hit, F.col("diff"))).alias(f"standardized_difference_class_{k}"))
    wide = deltas.groupBy("feature").agg(
        *per_class,
        F.max(F.abs("mean")).alias("max_abs_class_mean"),
        F.max(F.abs("diff")).alias("max_abs_standardized_difference"),
    )
    return wide.orderBy(F.round("max_abs_standardized_difference", 6).desc_nulls_last(), "feature").limit(top)


def lr_coefficients(model: LogisticRegressionModel, features: Sequence[str], spark) -> DataFrame:
    """Coefficient per feature and class with the dominant class; schema-sized."""
    matrix = model.coefficientMatrix.toArray()
    names = [f"coefficient_class_{k}" for k in range(matrix.shape[0])]
    rows = [(f, *[float(matrix[k, i]) for k in range(matrix.shape[0])]) for i, f in enumerate(features)]
    table = spark.createDataFrame(rows, ", ".join(["feature string", *[f"{n} double" for n in names]]))
    return table.withColumns(
        {
            "max_abs_coefficient": F.greatest(*[F.abs(F.col(n)) for n in names]),
            "dominant_class": argmax_column(names),
        }
    ).orderBy(F.desc("max_abs_coefficient"), "feature")


def prediction_table(scored: dict[str, DataFrame], keys: Sequence[str], target: str = TARGET) -> DataFrame:
    """Predictions of several models side by side, one row per key.

    Long form first and one grouped aggregate, so the keys shuffle once however
    many models there are.
    """
    cells = ["predicted_label", "p0", "p1", "p2"]
    long = union_all(
        *[
            df.select(*keys, F.col(target).alias("actual_label"), F.lit(name).alias("_model"), *cells)
            for name, df in scored.items()
        ]
    )
    names = {"p0": "probability_low", "p1": "probability_medium", "p2": "probability_high", "predicted_label": "predicted_label"}
    aggs = [F.max("actual_label").alias("actual_label")]
    for model in scored:
        for c in cells:
            aggs.append(F.max(F.when(F.col("_model") == model, F.col(c))).alias(f"{model}_{names[c]}"))
    wide = long.groupBy(*keys).agg(*aggs)
    labels = {f"{m}_predicted_label_name": map_values(f"{m}_predicted_label", LABEL_NAMES) for m in scored}
    return wide.withColumns({"actual_label_name": map_values("actual_label", LABEL_NAMES), **labels})


def score_current(pred: DataFrame, model_name: str) -> DataFrame:
    """Business columns for scored rows: names, 0-10 score, alert flags."""
    return pred.withColumns(
        {
            "model_name": F.lit(model_name),
            "predicted_risk_label_name": map_values("predicted_label", LABEL_NAMES),
            "predicted_risk_score_0_10": F.col("p1") * 5 + F.col("p2") * 10,
            "alert_flag": flag(F.col("predicted_label") > 0),
            "high_risk_alert_flag": flag(F.col("predicted_label") == 2),
        }
    )
