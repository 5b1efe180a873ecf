"""Operational risk tables built from predictions and the feature panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scalars import flag, map_values
from riskloom.operators.quality import check_none
from riskloom.operators.ranks import numbered
from riskloom.operators.sets import sort_by
from riskloom.plans.learning import LABEL_NAMES, arg_max_label

KEYS = ["product_id", "region_id", "year_month"]

# Business indicators; the limits are parameters of ``risk_indicators``.
INDICATORS = (
    "below_trend", "customer_decline", "margin_pressure", "stockout", "competitor_pressure", "campaign_not_converting",
)

ACTIONS = {
    "stockout": "Secure supply",
    "customer_decline": "Contact lost customers",
    "below_trend": "Review sales plan",
    "margin_pressure": "Review price and cost",
    "competitor_pressure": "Prepare competitive offer",
    "campaign_not_converting": "Rework campaign",
}
DEFAULT_ACTION = "Monitor"


def indicator_flags(margin_gap: float = 0.0, rivals: float = 70.0) -> dict[str, Column]:
    no_result = (F.col("campaign_spend_eur") > 0) & (F.coalesce(F.col("demo_requests"), F.lit(0)) == 0)
    return {
        "below_trend": flag(F.col("risk_factor_under_trend") == 1),
        "customer_decline": flag(F.col("risk_factor_customer_drop") == 1),
        "margin_pressure": flag(F.col("actual_margin_gap_vs_target") < margin_gap),
        "stockout": flag(F.col("stockout_flag") == 1),
        "competitor_pressure": flag(F.col("competitor_pressure_index") >= rivals),
        "campaign_not_converting": flag(no_result | (F.col("campaign_active_with_no_sales") == 1)),
    }


def risk_indicators(panel: DataFrame, margin_gap: float = 0.0, rivals: float = 70.0) -> DataFrame:
    """Recognisable conditions as 0/1 columns, their count and a text list."""
    marked = panel.withColumns({f"ind_{k}": c for k, c in indicator_flags(margin_gap, rivals).items()})
    names = F.array(*[F.when(F.col(f"ind_{k}") == 1, F.lit(k)) for k in INDICATORS])
    return marked.withColumns(
        {
            "indicator_count": sum((F.col(f"ind_{k}") for k in INDICATORS), F.lit(0)),
            "indicators": F.concat_ws(", ", F.array_compact(names)),
        }
    )


def recommended_action(rules: Mapping[str, str] = ACTIONS) -> Column:
    """Action of the first rule whose indicator is set."""
    chain = None
    for name, action in rules.items():
        cond = F.col(f"ind_{name}") == 1
        chain = F.when(cond, action) if chain is None else chain.when(cond, action)
    return chain.otherwise(DEFAULT_ACTION)


def dashboard_history(pred: DataFrame, panel: DataFrame, context: Sequence[str]) -> DataFrame:
    """Predictions of every month with names, 0-10 score and business context."""
    extra = panel.select(*KEYS, *context)
    return pred.join(extra, KEYS, "left").withColumns(
        {
            "actual_label_name": map_values("actual_label", LABEL_NAMES),
            "predicted_label_name": map_values("predicted_label", LABEL_NAMES),
            "risk_score_0_10": F.col("p1") * 5 + F.col("p2") * 10,
            "correct_flag": F.when(F.col("actual_label").isNotNull(), flag(F.col("actual_label") == F.col("predicted_label"))),
        }
    )


def current_output(pred: DataFrame, panel: DataFrame, context: Sequence[str], rules: Mapping[str, str] = ACTIONS) -> DataFrame:
    """Rows waiting for their outcome, with indicators and a recommended action."""
    current = pred.where(F.col("actual_label").isNull())
    enriched = risk_indicators(panel).withColumn("recommended_action", recommended_action(rules))
    extra = enriched.select(*KEYS, *context, "indicator_count", "indicators", "recommended_action")
    return current.join(extra, KEYS, "left").withColumns(
        {
            "predicted_label_name": map_values("predicted_label", LABEL_NAMES),
            "risk_score_0_10": F.col("p1") * 5 + F.col("p2") * 10,
        }
    )


def alert_queue(output: DataFrame, exposure: str = "revenue_at_risk_proxy") -> DataFrame:
    """Medium and High rows with a review priority: class, probability, exposure, key."""
    alerts = output.where(F.col("predicted_label") > 0)
    order = [
        F.desc("predicted_label"), F.desc("p2"), F.desc_nulls_last(exposure), *[F.asc(k) for k in KEYS]
    ]
    return numbered(alerts, order, "priority", "alerts")


def top_high_risk(output: DataFrame, n: int = 20) -> DataFrame:
    """Most probable High-Risk rows of the latest month."""
    latest = output.agg(F.max("year_month")).scalar()
    high = output.withColumn("_latest", latest).where(
        (F.col("year_month") == F.col("_latest")) & (F.col("predicted_label") == 2)
    )
    return sort_by(high.drop("_latest"), "-p2", *KEYS).limit(n)


def output_checks(pred: DataFrame) -> DataFrame:
    """Probability sums, score range, and reproduction of the label from the probabilities."""
    score = F.col("p1") * 5 + F.col("p2") * 10
    return check_none(
        pred,
        {
            "probabilities_sum_to_one": F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > 1e-6,
            "score_in_range": ~score.between(0, 10),
            "labels_valid": ~F.col("predicted_label").isin(0, 1, 2),
            "prediction_reproduced": F.col("predicted_label") != arg_max_label(),
        },
    )
