"""Classification metrics from one prediction frame.

A prediction frame has the integer columns ``actual_label`` and
``predicted_label`` and the probabilities ``p0``, ``p1``, ``p2``. Everything
reads either the 3 × 3 count table or per-score counts, never sorted rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators.ranks import running_totals
from riskloom.operators.sets import best_row, union_all
from riskloom.plans.learning import RISK_LABELS
from riskloom.session import materialize

PROBABILITIES = ("p0", "p1", "p2")
LOG_EPS = 2.220446049250313e-16


def confusion_cells(pred: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The nine counts c<actual><predicted>: one row, or one per group of ``by``."""
    return pred.groupBy(*by).agg(
        *[
            F.count_if((F.col("actual_label") == a) & (F.col("predicted_label") == p)).alias(f"c{a}{p}")
            for a in RISK_LABELS
            for p in RISK_LABELS
        ]
    )


def confusion(pred: DataFrame) -> DataFrame:
    """Complete grid (actual_label, predicted_label, row_count)."""
    cells = [
        F.struct(F.lit(a).alias("actual_label"), F.lit(p).alias("predicted_label"), F.col(f"c{a}{p}").alias("row_count"))
        for a in RISK_LABELS
        for p in RISK_LABELS
    ]
    return confusion_cells(pred).select(F.inline(F.array(*cells)))


def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _class_measures(k: int) -> dict[str, Column]:
    hit = F.col(f"c{k}{k}")
    support = sum((F.col(f"c{k}{p}") for p in RISK_LABELS), F.lit(0))
    claimed = sum((F.col(f"c{a}{k}") for a in RISK_LABELS), F.lit(0))
    return {
        "precision": _zero_if_null(safe_divide(hit, claimed)),
        "recall": _zero_if_null(safe_divide(hit, support)),
        "f1": _zero_if_null(safe_divide(hit * 2, claimed + support)),
        "support": support,
        "claimed": claimed,
    }


def class_report(pred: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined."""
    rows = []
    for k in RISK_LABELS:
        m = _class_measures(k)
        rows.append(
            F.struct(
                F.lit(k).alias("label"), m["precision"].alias("precision"), m["recall"].alias("recall"),
                m["f1"].alias("f1_score"), m["support"].cast("long").alias("support"),
            )
        )
    return confusion_cells(pred).select(F.inline(F.array(*rows)))


def summary_columns() -> dict[str, Column]:
    """Summary metrics over the nine counts (columns c00..c22)."""
    per = {k: _class_measures(k) for k in RISK_LABELS}
    total = sum((per[k]["support"] for k in RISK_LABELS), F.lit(0))
    present = sum((F.when(per[k]["support"] > 0, 1).otherwise(0) for k in RISK_LABELS), F.lit(0))
    seen = sum(
        (F.when(per[k]["support"] + per[k]["claimed"] > 0, 1).otherwise(0) for k in RISK_LABELS), F.lit(0)
    )
    precision, recall = per[2]["precision"], per[2]["recall"]
    false_high = per[2]["claimed"] - F.col("c22")
    flagged = per[1]["claimed"] + per[2]["claimed"]
    return {
        "accuracy": safe_divide(sum((F.col(f"c{k}{k}") for k in RISK_LABELS), F.lit(0)), total),
        "balanced_accuracy": safe_divide(sum((per[k]["recall"] for k in RISK_LABELS), F.lit(0.0)), present),
        "macro_f1": safe_divide(sum((per[k]["f1"] for k in RISK_LABELS), F.lit(0.0)), seen),
        "weighted_f1": safe_divide(sum((per[k]["f1"] * per[k]["support"] for k in RISK_LABELS), F.lit(0.0)), total),
        "high_risk_precision": precision,
        "high_risk_recall": recall,
        "high_risk_f1": per[2]["f1"],
        "high_risk_f2": _zero_if_null(safe_divide(precision * recall * 5, precision * 4 + recall)),
        "alert_rate": safe_divide(flagged, total),
        "high_risk_alert_rate": safe_divide(per[2]["claimed"], total),
        "false_alarm_rate": safe_divide(false_high, total - per[2]["support"]),
    }


def summary_metrics(pred: DataFrame) -> DataFrame:
    """One row of accuracy, F-scores, high-risk metrics and alert rates."""
    return confusion_cells(pred).select(*[c.alias(n) for n, c in summary_columns().items()])


def score_counts(pred: DataFrame) -> DataFrame:
    """(label, score, n, positives) for the one-vs-rest view of every class."""
    cells = [
        F.struct(
            F.lit(k).alias("label"),
            F.col(f"p{k}").cast("double").alias("score"),
            (F.col("actual_label") == k).cast("long").alias("hit"),
        )
        for k in RISK_LABELS
    ]
    return pred.select(F.inline(F.array(*cells))).groupBy("label", "score").agg(
        F.count(F.lit(1)).alias("n"), F.sum("hit").alias("positives")
    )


def roc_auc(pred: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """ROC-AUC per class (null when a class or its complement is absent).

    Mann–Whitney form: for each score, the negatives with a lower score plus
    half of those with the same score.
    """
    runs = running_totals(
        score_counts(pred) if counts is None else counts, ["label"], "score", {"n": F.sum("n"), "positives": F.sum("positives")}
    )
    negatives = F.col("n") - F.col("positives")
    below = F.col("n_before") - F.col("positives_before")
    pairs = F.sum(F.col("positives") * (below + negatives / 2.0))
    return runs.groupBy("label").agg(
        safe_divide(pairs, F.max("positives_all").cast("double") * F.max(F.col("n_all") - F.col("positives_all"))).alias(
            "roc_auc"
        )
    )


def avg_precision(pred: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Step-wise average precision per class; equal scores form one step."""
    runs = running_totals(
        score_counts(pred) if counts is None else counts, ["label"], "score", {"n": F.sum("n"), "positives": F.sum("positives")}, descending=True
    )
    reached = F.col("positives_before") + F.col("positives")
    precision = reached / (F.col("n_before") + F.col("n"))
    return runs.groupBy("label").agg(
        safe_divide(F.sum(F.col("positives") * precision), F.max("positives_all")).alias("average_precision")
    )


def macro(per_class: DataFrame, c: str, out: str) -> DataFrame:
    """Mean over classes, null when any class is undefined."""
    return per_class.agg(F.when(F.count(c) == F.count(F.lit(1)), F.avg(c)).alias(out))


def log_loss(pred: DataFrame, eps: float = LOG_EPS) -> DataFrame:
    """Mean negative log probability of the actual class."""
    truth = F.element_at(F.array(*PROBABILITIES), F.col("actual_label") + 1)
    clipped = F.greatest(F.least(truth, F.lit(1 - eps)), F.lit(eps))
    return pred.agg((-F.avg(F.ln(clipped))).alias("log_loss"))


def check_proba(pred: DataFrame, tol: float = 1e-6) -> DataFrame:
    """Rows whose probabilities do not sum to one: (row_count, bad_rows, passed)."""
    off = F.abs(F.col("p0") + F.col("p1") + F.col("p2") - 1) > tol
    return pred.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.coalesce(off, F.lit(True))).alias("bad_rows")
    ).withColumn("passed", F.col("bad_rows") == 0)


def evaluate(pred: DataFrame, model: str, split: str) -> DataFrame:
    """Full metric row of a model on a split.

    Rows are scored once: five narrow columns are written, and every metric reads
    those; ranks for AUC and average precision start from written counts per score.
    """
    pred = materialize(pred.select("actual_label", "predicted_label", *PROBABILITIES), "scored")
    counts = materialize(score_counts(pred), "score-counts")
    auc = roc_auc(pred, counts)
    ap = avg_precision(pred, counts)
    return summary_metrics(pred).select(
        F.lit(model).alias("model"),
        F.lit(split).alias("split"),
        "*",
        macro(auc, "roc_auc", "v").scalar().alias("macro_roc_auc_ovr"),
        macro(ap, "average_precision", "v").scalar().alias("macro_pr_auc"),
        ap.where("label = 2").select("average_precision").scalar().alias("high_risk_pr_auc"),
        log_loss(pred).scalar().alias("log_loss"),
    )


def select_model(
    results: DataFrame,
    exclude: Sequence[str] = ("majority_class",),
    criteria: Sequence[str] = ("-high_risk_f2", "-macro_f1", "-high_risk_precision", "model"),
) -> DataFrame:
    """Best validation row by F2, then macro F1, then precision; the reference model is left out."""
    return best_row(results.where(~F.col("model").isin(*exclude)), criteria)


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval of k successes in n trials (null when n is 0)."""
    share = safe_divide(k, n)
    z2 = z * z
    scale = F.lit(1.0) + safe_divide(F.lit(z2), n)
    centre = share + safe_divide(F.lit(z2 / 2), n)
    spread = F.sqrt(safe_divide(share * (1 - share), n) + safe_divide(F.lit(z2 / 4), n.cast("double") * n)) * z
    return (centre - spread) / scale, (centre + spread) / scale


def high_risk_intervals(pred: DataFrame, z: float = 1.96) -> DataFrame:
    """Recall and precision of the high-risk class with Wilson intervals."""
    support = F.col("c20") + F.col("c21") + F.col("c22")
    claimed = F.col("c02") + F.col("c12") + F.col("c22")
    rows = []
    for name, n in (("high_risk_recall", support), ("high_risk_precision", claimed)):
        lo, hi = wilson(F.col("c22"), n, z)
        rows.append(
            F.struct(
                F.lit(name).alias("metric"), F.col("c22").alias("successes"), n.alias("trials"),
                safe_divide(F.col("c22"), n).alias("estimate"), lo.alias("lower"), hi.alias("upper"),
            )
        )
    return confusion_cells(pred).select(F.inline(F.array(*rows)))


# --- operating threshold -----------------------------------------------------

def threshold_grid(start: int = 5, stop: int = 95, step: int = 1) -> list[float]:
    """Candidate cut-offs in hundredths."""
    return [i / 100 for i in range(start, stop + 1, step)]


def runner_up() -> Column:
    """Arg-max of the two lower classes (Low wins a tie)."""
    return F.when(F.col("p1") > F.col("p0"), 1).otherwise(0)


def apply_threshold(pred: DataFrame, t: float = 0.43) -> DataFrame:
    """High risk from probability ``t`` on, else the likelier of the other two."""
    return pred.withColumn("predicted_label", F.when(F.col("p2") >= t, 2).otherwise(runner_up()))


def threshold_tradeoff(pred: DataFrame, grid: Sequence[float] | None = None) -> DataFrame:
    """Summary metrics at every candidate threshold.

    Predictions are reduced to counts per (number of thresholds reached, actual,
    runner-up) in one pass; the thresholds are then evaluated on that table of a
    few hundred rows instead of on predictions × thresholds.
    """
    cuts = sorted(grid or threshold_grid())
    reached = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c <= F.col("p2")))
    bins = pred.groupBy(reached.alias("reached"), "actual_label", runner_up().alias("other")).agg(
        F.count(F.lit(1)).alias("n")
    )
    options = F.array(*[F.struct(F.lit(i + 1).alias("pos"), F.lit(float(c)).alias("threshold")) for i, c in enumerate(cuts)])
    placed = bins.withColumn("_t", F.explode(options)).select(
        F.col("_t.threshold").alias("threshold"),
        "actual_label",
        F.when(F.col("reached") >= F.col("_t.pos"), 2).otherwise(F.col("other")).alias("predicted_label"),
        "n",
    )
    cells = placed.groupBy("threshold").agg(
        *[
            F.coalesce(
                F.sum(F.when((F.col("actual_label") == a) & (F.col("predicted_label") == p), F.col("n"))), F.lit(0)
            ).alias(f"c{a}{p}")
            for a in RISK_LABELS
            for p in RISK_LABELS
        ]
    )
    return cells.select("threshold", *[c.alias(n) for n, c in summary_columns().items()])


def tune_threshold(pred: DataFrame, grid: Sequence[float] | None = None, min_recall: float = 0.70) -> DataFrame:
    """Best threshold with enough recall: F2, precision, macro F1, then fewer false alarms."""
    eligible = threshold_tradeoff(pred, grid).where(F.col("high_risk_recall") >= min_recall)
    return best_row(
        eligible, ["-high_risk_f2", "-high_risk_precision", "-macro_f1", "false_alarm_rate", "threshold"]
    )


def lift_table(pred: DataFrame, capacities: Sequence[float] = (0.01, 0.02, 0.05, 0.10, 0.20, 0.30)) -> DataFrame:
    """High-risk capture when only the top share of rows by p2 can be reviewed.

    Rows that share a probability are reviewed together: a tied block counts
    when it starts within the capacity.
    """
    runs = running_totals(
        pred.select("p2", (F.col("actual_label") == 2).cast("long").alias("hit")), [], "p2",
        {"n": F.count(F.lit(1)), "positives": F.sum("hit")}, descending=True,
    )
    options = F.array(*[F.lit(float(c)) for c in capacities])
    inside = runs.withColumn("capacity", F.explode(options)).where(
        F.col("n_before") < F.ceil(F.col("n_all") * F.col("capacity"))
    )
    return inside.groupBy("capacity").agg(
        F.sum("n").alias("reviewed_rows"),
        F.sum("positives").alias("captured_high_risk"),
        F.max("n_all").alias("_n"),
        F.max("positives_all").alias("_p"),
    ).select(
        "capacity", "reviewed_rows", "captured_high_risk",
        safe_divide("captured_high_risk", "reviewed_rows").alias("precision_at_capacity"),
        safe_divide("captured_high_risk", "_p").alias("recall_at_capacity"),
        safe_divide(safe_divide("captured_high_risk", "reviewed_rows"), safe_divide("_p", "_n")).alias("lift"),
    )


def monitor_by_month(pred: DataFrame, month: str = "target_month") -> DataFrame:
    """Alerts, recall, precision and mean high-risk probability per month."""
    high, claimed = F.col("actual_label") == 2, F.col("predicted_label") == 2
    return pred.groupBy(month).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("predicted_label") > 0).alias("alerts"),
        F.count_if(claimed).alias("high_risk_alerts"),
        safe_divide(F.count_if(high & claimed), F.count_if(high)).alias("high_risk_recall"),
        safe_divide(F.count_if(high & claimed), F.count_if(claimed)).alias("high_risk_precision"),
        F.avg("p2").alias("mean_high_risk_probability"),
    )


def counts_frame(spark: SparkSession, cells: dict[str, int]) -> DataFrame:
    """The nine counts from known numbers, for published results without row data."""
    full = {f"c{a}{p}": int(cells.get(f"c{a}{p}", 0)) for a in RISK_LABELS for p in RISK_LABELS}
    return spark.createDataFrame([tuple(full.values())], ", ".join(f"{c} long" for c in full))


def all_results(*results: DataFrame) -> DataFrame:
    return union_all(*results)

