"""Random-forest candidates and their interpretation."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from riskloom.operators.ranks import numbered
from riskloom.operators.sets import union_all
from riskloom.plans.history import TARGET
from riskloom.plans.learning import RISK_LABELS, balanced_weights, feature_family, ranked_features, score_model
from riskloom.plans.metrics import confusion_cells, evaluate, summary_columns
from riskloom.session import materialize, shared_dir

# Settings of the selected forest.
FOREST_DEFAULTS = {"numTrees": 220, "maxDepth": 14, "minInstancesPerNode": 3, "featureSubsetStrategy": "sqrt", "seed": 42}

FOREST_ORDER = ("-high_risk_pr_auc", "-high_risk_f2", "-macro_f1", "log_loss", "model")


def fit_one_forest(train: DataFrame, target: str = TARGET, balanced: bool = True, **params) -> RandomForestClassificationModel:
    """One forest on ``features``; class balance is by row weights over the whole training set."""
    labelled = train.withColumn("label", F.col(target).cast("double"))
    settings = {**FOREST_DEFAULTS, **params}
    if balanced:
        labelled = balanced_weights(labelled, target)
        settings["weightCol"] = "weight"
    return RandomForestClassifier(**settings).fit(labelled)


def fit_forest(
    train: DataFrame, validation: DataFrame, grid: Sequence[dict], target: str = TARGET
) -> tuple[dict[str, RandomForestClassificationModel], DataFrame]:
    """Fit every candidate; validation metrics ordered best first."""
    models, rows = {}, []
    for i, params in enumerate(grid):
        name = f"forest_{i}"
        models[name] = fit_one_forest(train, target, **params)
        scored = score_model(validation.withColumn("actual_label", F.col(target)), models[name])
        rows.append(evaluate(scored, name, "validation"))
    order = [F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in FOREST_ORDER]
    return models, union_all(*rows).orderBy(*order)


def impurity_importance(spark: SparkSession, model: RandomForestClassificationModel, features: Sequence[str]) -> DataFrame:
    """Importance per feature with family and rank (one row per feature)."""
    values = model.featureImportances.toArray()
    rows = [(f, feature_family(f), float(values[i])) for i, f in enumerate(features)]
    table = spark.createDataFrame(rows, "feature string, feature_family string, importance double")
    return ranked_features(table, "importance")


def family_importance(importance: DataFrame) -> DataFrame:
    total = importance.agg(F.sum("importance")).scalar()
    return importance.groupBy("feature_family").agg(F.sum("importance").alias("importance")).withColumn(
        "_total", total
    ).select("feature_family", "importance", (F.col("importance") / F.nullif(F.col("_total"), F.lit(0.0))).alias("share"))


def permutation_importance(
    model: RandomForestClassificationModel, validation: DataFrame, features: Sequence[str], keys: Sequence[str],
    target: str = TARGET, seed: int = 42, only: Sequence[str] | None = None,
) -> DataFrame:
    """Loss of validation macro F1 when one feature is shuffled between rows.

    Rows are numbered twice, in key order and in a seeded hash order; joining the
    two numberings pairs each row with a random other row. Each feature is then
    replaced from that partner and rescored.
    """
    base = validation.select(*keys, target, "features")
    in_order = numbered(base, [F.col(k) for k in keys], "_n", "perm-order")
    shuffled = numbered(
        base.select(*keys, F.col("features").alias("_other")), [F.xxhash64(*keys, F.lit(seed)), *[F.col(k) for k in keys]],
        "_n", "perm-shuffle",
    ).select("_n", "_other")
    paired = in_order.join(shuffled, "_n").withColumn("actual_label", F.col(target).cast("int")).withColumns(
        {"_own": vector_to_array("features"), "_other": vector_to_array("_other")}
    ).drop("features")

    # written once; every row is then scored with each feature swapped (and once as it is,
    # number -1) in one pass, which only shuffles nine counts per feature and task
    paired = materialize(paired, "perm-pairs")
    numbers = [i for i, f in enumerate(features) if only is None or f in only]
    i = F.col("_feature")
    mixed = F.when(i < 0, F.col("_own")).otherwise(F.transform("_own", lambda x, k: F.when(k == i, F.get("_other", k)).otherwise(x)))
    swapped = paired.withColumn("_feature", F.explode(F.array(*[F.lit(n) for n in [-1, *numbers]]))).withColumn("features", array_to_vector(mixed))
    cells = confusion_cells(score_model(swapped.select("_feature", "actual_label", "features"), model), ["_feature"])
    rated = materialize(cells.select("_feature", summary_columns()["macro_f1"].alias("macro_f1")), "perm-scores")
    baseline = rated.where("_feature < 0").select("macro_f1").scalar()
    names = F.array(*[F.lit(f) for f in features])
    scored = rated.where("_feature >= 0").select(
        F.get(names, F.col("_feature")).alias("feature"), "macro_f1", baseline.alias("baseline_macro_f1")
    )
    return ranked_features(
        scored.withColumn("importance", F.col("baseline_macro_f1") - F.col("macro_f1")), "importance"
    )


def tree_nodes(model: RandomForestClassificationModel, path: str | None = None) -> DataFrame:
    """Node table of a saved forest: (tree_id, id, feature, threshold, left_id, right_id, share0..2)."""
    spark = SparkSession.getActiveSession()
    path = path or f"{shared_dir(spark)}/riskloom/forest-{model.uid}"
    model.write().overwrite().save(path)
    raw = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    total = F.aggregate("impurityStats", F.lit(0.0), lambda a, b: a + b)
    return raw.select(
        F.col("treeID").alias("tree_id"),
        "id",
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
        F.col("leftChild").alias("left_id"),
        F.col("rightChild").alias("right_id"),
        *[(F.get(F.col("impurityStats"), F.lit(k)) / total).alias(f"share{k}") for k in RISK_LABELS],
    )


def _tree_arrays(nodes: DataFrame) -> list[tuple]:
    """Node table as numpy arrays per tree. Its size is that of the model, which the driver already holds."""
    table = nodes.orderBy("tree_id", "id").toPandas()
    trees = []
    for _, t in table.groupby("tree_id", sort=True):
        trees.append(
            (
                t["feature"].fillna(-1).to_numpy(dtype=np.int64),
                t["threshold"].fillna(0.0).to_numpy(dtype=np.float64),
                t["left_id"].to_numpy(dtype=np.int64),
                t["right_id"].to_numpy(dtype=np.int64),
                t[[f"share{k}" for k in RISK_LABELS]].to_numpy(dtype=np.float64),
            )
        )
    return trees


def _follow_paths(x: np.ndarray, cls: np.ndarray, trees: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Base value per row and contribution per row and feature, averaged over trees."""
    moved = np.zeros(x.shape)
    base = np.zeros(len(x))
    for feature, threshold, left, right, share in trees:
        at = np.zeros(len(x), dtype=np.int64)
        base += share[0, cls]
        rows = np.flatnonzero(feature[at] >= 0)
        while len(rows):
            here = at[rows]
            f = feature[here]
            child = np.where(x[rows, f] <= threshold[here], left[here], right[here])
            moved[rows, f] += share[child, cls[rows]] - share[here, cls[rows]]
            at[rows] = child
            rows = rows[feature[child] >= 0]
    return base / len(trees), moved / len(trees)


def path_contributions(
    model: RandomForestClassificationModel, rows: DataFrame, keys: Sequence[str], features: Sequence[str],
    explained: str = "predicted_label",
) -> tuple[DataFrame, DataFrame]:
    """Per-row, per-feature contributions to the probability of the explained class, and a sum check.

    Each partition walks its rows through the trees in Arrow batches; the trees
    are broadcast, which the model's own scoring does as well. Base value plus
    contributions equals the forest's probability of that class.
    """
    trees = rows.sparkSession.sparkContext.broadcast(_tree_arrays(tree_nodes(model)))
    chosen = F.get(F.array("p0", "p1", "p2"), F.col(explained))
    slim = rows.select(*keys, explained, chosen.alias("probability"), vector_to_array("features").alias("_x"))
    kept = [*keys, explained, "probability"]

    def walk(batches):
        for batch in batches:
            x = np.stack(batch["_x"].to_numpy())
            base, moved = _follow_paths(x, batch[explained].to_numpy(dtype=np.int64), trees.value)
            used = [np.flatnonzero(r) for r in moved]
            out = batch[kept].copy()
            out["base_value"] = base
            out["contribution_sum"] = moved.sum(axis=1)
            out["_features"] = [u.astype(np.int32) for u in used]
            out["_deltas"] = [r[u] for r, u in zip(moved, used)]
            yield out

    schema = ", ".join(
        [
            *[f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields if f.name in kept],
            "base_value double", "contribution_sum double", "_features array<int>", "_deltas array<double>",
        ]
    )
    walked = slim.mapInPandas(walk, schema)
    names = F.array(*[F.lit(f) for f in features])
    contributions = walked.select(
        *keys, explained, F.inline(F.arrays_zip("_features", "_deltas"))
    ).select(*keys, explained, F.get(names, F.col("_features")).alias("feature"), F.col("_deltas").alias("contribution"))
    gap = F.abs(F.col("probability") - F.col("base_value") - F.col("contribution_sum"))
    check = walked.select(*kept, "base_value", "contribution_sum").withColumn("passed", gap < 1e-6)
    return contributions, check


def top_drivers(contributions: DataFrame, keys: Sequence[str], n: int = 5) -> DataFrame:
    """The n strongest contributions per row, ranked (a row has at most one entry per feature)."""
    best = F.slice(
        F.reverse(F.array_sort(F.collect_list(F.struct(F.abs("contribution").alias("size"), "feature", "contribution")))), 1, n
    )
    return contributions.groupBy(*keys).agg(best.alias("_d")).select(*keys, F.posexplode("_d").alias("pos", "d")).select(
        *keys, (F.col("pos") + 1).alias("driver_rank"), "d.feature", "d.contribution"
    )
