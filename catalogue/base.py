"""Query registration, shared stages and result formatting."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.model_sql import NUMERIC, with_ctes
from riskloom.plans.history import TARGET
from riskloom.plans.learning import arg_max_label, fit_preparation, time_split, transform, vectorised
from riskloom.plans.monthly import customer_product_monthly
from riskloom.session import materialize
from riskloom.sources.star import Star

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_STAGES: dict[tuple, DataFrame] = {}
_MODELS: dict[tuple, object] = {}


# Results are rounded to multiples of a power of two, about as fine as the decimal places
# asked for, and large ones to multiples of 1/1024, which is some twelve digits of a
# revenue total. Sums, means and ratios of prices sit exactly half way between two
# decimals quite often, where the order of a sum decides; half way between two multiples
# of a power of two they hardly ever do.
_LARGE, _LARGE_STEP = 4096.0, 1024.0


def _step(digits: int) -> float:
    return float(2 ** round(digits * 10 / 3))


def presented(df: DataFrame, digits: int = 6) -> DataFrame:
    """Fractional columns as doubles on the binary grid, without negative zero."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("double", "float", "decimal"):
            value = F.col(f"`{f.name}`").cast("double")
            step = F.when(F.abs(value) >= _LARGE, min(_LARGE_STEP, _step(digits))).otherwise(_step(digits))
            cols.append((F.rint(value * step) / step + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def _presented_sql(column: str, digits: int) -> str:
    value = f"CAST({column} AS DOUBLE)"
    step = f"CAST(CASE WHEN abs({value}) >= {_LARGE} THEN {min(_LARGE_STEP, _step(digits))} ELSE {_step(digits)} END AS DOUBLE)"
    return f"round_even({value} * {step}, 0) / {step} + CAST(0 AS DOUBLE) AS {column}"


def query(name: str, sql: str | None = None, rounded: str = "", digits: int = 6):
    """Register a function of a Star as a query; ``rounded`` lists the fractional columns of the SQL."""

    def register(fn: Callable[[Star], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, directory: str) -> DataFrame:
            return presented(fn(Star(spark, directory)), digits)

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            body = sql.strip().rstrip(";")
            if rounded:
                swaps = ", ".join(_presented_sql(c, digits) for c in rounded.split())
                body = f"SELECT * REPLACE ({swaps}) FROM ({body})"
            ORACLES[name] = with_ctes(body)
        return fn

    return register


def _stage(star: Star, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage written once per application and data set and shared by the queries that read it."""
    key = (star.spark.sparkContext.applicationId, star.directory, label)
    if key not in _STAGES:
        _STAGES[key] = materialize(build(), label)
    return _STAGES[key]


def written(star: Star) -> Star:
    """The star with its order lines, representatives and monthly base written once, when first read."""
    return star.written(lambda df, label: _stage(star, label, lambda: df))


def panel(star: Star) -> DataFrame:
    return _stage(star, "panel", lambda: written(star).panel())


def labelled(star: Star) -> DataFrame:
    return _stage(star, "labelled", lambda: written(star).labelled())


def customer_months(star: Star) -> DataFrame:
    """Not written: its readers take a few sums by panel key from as many rows as sales has."""
    return customer_product_monthly(written(star).sales)


def features(star: Star) -> DataFrame:
    return _stage(star, "features", lambda: written(star).features(panel(star), customer_months(star)))


def predictions(star: Star) -> DataFrame:
    """Class probabilities by a fixed rule on the pressure score, with keys and outcome.

    A deterministic stand-in for a fitted model, so that everything computed from
    probabilities can be checked in SQL.
    """
    def build():
        score = F.least(F.lit(100), F.floor(F.round(F.col("commercial_pressure_score") * 1.1, 6))).cast("int")
        s2 = F.col("s2")
        return (
            features(star)
            .withColumn("s2", score)
            .select(
                "product_id", "region_id", "year_month", "target_month", F.col(TARGET).alias("actual_label"),
                "revenue_at_risk_proxy", "revenue", "units_sold", "s2", (s2 / 100.0).alias("p2"),
                ((100 - s2) * (20 + s2 % 60) / 10000.0).alias("p1"),
            )
            .withColumn("p0", 1 - F.col("p2") - F.col("p1"))
            .withColumn("predicted_label", arg_max_label())
            .drop("s2")
        )

    return _stage(star, "predictions", build)


def split_features(star: Star) -> DataFrame:
    """Feature table with its chronological split."""
    return time_split(features(star))


def prepared(star: Star) -> DataFrame:
    """Imputed and standardised numeric features fitted on the training months."""
    def build():
        rows = split_features(star)
        state = fit_preparation(rows.where("split = 'train'"), NUMERIC, [])
        return transform(rows, state, ["product_id", "region_id", "year_month", "target_month", "split", TARGET])

    return _stage(star, "prepared", build)


def fitted(star: Star, label: str, fit: Callable[[], object]):
    """A model fitted once per application and data set and shared by the queries that use it."""
    key = (star.spark.sparkContext.applicationId, star.directory, label)
    if key not in _MODELS:
        _MODELS[key] = fit()
    return _MODELS[key]


# Features of the fitted-model queries.
MODEL_NUMERIC = NUMERIC
MODEL_CATEGORICAL = ("lifecycle_stage", "campaign_channel", "dominant_rep_seniority")


def matrix(star: Star) -> tuple[DataFrame, list[str]]:
    """Vector matrix of all splits and its feature names."""
    rows = split_features(star)
    state = fit_preparation(rows.where("split = 'train'"), MODEL_NUMERIC, MODEL_CATEGORICAL)
    keep = ["product_id", "region_id", "year_month", "target_month", "split", TARGET]

    def build():
        flat = transform(rows, state, keep, prefix="f_")
        return vectorised(flat, [f"f_{n}" for n in state.feature_names], keep)

    return _stage(star, "matrix", build), state.feature_names
