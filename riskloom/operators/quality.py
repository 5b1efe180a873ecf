"""Data-quality checks.

A check is a one-row frame (check_name, passed, detail). Checks are lazy; they
combine with ``roll_up`` and only ``enforce`` runs them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskloom.operators.joins import key_violations, orphans
from riskloom.operators.sets import union_all

_CHECK_SCHEMA = "check_name string, passed boolean, detail string"


def _row(df: DataFrame, name: str, passed: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), passed.alias("passed"), detail.cast("string").alias("detail"))


def count_where(cond: Column) -> Column:
    """Rows for which a condition is known to hold."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def check_none(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One check per rule: no row may satisfy it. All rules share one pass over ``df``."""
    counts = df.agg(*[count_where(cond).alias(f"r{i}") for i, cond in enumerate(rules.values())])
    cells = [
        F.struct(F.lit(name).alias("check_name"), (F.col(f"r{i}") == 0).alias("passed"),
                 F.col(f"r{i}").cast("string").alias("detail"))
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*cells)))


def check_columns(spark: SparkSession, tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]]) -> DataFrame:
    """Required tables and columns; reads schemas only."""
    rows = []
    for table, columns in required.items():
        have = tables[table].columns if table in tables else []
        lost = [c for c in columns if c not in have]
        rows.append((table, table in tables and not lost, ", ".join(lost) or "None"))
    return spark.createDataFrame(rows, _CHECK_SCHEMA)


def check_contract(df: DataFrame, ordered: Sequence[str], name: str = "column_contract") -> DataFrame:
    """Exact ordered columns; the detail lists missing and extra ones."""
    missing = [c for c in ordered if c not in df.columns]
    extra = [c for c in df.columns if c not in ordered]
    detail = f"missing: {', '.join(missing) or 'None'}; extra: {', '.join(extra) or 'None'}"
    return df.sparkSession.createDataFrame([(name, list(df.columns) == list(ordered), detail)], _CHECK_SCHEMA)


def check_pk(df: DataFrame, key: str, table: str = "table") -> DataFrame:
    """Primary key complete and unique: (table_name, key_name, row_count, missing_keys, duplicate_keys, passed).

    Distinct keys are counted by a grouped aggregate, which combines map-side.
    """
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col("_key").isNotNull()
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(~known, F.col("_n"))), F.lit(0)).alias("missing_keys"),
        F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("duplicate_keys"),
    ).select(
        F.lit(table).alias("table_name"), F.lit(key).alias("key_name"), "row_count", "missing_keys", "duplicate_keys",
        ((F.col("missing_keys") == 0) & (F.col("duplicate_keys") == 0)).alias("passed"),
    )


def check_grain(df: DataFrame, keys: Sequence[str], table: str = "table") -> DataFrame:
    """Rows beyond the first of each composite key: (table_name, grain, duplicate_keys, passed)."""
    return key_violations(df, keys).agg(
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("duplicate_keys")
    ).select(
        F.lit(table).alias("table_name"), F.lit(" x ".join(keys)).alias("grain"), "duplicate_keys",
        (F.col("duplicate_keys") == 0).alias("passed"),
    )


def check_fks(tables: Mapping[str, DataFrame], relations: Sequence[tuple[str, str, str, str, bool]]) -> DataFrame:
    """Foreign keys (fact, key, dimension, dimension key, nullable): unmatched rows per relation."""
    parts = []
    for fact, key, dim, dim_key, nullable in relations:
        lost = orphans(tables[fact], tables[dim], key, dim_key, nullable).agg(F.count(F.lit(1)).alias("unmatched_rows"))
        parts.append(
            lost.select(
                F.lit(f"{fact}.{key} -> {dim}").alias("relation"), "unmatched_rows",
                (F.col("unmatched_rows") == 0).alias("passed"),
            )
        )
    return union_all(*parts)


def check_dims(dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Key table of the dimensions."""
    return union_all(*[check_pk(df, key, name) for name, (df, key) in dims.items()])


def check_domain(df: DataFrame, columns: Sequence[str], values: Sequence) -> DataFrame:
    """Known values outside the allowed set, per column."""
    rules = {c: F.col(c).isNotNull() & ~F.col(c).isin(*values) for c in columns}
    return check_none(df, rules)


def check_range(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    return check_none(df, {f"{column}_in_range": ~F.col(column).between(lo, hi)})


def check_last_unlabelled(df: DataFrame, keys: Sequence[str], period: str, target: str) -> DataFrame:
    """The last row of every history carries no label."""
    last = df.groupBy(*keys).agg(F.max_by(F.col(target), F.col(period)).alias("_label"))
    return check_none(last, {"last_rows_unlabelled": F.col("_label").isNotNull()})


def check_chronology(df: DataFrame, split: str, period: str, order: Sequence[str]) -> DataFrame:
    """Each split must end before the next begins."""
    spans = df.groupBy(split).agg(F.min(period).alias("lo"), F.max(period).alias("hi"))
    cells = {name: (F.col(split) == name) for name in order}
    flat = spans.agg(
        *[F.max(F.when(c, F.col("lo"))).alias(f"{n}_lo") for n, c in cells.items()],
        *[F.max(F.when(c, F.col("hi"))).alias(f"{n}_hi") for n, c in cells.items()],
    )
    steps = [
        F.struct(
            F.lit(f"{a}_before_{b}").alias("check_name"),
            F.coalesce(F.col(f"{a}_hi") < F.col(f"{b}_lo"), F.lit(False)).alias("passed"),
            F.concat_ws(" / ", F.col(f"{a}_hi").cast("string"), F.col(f"{b}_lo").cast("string")).alias("detail"),
        )
        for a, b in zip(order, order[1:])
    ]
    return flat.select(F.inline(F.array(*steps)))


def check_leakage(
    spark: SparkSession, features: Sequence[str], target: str, identifiers: Sequence[str] = ()
) -> DataFrame:
    """No future value, identifier or target among the features; works on names only."""
    groups = {
        "no_future_features": [c for c in features if c.startswith("future_")],
        "no_identifier_features": [c for c in features if c.endswith("_id") or c in identifiers],
        "no_target_feature": [c for c in features if c == target or "next_month" in c],
        "unique_feature_names": [c for c in set(features) if list(features).count(c) > 1],
    }
    return spark.createDataFrame(
        [(name, not found, ", ".join(found) or "None") for name, found in groups.items()], _CHECK_SCHEMA
    )


def matrix_quality(df: DataFrame, features: Sequence[str], split: str | None = None, target: str | None = None) -> DataFrame:
    """Missing and infinite feature cells and missing targets, per split."""
    def total(conditions):
        return F.sum(reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in conditions]))

    cols = [F.col(c).cast("double") for c in features]
    aggs = [
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(features)).alias("feature_count"),
        F.lit(len(features) - len(set(features))).alias("duplicate_names"),
        total([c.isNull() for c in cols]).alias("missing_feature_values"),
        total([F.isnan(c) | c.isin(float("inf"), float("-inf")) for c in cols]).alias("infinite_feature_values"),
        (count_where(F.col(target).isNull()) if target else F.lit(0).cast("long")).alias("missing_target_values"),
    ]
    return df.groupBy(split).agg(*aggs) if split else df.agg(*aggs)


def check_alignment(spark: SparkSession, matrices: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same ordered feature names in every split."""
    names = list(matrices)
    first = list(matrices[names[0]])
    rows = [(f"{n}_matches_{names[0]}", list(matrices[n]) == first, str(len(matrices[n]))) for n in names[1:]]
    return spark.createDataFrame(rows, _CHECK_SCHEMA)


def roll_up(*checks: DataFrame) -> DataFrame:
    """Union of checks plus a final ``all_checks`` row."""
    every = union_all(*[c.select("check_name", "passed", "detail") for c in checks])
    overall = every.agg(
        F.bool_and("passed").alias("passed"), count_where(~F.col("passed")).cast("string").alias("detail")
    ).select(F.lit("all_checks").alias("check_name"), "passed", "detail")
    return union_all(every, overall)


def enforce(checks: DataFrame) -> DataFrame:
    """Run checks and raise when one fails; the check table is schema-sized."""
    failed = checks.where(~F.coalesce(F.col("passed"), F.lit(False))).limit(20).collect()
    if failed:
        raise AssertionError("failed checks: " + "; ".join(str(r.asDict()) for r in failed))
    return checks
