"""Descriptive reports over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.functions.scalars import safe_divide
from riskloom.operators.quantiles import exact_percentiles


def metric_rows(one_row: DataFrame) -> DataFrame:
    """A one-row frame of numbers as (metric, value)."""
    names = one_row.columns
    return one_row.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        )
    )


def kpis(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Global aggregates as metric/value rows."""
    return metric_rows(df.agg(*[c.alias(n) for n, c in metrics.items()]))


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None, only_missing: bool = True) -> DataFrame:
    """Missing share per column in percent; by default only columns with gaps."""
    cols = list(columns or df.columns)
    shares = kpis(df, {c: F.avg(F.col(c).isNull().cast("int")) * 100 for c in cols})
    out = shares.select(F.col("metric").alias("column"), F.col("value").alias("missing_pct"))
    return out.where("missing_pct > 0") if only_missing else out


def profile(df: DataFrame, name: str = "table") -> DataFrame:
    """Rows, columns, repeated rows and overall missing share.

    Equal rows are counted by a grouped aggregate over all columns, so heavy
    repetition shrinks before the shuffle.
    """
    cols = df.columns
    nulls = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    per_row = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).withColumn("_nulls", nulls)
    return per_row.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"),
        F.lit(len(cols)).alias("column_count"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
        safe_divide(F.sum(F.col("_nulls") * F.col("_n")) * 100, F.sum("_n") * len(cols)).alias("missing_cells_pct"),
    ).select(F.lit(name).alias("table_name"), "*")


def describe(df: DataFrame, columns: Sequence[str], points: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles, one row per column."""
    stats = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    flat = df.agg(*[fn(F.col(c).cast("double")).alias(f"{s}__{c}") for c in columns for s, fn in stats.items()])
    basic = flat.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{s}__{c}").alias(s) for s in stats]) for c in columns])
        )
    )
    marks = exact_percentiles(df, [], columns, points)
    wide = marks.groupBy("column").agg(
        *[F.max(F.when(F.col("point") == p, F.col("value"))).alias(f"p{round(p * 100)}") for p in points]
    )
    return basic.join(wide, "column", "left")


def numeric_quality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and extremes per column."""
    flat = df.agg(
        *[
            e
            for c in columns
            for e in (
                F.count_if(F.col(c).isNull()).alias(f"m__{c}"),
                F.min(F.col(c).cast("double")).alias(f"lo__{c}"),
                F.max(F.col(c).cast("double")).alias(f"hi__{c}"),
            )
        ]
    )
    return flat.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"m__{c}").alias("missing_values"),
                        F.col(f"lo__{c}").alias("minimum"),
                        F.col(f"hi__{c}").alias("maximum"),
                    )
                    for c in columns
                ]
            )
        )
    )


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence) -> DataFrame:
    """Counts by row label and column label, zero where a pair is absent."""
    return df.groupBy(rows).pivot(cols, list(values)).count().fillna(0)


def label_distribution(
    df: DataFrame, label: str, labels: Sequence[int] | None = None, by: str | None = None
) -> DataFrame:
    """Rows and share per label. With ``labels`` absent classes appear with 0; without it a null class is kept."""
    keys = [by] if by else []
    counts = df.groupBy(*keys, F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    totals = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_all"))
    if labels is not None:
        # the label list is a handful of constants
        wanted = totals.withColumn("label", F.explode(F.array(*[F.lit(v) for v in labels])))
        full = wanted.join(counts, [*keys, "label"], "left").fillna(0, subset=["row_count"])
    elif keys:
        full = counts.join(totals, keys)
    else:
        full = counts.withColumn("_all", totals.scalar())
    return full.select(*keys, "label", "row_count", safe_divide("row_count", "_all").alias("share"))


def reconcile(a: DataFrame, b: DataFrame, columns: Sequence[str], tol: float = 0.01) -> DataFrame:
    """Totals of two grains side by side."""
    left = a.agg(*[F.sum(c).cast("double").alias(f"a__{c}") for c in columns])
    right = b.agg(F.struct(*[F.sum(c).cast("double").alias(c) for c in columns]).alias("_b"))
    rows = [
        F.struct(
            F.lit(c).alias("measure"),
            F.col(f"a__{c}").alias("detail_total"),
            F.col(f"_b.{c}").alias("summary_total"),
            (F.col(f"_b.{c}") - F.col(f"a__{c}")).alias("difference"),
        )
        for c in columns
    ]
    return left.withColumn("_b", right.scalar()).select(F.inline(F.array(*rows))).withColumn(
        "passed", F.abs("difference") <= tol
    )


def coverage_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Available and non-zero share per column in percent."""
    flat = df.agg(
        *[
            e
            for c in columns
            for e in (
                (F.avg(F.col(c).isNotNull().cast("int")) * 100).alias(f"a__{c}"),
                (F.avg(F.coalesce(F.col(c) != 0, F.lit(False)).cast("int")) * 100).alias(f"z__{c}"),
            )
        ]
    )
    return flat.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"a__{c}").alias("available_rows_pct"),
                        F.col(f"z__{c}").alias("non_zero_rows_pct"),
                    )
                    for c in columns
                ]
            )
        )
    )


def shares(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Mean of each condition (unknown counts as false), globally or per group."""
    aggs = [F.avg(F.coalesce(c, F.lit(False)).cast("int")).alias(n) for n, c in conditions.items()]
    return df.groupBy(*by).agg(*aggs)


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Wide to long: (ids, metric, value)."""
    return df.unpivot(list(ids), list(columns), "metric", "value")
