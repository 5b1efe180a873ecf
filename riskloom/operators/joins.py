"""Lookup, membership and coverage joins.

No side is force-broadcast: Spark picks a broadcast join from size statistics
(at planning time for files, at run time for shuffled inputs) and falls back to
a shuffle join, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def key_violations(df: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Key values that occur more than once (empty when ``on`` is unique)."""
    return df.groupBy(*_keys(on)).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 1")


def require_unique(df: DataFrame, on: str | Sequence[str], side: str = "right") -> None:
    """Raise when the key repeats; shows at most ten keys."""
    bad = key_violations(df, on).limit(10).collect()
    if bad:
        raise ValueError(f"{side} side is not unique on {_keys(on)}: {[r.asDict() for r in bad]}")


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    columns: Sequence[str] | None = None,
    enforce: bool = False,
    salt: int = 0,
    salt_by: Sequence[str] | None = None,
) -> DataFrame:
    """m:1 left join. With a unique ``dim`` key the row count cannot change.

    ``salt`` > 1 spreads each key of ``df`` over that many sub-keys (chosen from
    a hash of ``salt_by``) and repeats ``dim`` once per sub-key, for hot keys in
    plans where adaptive skew splitting does not apply.
    """
    keys = _keys(on)
    right = dim.select(*keys, *columns) if columns is not None else dim
    if enforce:
        require_unique(right, keys)
    if salt > 1:
        by = list(salt_by or df.columns)
        left = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salt)).cast("int"))
        right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        return left.join(right, [*keys, "_salt"], "left").drop("_salt")
    return df.join(right, keys, "left")


def one_to_one(left: DataFrame, right: DataFrame, on: str | Sequence[str], enforce: bool = False) -> DataFrame:
    """1:1 left join; ``enforce`` checks both sides."""
    if enforce:
        require_unique(left, on, "left")
        require_unique(right, on, "right")
    return left.join(right, _keys(on), "left")


def join_growth(before: DataFrame, after: DataFrame) -> DataFrame:
    """Row counts around a join: one row (rows_before, rows_after, passed)."""
    b = before.agg(F.count(F.lit(1)).alias("n"))
    return after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        b.scalar().alias("rows_before"), "rows_after"
    ).withColumn("passed", F.col("rows_before") == F.col("rows_after"))


def spread_over(df: DataFrame, domain: DataFrame, buckets: int | None = None) -> DataFrame:
    """Every row of ``df`` with every row of ``domain``.

    This is only for grids whose output is the wanted result. It is an equi-join
    on a hash bucket of the domain, so a domain too large to broadcast is still
    spread over ``buckets`` tasks (more when adaptive execution splits them).
    By default there are as many buckets as the domain has rows, at most 16, so a
    small domain does not copy the left side more often than it has rows.
    """
    if buckets is None:
        buckets = max(1, domain.limit(16).count())
    left = df.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    right = domain.withColumn("_slot", F.pmod(F.xxhash64(*domain.columns), F.lit(buckets)).cast("int"))
    return left.join(right, "_slot").drop("_slot")


def missing_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    keys = _keys(on)
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, nullable: bool = False) -> DataFrame:
    """Fact rows whose key has no match. Null keys count only when the key is not nullable."""
    probe = dim.select(F.col(dim_key or key).alias("_dim_key"))
    rows = fact.where(F.col(key).isNotNull()) if nullable else fact
    return rows.join(probe, rows[key] == probe["_dim_key"], "left_anti")


def require_match(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Mandatory lookup key: raises with at most ten unmatched values, else returns ``df``."""
    unmatched = missing_keys(df, dim, key).limit(10).collect()
    if unmatched:
        raise ValueError(f"{key} has unmatched values: {[r[0] for r in unmatched]}")
    return df


def region_with_fallback(df: DataFrame, customers: DataFrame, reps: DataFrame) -> DataFrame:
    """Region of the customer, else of the sales representative."""
    by_customer = customers.select("customer_id", F.col("region_id").alias("_customer_region"))
    by_rep = reps.select("sales_rep_id", F.col("region_id").alias("_rep_region"))
    joined = df.join(by_customer, "customer_id", "left").join(by_rep, "sales_rep_id", "left")
    return joined.withColumn("region_id", F.coalesce("_customer_region", "_rep_region")).drop(
        "_customer_region", "_rep_region"
    )


def join_back(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Group aggregates attached to every detail row.

    Aggregate-then-join instead of an un-ordered window: the aggregate combines
    before it shuffles, so a group holding most rows is never collected in one task.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggs.items()])
    return df.join(totals, list(keys), "left")


def coverage(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Share of ``left`` rows that find a match: (row_count, matched_rows, coverage_pct)."""
    keys = _keys(on)
    marked = left.select(*keys).join(right.select(*keys).distinct().withColumn("_hit", F.lit(1)), keys, "left")
    return marked.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("_hit").alias("matched_rows"),
        (F.count("_hit") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100).alias("coverage_pct"),
    )


def canonical_label(df: DataFrame, dim: DataFrame, column: str, enforce: bool = True) -> DataFrame:
    """Replace a label by the dimension's spelling, matched without regard to case.

    Raises when two spellings of the dimension differ by case only, or when a
    known label of ``df`` is not in the dimension; without ``enforce`` the
    smallest spelling is taken and an unknown label becomes null.
    """
    if enforce:
        clash = collapsing_labels(dim, column).limit(10).collect()
        if clash:
            raise ValueError(f"{column} has spellings that differ by case only: {[r[0] for r in clash]}")
        strange = unknown_labels(df, dim, column).limit(10).collect()
        if strange:
            raise ValueError(f"{column} has unknown labels: {[r[0] for r in strange]}")
    labels = dim.groupBy(F.lower(column).alias("_label_key")).agg(F.min(column).alias("_canonical"))
    rest = [c for c in df.columns if c != column]
    return (
        df.withColumn("_label_key", F.lower(column))
        .join(labels, "_label_key", "left")
        .select(*rest, F.col("_canonical").alias(column), F.col(column).alias(f"{column}_raw"))
    )


def unknown_labels(df: DataFrame, dim: DataFrame, column: str) -> DataFrame:
    """Labels of ``df``, without regard to case, that the dimension lacks: (label_key, row_count)."""
    counted = df.where(F.col(column).isNotNull()).groupBy(F.lower(column).alias("label_key")).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.join(dim.select(F.lower(column).alias("label_key")).distinct(), "label_key", "left_anti")


def collapsing_labels(dim: DataFrame, column: str) -> DataFrame:
    """Canonical labels that differ only by case."""
    return (
        dim.select(column).distinct().groupBy(F.lower(column).alias("label_key"))
        .agg(F.count(F.lit(1)).alias("spellings")).where("spellings > 1")
    )
