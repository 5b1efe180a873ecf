"""Set operations and ordered limits."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all inputs, matched by column name; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Distinct rows of all inputs; each input is reduced before the union."""
    return union_all(*[d.distinct() for d in dfs]).distinct()


def except_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def set_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row (only_left, only_right, passed)."""
    left = a.subtract(b).agg(F.count(F.lit(1)).alias("only_left"))
    right = b.subtract(a).agg(F.count(F.lit(1)).alias("only_right"))
    return left.select("only_left", right.scalar().alias("only_right")).withColumn(
        "passed", (F.col("only_left") == 0) & (F.col("only_right") == 0)
    )


def date_bounds(*sources: tuple[DataFrame, Column | str]) -> DataFrame:
    """Smallest and largest date over several sources; each source is reduced to one row first."""
    parts = [
        df.agg(F.min(c).alias("first_date"), F.max(c).alias("last_date")) for df, c in sources
    ]
    return union_all(*parts).agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def sort_by(df: DataFrame, *keys: str) -> DataFrame:
    """Multi-key sort; a leading ``-`` means descending with nulls last."""
    return df.orderBy(*[F.desc_nulls_last(k[1:]) if k.startswith("-") else F.asc_nulls_last(k) for k in keys])


def top_n(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    return sort_by(df, *keys).limit(n)


def best_row(df: DataFrame, criteria: Sequence[str]) -> DataFrame:
    """Best row by lexicographic criteria."""
    return top_n(df, criteria, 1)


def argmax_column(columns: Sequence[str], absolute: bool = True) -> Column:
    """Name of the column with the largest (absolute) value; the earlier column wins a tie."""
    n = len(columns)
    cells = [
        F.struct(
            (F.abs(F.col(c)) if absolute else F.col(c)).alias("v"), F.lit(n - i).alias("p"), F.lit(c).alias("name")
        )
        for i, c in enumerate(columns)
    ]
    return F.array_max(F.array(*cells))["name"]
