"""History features over an ordered, gap-free series.

All expressions of one history share a single window specification, so Spark
plans one exchange and one sort for all of them. Histories hold one row per
period, hence their length is bounded by the number of periods.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from riskloom.functions.dates import month_index
from riskloom.functions.scalars import clip, half_even, safe_divide

HISTORY_KEYS = ("product_id", "region_id")
PERIOD = "year_month"

_AGGREGATES = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum}


class History:
    """Series keyed by ``keys`` and ordered by ``period``."""

    def __init__(self, keys: Sequence[str] = HISTORY_KEYS, period: str = PERIOD):
        self.keys = tuple(keys)
        self.period = period

    @property
    def spec(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(self.period)

    def _prior(self, n: int, gap: int) -> WindowSpec:
        return self.spec.rowsBetween(-(n + gap - 1), -gap)

    def lag(self, c: Column | str, k: int = 1) -> Column:
        return F.lag(c, k).over(self.spec)

    def lead(self, c: Column | str, k: int = 1) -> Column:
        return F.lead(c, k).over(self.spec)

    def rolling(self, c: Column | str, n: int, min_periods: int, how: str = "mean", gap: int = 1) -> Column:
        """Statistic over the n periods ending ``gap`` periods back; null below ``min_periods`` values."""
        frame = self._prior(n, gap)
        return F.when(F.count(c).over(frame) >= min_periods, _AGGREGATES[how](c).over(frame))

    def slope(self, c: Column | str, n: int) -> Column:
        """Least-squares slope per period over the n prior periods; full windows only."""
        frame = self._prior(n, 1)
        value = F.col(c) if isinstance(c, str) else c
        fitted = F.regr_slope(value, month_index(self.period)).over(frame)
        return F.when(F.count(value).over(frame) >= n, fitted)

    def growth(self, c: Column | str, k: int = 1) -> Column:
        """Relative change against the value k periods back; null when that is zero or missing."""
        value = F.col(c) if isinstance(c, str) else c
        prior = self.lag(value, k)
        return safe_divide(value - prior, prior)

    def diff(self, c: Column | str) -> Column:
        value = F.col(c) if isinstance(c, str) else c
        return value - self.lag(value, 1)

    def pct_change(self, c: Column | str, bound: float = 50.0, digits: int = 2) -> Column:
        """Percent change, first value 0, clipped to ±bound, rounded half to even."""
        return half_even(clip(F.coalesce(self.growth(c) * 100, F.lit(0.0)), -bound, bound), digits)

    def is_last(self) -> Column:
        """True on the final row of each series."""
        return F.lead(F.lit(1)).over(self.spec).isNull()


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``.

    Uses min_by/max_by, which combine map-side, so many copies of one key never
    meet in a single sort.
    """
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    row = F.struct(*[F.col(c) for c in df.columns])
    pick = F.max_by(row, rank) if last else F.min_by(row, rank)
    return df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        pick.alias("_row")
    ).select("_row.*")


def share_of_group(df: DataFrame, c: str, by: Sequence[str], out: str) -> DataFrame:
    """Value as a share of its group total (null when the total is 0)."""
    totals = df.groupBy(*by).agg(F.sum(c).alias("_group_total"))
    return df.join(totals, list(by), "left").withColumn(out, safe_divide(c, "_group_total")).drop("_group_total")


def index_to_mean(
    df: DataFrame, c: str, by: Sequence[str], out: str, hi: float, neutral: float | None = None
) -> DataFrame:
    """100 × value / group mean, clipped to [0, hi], two decimals half-even.

    ``neutral`` is the value for groups whose mean is 0; without it such rows are 0.
    """
    means = df.groupBy(*by).agg(F.avg(c).alias("_group_mean"))
    joined = df.join(means, list(by), "left")
    ratio = safe_divide(F.col(c) * 100, "_group_mean")
    filled = F.coalesce(F.when(F.col("_group_mean") == 0, F.lit(neutral)), ratio, F.lit(0.0))
    return joined.withColumn(out, half_even(clip(filled, 0.0, hi), 2)).drop("_group_mean")


def minmax_log(df: DataFrame, c: str, out: str) -> DataFrame:
    """log1p scaled to [0, 1] over the whole set; the bounds are one two-value aggregate."""
    logged = F.log1p(F.col(c).cast("double"))
    bounds = df.agg(F.struct(F.min(logged).alias("lo"), F.max(logged).alias("hi")).alias("b"))
    return (
        df.withColumn("_bounds", bounds.scalar())
        .withColumn(out, (logged - F.col("_bounds.lo")) / F.greatest(F.col("_bounds.hi") - F.col("_bounds.lo"), F.lit(1e-9)))
        .drop("_bounds")
    )
