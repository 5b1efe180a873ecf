"""Ranks and running totals whose groups may be too large for one task.

A plain ``rank() over (partition by group)`` sorts a whole group in one task.
Here equal values are counted first (map-side combine), each group is cut into
value ranges by mergeable approximate quantiles, running totals are taken
inside a range, and range totals supply the offset. The cut points only decide
where the work runs; the totals are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.session import materialize


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    totals: dict[str, Column],
    descending: bool = False,
    ranges: int = 32,
) -> DataFrame:
    """One row per (keys, value) with the totals of that value and of all values before it.

    ``totals`` maps names to sums over the rows of one value (for example
    ``F.count(F.lit(1))``). For each name the result has ``name`` (this value),
    ``name_before`` (strictly earlier values), ``name_all`` (whole group); also
    ``distinct_before``. Null values are left out.
    """
    keys = list(keys)
    names = list(totals)
    tied = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        *[c.alias(n) for n, c in totals.items()]
    ).withColumn("distinct", F.lit(1).cast("long"))

    steps = [i / ranges for i in range(1, ranges)]
    # negated so that bucket order follows the requested direction
    position = -F.col(value).cast("double") if descending else F.col(value).cast("double")
    cuts = tied.groupBy(*keys).agg(F.percentile_approx(position, steps, 1000).alias("_cuts"))
    if keys:
        spread = tied.join(cuts, keys)
    else:
        spread = tied.withColumn("_cuts", cuts.scalar())
    spread = spread.withColumn("_range", F.size(F.filter("_cuts", lambda x: x < position))).drop("_cuts")

    counted = [*names, "distinct"]
    per_range = spread.groupBy(*keys, "_range").agg(*[F.sum(n).alias(f"{n}_range") for n in counted])
    # at most ``ranges`` rows per group from here on
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_range.select(
        *keys,
        "_range",
        *[F.coalesce(F.sum(f"{n}_range").over(earlier), F.lit(0)).alias(f"{n}_offset") for n in counted],
        *[F.sum(f"{n}_range").over(whole).alias(f"{n}_all") for n in names],
    )
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.select(
        *keys,
        value,
        "_range",
        *names,
        *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"{n}_local") for n in counted],
    )
    return local.join(offsets, [*keys, "_range"]).select(
        *keys,
        value,
        *names,
        *[(F.col(f"{n}_local") + F.col(f"{n}_offset")).alias(f"{n}_before") for n in counted],
        *[f"{n}_all" for n in names],
    )


def group_ranks(df: DataFrame, keys: Sequence[str], value: str, descending: bool = False, ranges: int = 32) -> DataFrame:
    """Ranks per distinct value: dense, competition, average, and average rank as a share.

    Join back on (keys, value); null values have no rank.
    """
    runs = running_totals(df, keys, value, {"ties": F.count(F.lit(1))}, descending, ranges)
    average = F.col("ties_before") + (F.col("ties") + 1) / 2.0
    return runs.select(
        *keys,
        value,
        "ties",
        (F.col("distinct_before") + 1).alias("dense_rank"),
        (F.col("ties_before") + 1).alias("min_rank"),
        average.alias("average_rank"),
        (average / F.col("ties_all")).alias("rank_share"),
    )


def numbered(df: DataFrame, order: Sequence[Column], out: str = "row_number", label: str = "numbered") -> DataFrame:
    """Consecutive numbers 1..n in a total order, without a single-task sort.

    Rows are range-partitioned and sorted, the result is written once so that
    both later reads see the same layout, and the number of rows in earlier
    partitions (one small row per partition) is added. End ``order`` with a
    unique key: ties on the whole order make the numbering arbitrary.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    # upper bits: partition, lower 33 bits: position inside it
    stored = materialize(placed, label).withColumn("_part", F.shiftright("_seq", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    position = F.col("_seq") - F.shiftleft(F.col("_part"), 33)
    return (
        stored.join(offsets, "_part")
        .withColumn(out, F.col("_offset") + position + 1)
        .drop("_part", "_seq", "_offset")
    )
