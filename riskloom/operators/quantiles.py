"""Exact percentiles without holding a group's values in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_ACCURACY = 10_000
_MARGIN = 3 / _ACCURACY


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], points: Sequence[float]
) -> DataFrame:
    """Interpolated percentiles per group: rows (keys, column, point, value).

    Pass 1 takes a mergeable approximate quantile a little below and above each
    point; its rank error is bounded, so the wanted value lies between the two.
    Pass 2 counts what lies below that bracket and tallies only the values
    inside it, which is a tiny share of the rows. The nearest values outside
    the bracket are kept as well, for interpolation across its edge.
    """
    keys = list(keys)
    targets = [(c, p) for c in columns for p in points]
    # one quantile sketch per column serves both ends of all its brackets
    bounds = []
    for c in columns:
        v = F.col(c).cast("double")
        marks = sorted({m for p in points for m in (p - _MARGIN, p + _MARGIN) if 0 < m < 1})
        sketch = F.percentile_approx(v, marks, _ACCURACY) if marks else F.array()
        bounds += [sketch.alias(f"q_{c}"), F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}"), F.count(v).alias(f"n_{c}")]
    source = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])

    def edge(c: str, mark: float):
        if mark <= 0:
            return F.col(f"min_{c}")
        if mark >= 1:
            return F.col(f"max_{c}")
        return F.get(F.col(f"q_{c}"), F.lit(marks.index(mark)))

    brackets = source.groupBy(*keys).agg(*bounds).select(
        *keys,
        *[f"n_{c}" for c in columns],
        *[edge(c, p - _MARGIN).alias(f"lo{i}") for i, (c, p) in enumerate(targets)],
        *[edge(c, p + _MARGIN).alias(f"hi{i}") for i, (c, p) in enumerate(targets)],
    )
    packed = brackets.select(*keys, F.struct(*[c for c in brackets.columns if c not in keys]).alias("_b"))
    if keys:
        joined = source.join(packed, keys)
    else:
        joined = source.withColumn("_b", packed.scalar())

    below = joined.groupBy(*keys).agg(
        F.first("_b").alias("_b"),
        *[
            e
            for i, (c, _) in enumerate(targets)
            for e in (
                F.count_if(F.col(c) < F.col(f"_b.lo{i}")).alias(f"below{i}"),
                F.count_if(F.col(c) <= F.col(f"_b.hi{i}")).alias(f"upto{i}"),
                F.max(F.when(F.col(c) < F.col(f"_b.lo{i}"), F.col(c))).alias(f"prev{i}"),
                F.min(F.when(F.col(c) > F.col(f"_b.hi{i}"), F.col(c))).alias(f"next{i}"),
            )
        ],
    )
    below_long = below.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("target"),
                        *[F.col(f"{name}{i}").alias(name) for name in ("below", "upto", "prev", "next")],
                        F.col(f"_b.n_{c}").alias("n"),
                    )
                    for i, (c, _) in enumerate(targets)
                ]
            )
        ),
    )
    inside = joined.select(
        *keys,
        F.inline(
            F.filter(
                F.array(
                    *[
                        F.struct(
                            F.lit(i).alias("target"),
                            F.when(F.col(c).between(F.col(f"_b.lo{i}"), F.col(f"_b.hi{i}")), F.col(c)).alias("value"),
                        )
                        for i, (c, _) in enumerate(targets)
                    ]
                ),
                lambda s: s["value"].isNotNull(),
            )
        ),
    )
    tallied = inside.groupBy(*keys, "target", "value").agg(F.count(F.lit(1)).alias("ties"))
    earlier = Window.partitionBy(*keys, "target").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = tallied.withColumn("_prior", F.coalesce(F.sum("ties").over(earlier), F.lit(0)))
    points_col = F.element_at(F.array(*[F.lit(float(p)) for _, p in targets]), F.col("target") + 1)
    ranked = (
        placed.join(below_long, [*keys, "target"])
        .withColumn("_h", (F.col("n") - 1) * points_col)
        .withColumn("_from", F.col("below") + F.col("_prior"))
    )

    def value_at(rank):
        hit = (rank >= F.col("_from")) & (rank < F.col("_from") + F.col("ties"))
        return F.coalesce(
            F.max(F.when(hit, F.col("value"))),
            F.max(F.when(rank >= F.col("upto"), F.col("next"))),
            F.max(F.when(rank < F.col("below"), F.col("prev"))),
        )

    picked = ranked.groupBy(*keys, "target").agg(
        value_at(F.floor("_h")).alias("_lo"),
        value_at(F.ceil("_h")).alias("_hi"),
        F.max(F.col("_h") - F.floor("_h")).alias("_w"),
    )
    names = F.array(*[F.lit(c) for c, _ in targets])
    return picked.select(
        *keys,
        F.element_at(names, F.col("target") + 1).alias("column"),
        points_col.alias("point"),
        (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_w")).alias("value"),
    )


def exact_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Wide form: one row per group with ``median_<column>``."""
    long = exact_percentiles(df, keys, columns, [0.5])
    return long.groupBy(*keys).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(f"median_{c}") for c in columns]
    )
