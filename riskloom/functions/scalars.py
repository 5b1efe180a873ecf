"""Null-aware scalar expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """Quotient as double; null when the denominator is zero or either side is null."""
    den = _col(b).cast("double")
    return _col(a).cast("double") / F.nullif(den, F.lit(0.0))


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]. greatest/least skip nulls, so a null input is kept null explicitly."""
    src = _col(c)
    out = src
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(src.isNotNull(), out)


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Row-wise sum in which nulls count as zero."""
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(_col(c), F.lit(0))
    return total


def row_min(cols: Sequence[Column | str]) -> Column:
    """Row-wise minimum that skips nulls."""
    return F.least(*[_col(c) for c in cols])


def select_case(conditions: Sequence[Column], values: Sequence, default) -> Column:
    """First matching condition decides; otherwise the default."""
    chain = None
    for cond, value in zip(conditions, values, strict=True):
        chain = F.when(cond, value) if chain is None else chain.when(cond, value)
    return chain.otherwise(default)


def band(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by descending lower bounds; null and everything below the last cut get the last label."""
    src = _col(c)
    return select_case([src >= cut for cut in cuts], [F.lit(x) for x in labels[:-1]], F.lit(labels[-1]))


def flag(cond: Column) -> Column:
    """0/1 flag where an unknown comparison is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def flag_or_null(cond: Column, *inputs: Column | str) -> Column:
    """0/1 flag that stays null unless every input is known."""
    known = F.lit(True)
    for c in inputs:
        known = known & _col(c).isNotNull()
    return F.when(known, cond.cast("int"))


def contains_any(c: Column | str, pattern: str) -> Column:
    """Case-insensitive regular-expression search as 0/1; null text is 0."""
    return flag(_col(c).rlike(f"(?i){pattern}"))


def in_range(c: Column | str, lo, hi) -> Column:
    """Closed-range test."""
    return _col(c).between(lo, hi)


def close_to(a: Column | str, b: Column | str, tol: float) -> Column:
    """Absolute difference within ``tol``."""
    return F.abs(_col(a) - _col(b)) <= F.lit(tol)


def as_int(c: Column | str) -> Column:
    """Boolean to 0/1."""
    return _col(c).cast("int")


def map_values(c: Column | str, mapping: Mapping, default=None) -> Column:
    """Dictionary lookup with a default for unknown and null keys."""
    src = _col(c)
    out = select_case([src == F.lit(k) for k in mapping], [F.lit(v) for v in mapping.values()], F.lit(default))
    return out


def finite(c: Column | str) -> Column:
    """NaN and both infinities become null."""
    src = _col(c)
    bad = F.isnan(src) | src.isin(float("inf"), float("-inf"))
    return F.when(~bad, src)


def half_even(c: Column | str, digits: int = 2) -> Column:
    """Half-even rounding of a computed ratio; noise beyond nine decimals cannot decide a tie."""
    return F.bround(F.round(_col(c), 9), digits)
