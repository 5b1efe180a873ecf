"""Text, identifier, month and number normalisation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that stand for a missing identifier.
MISSING_ID_TEXTS = ("<NA>", "nan", "None", "")

# Texts read as true.
TRUE_TEXTS = ("true", "1", "yes")


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def normalize_id(c: Column | str) -> Column:
    """Identifier as text: trimmed, a float-like ``.0`` tail dropped, missing markers nulled."""
    cleaned = F.regexp_replace(F.trim(_text(c)), r"\.0$", "")
    return F.when(~cleaned.isin(*MISSING_ID_TEXTS), cleaned)


def _lenient_date(text: Column) -> Column:
    """ISO dates (day optional, time part ignored) and a few common layouts; null otherwise."""
    iso = F.when(text.rlike(r"^\d{4}-\d{1,2}([-T ]|$)"), text.try_cast("date"))
    layouts = ["yyyyMMdd", "M/d/yyyy", "d.M.yyyy", "MMM yyyy", "yyyy/M/d"]
    return F.coalesce(iso, *[F.try_to_date(text, fmt) for fmt in layouts])


def to_month(c: Column | str) -> Column:
    """First day of the month of a date-like text; null when it cannot be read."""
    return F.trunc(_lenient_date(F.trim(_text(c))), "MM").cast("date")


def year_month_text(c: Column | str) -> Column:
    """``yyyyMM``, ``yyyy-MM`` or a full date to ``yyyy-MM`` text; null when unreadable."""
    text = F.regexp_replace(F.trim(_text(c)), r"\.0$", "")
    compact = F.when(text.rlike(r"^\d{6}$"), F.try_to_date(F.concat(text, F.lit("01")), "yyyyMMdd"))
    dashed = F.when(text.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd"))
    return F.date_format(F.coalesce(compact, dashed, _lenient_date(text)), "yyyy-MM")


def parse_number(c: Column | str, percent: bool = False) -> Column:
    """Number text in European or international notation, currency signs allowed.

    When both separators occur the later one is the decimal mark; a lone comma
    is a decimal comma. With ``percent`` a value carrying ``%`` is divided by
    100; without it such a value is not a number.
    """
    raw = F.trim(_text(c))
    body = F.regexp_replace(raw, r"[€$£\s]", "")
    if percent:
        body = F.regexp_replace(body, "%", "")
    from_end_comma = F.instr(F.reverse(body), ",")
    from_end_dot = F.instr(F.reverse(body), ".")
    european = F.regexp_replace(F.regexp_replace(body, r"\.", ""), ",", ".")
    both = (from_end_comma > 0) & (from_end_dot > 0)
    plain = (
        F.when(both & (from_end_comma < from_end_dot), european)
        .when(both, F.regexp_replace(body, ",", ""))
        .otherwise(F.regexp_replace(body, ",", "."))
    )
    number = plain.try_cast("double")
    number = F.when(~F.isnan(number), number)
    if percent:
        number = F.when(F.contains(raw, F.lit("%")), number / 100).otherwise(number)
    return number


def normalize_label(c: Column | str) -> Column:
    """Trim and collapse inner whitespace; case is kept."""
    return F.regexp_replace(F.trim(_text(c)), r"\s+", " ")


def parse_bool(c: Column | str) -> Column:
    """True for true/1/yes in any case; anything else, null included, is false."""
    return F.coalesce(F.lower(F.trim(_text(c))).isin(*TRUE_TEXTS), F.lit(False))


def unknown_if_null(c: Column | str, label: str = "Unknown") -> Column:
    return F.coalesce(_text(c), F.lit(label))


def decimal_comma(c: Column | str) -> Column:
    """Number rendered with a decimal comma."""
    return F.regexp_replace(_text(c), r"\.", ",")
