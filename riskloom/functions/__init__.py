from riskloom.functions.cleaning import (
    decimal_comma,
    normalize_id,
    normalize_label,
    parse_bool,
    parse_number,
    to_month,
    unknown_if_null,
    year_month_text,
)
from riskloom.functions.dates import (
    date_key,
    dow_mon1,
    dow_sun1,
    is_month_end,
    is_quarter_end,
    is_weekend,
    launch_from_year,
    month_index,
    month_key,
    month_start,
    months_diff,
    next_month,
    us_week,
)
from riskloom.functions.scalars import (
    as_int,
    band,
    clip,
    close_to,
    contains_any,
    finite,
    flag,
    flag_or_null,
    half_even,
    in_range,
    map_values,
    row_min,
    row_sum,
    safe_divide,
    select_case,
)

__all__ = [name for name in dir() if not name.startswith("_")]
