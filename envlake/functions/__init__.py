"""Column -> Column helpers, all of them compositions of built-in functions."""

from envlake.functions.calendar import (
    date_or_null,
    day_count,
    half_year_start,
    half_year_windows,
    hour_of_label,
    landing_key,
    landing_key_of_path,
    landing_key_parts,
    observation_hour,
    window_bound_text,
)
from envlake.functions.numbers import (
    collector_number,
    int_from_double,
    int_from_text,
    locale_decimal,
    percent,
    percent_text,
)
from envlake.functions.text import from_latin9, to_latin9

__all__ = [
    "collector_number",
    "date_or_null",
    "day_count",
    "from_latin9",
    "half_year_start",
    "half_year_windows",
    "hour_of_label",
    "int_from_double",
    "int_from_text",
    "landing_key",
    "landing_key_of_path",
    "landing_key_parts",
    "locale_decimal",
    "observation_hour",
    "percent",
    "percent_text",
    "to_latin9",
    "window_bound_text",
]
