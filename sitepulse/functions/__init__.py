"""Column expressions. Everything here stays inside whole-stage codegen."""

from sitepulse.functions.labels import cut, first_match, recode
from sitepulse.functions.numeric import (
    clip, cube_root, number_or_zero, percent, ratio, row_argmin, row_max, row_mean, row_min,
    row_null_count, row_range, row_slope, row_std, row_sum,
)
from sitepulse.functions.text import contains, drop_blanks, not_text, text_flag, title_case
from sitepulse.functions.time import (
    as_of, clamp, combine_date_time, days_before, hours_between, minutes_between,
    minutes_between_exact, parse_time, slot_label,
)

__all__ = [
    "as_of", "clamp", "clip", "combine_date_time", "contains", "cube_root", "cut", "days_before",
    "drop_blanks", "first_match", "hours_between", "minutes_between", "minutes_between_exact",
    "not_text", "number_or_zero", "parse_time", "percent", "ratio", "recode", "row_argmin",
    "row_max", "row_mean", "row_min", "row_null_count", "row_range", "row_slope", "row_std", "row_sum",
    "slot_label", "text_flag", "title_case",
]
