"""Column expressions for messy text, numbers, dates and postal codes."""

from star_marts.functions.calendar import calendar_covering, dim_date
from star_marts.functions.clean import (
    date_key,
    five_digit_code,
    half_up_ratio,
    label_by_members,
    money_text,
    month_key,
    norm_text,
    normalize_zip,
    not_blank,
    tier_label,
    try_date,
    try_number,
    try_us_date,
    try_whole,
)

__all__ = [
    "calendar_covering", "date_key", "dim_date", "five_digit_code", "half_up_ratio",
    "label_by_members", "money_text", "month_key", "norm_text", "normalize_zip", "not_blank",
    "tier_label", "try_date", "try_number", "try_us_date",
    "try_whole",
]
