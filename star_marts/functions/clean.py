"""Cleaning expressions.  All are built-in column expressions, none is a UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_text(c: Column | str) -> Column:
    """Upper case without surrounding blanks."""
    return F.upper(F.trim(_col(c)))


def not_blank(c: Column | str) -> Column:
    return F.trim(_col(c)) != ""


def try_number(c: Column | str, precision: int = 38, scale: int = 0) -> Column:
    """Text to decimal, NULL when it is not a number or does not fit.

    Rounds half up to `scale`; the default scale 0 turns '40.7' into 41, so pass the
    scale of the target column wherever fractions matter.
    """
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_whole(c: Column | str, to: str = "bigint") -> Column:
    """Text to a rounded whole number of type `to`, NULL when it is none or does not fit.

    Plain digits, the usual case, are read directly; only the rest goes through a decimal.
    """
    c = _col(c)
    return F.coalesce(c.try_cast(to), try_number(c).try_cast(to))


def try_date(c: Column | str) -> Column:
    """Text to date: ISO first, then month/day/year, then day-month name-year, else NULL.

    A bare year or month is not a date here, although a plain cast would accept it.
    """
    c = F.trim(_col(c))
    two_dashes = F.substring_index(c, "-", 2) != c
    return F.when(two_dashes, F.coalesce(c.try_cast("date"), try_named_month(c))).otherwise(try_us_date(c))


def try_us_date(c: Column | str) -> Column:
    """Month/day/year text to date, with or without leading zeros, else NULL."""
    return F.try_to_date(_col(c), "M/d/yyyy")


def try_named_month(c: Column | str) -> Column:
    """Day, short English month name and year, as in 05-JAN-2025, to date, else NULL."""
    c = _col(c)
    # The name is known in one spelling only.
    named = F.concat_ws(
        "-", F.split_part(c, F.lit("-"), F.lit(1)), F.initcap(F.split_part(c, F.lit("-"), F.lit(2))),
        F.split_part(c, F.lit("-"), F.lit(3)),
    )
    return F.when(c.rlike("^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$"), F.try_to_date(named, "d-MMM-yyyy"))


def normalize_zip(c: Column | str) -> Column:
    """Digits only, padded with zeros or cut to five.

    Text without digits becomes '00000'; `quality.placeholder_counts` counts those.
    """
    return F.lpad(F.regexp_replace(_col(c), "[^0-9]", ""), 5, "0")


def five_digit_code(c: Column | str) -> Column:
    """First run of five digits in the text, NULL if there is none."""
    return F.regexp_substr(_col(c), F.lit("[0-9]{5}"))


def date_key(c: Column | str) -> Column:
    """yyyymmdd as an integer."""
    d = _col(c)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def month_key(date_key: Column | str) -> Column:
    """yyyymm of a yyyymmdd key."""
    return F.floor(_col(date_key) / 100).cast("int")


def half_up_ratio(
    numerator: Column, denominator: Column, scale: int, precision: int = 38, operands: str | None = None,
) -> Column:
    """Decimal quotient rounded half up; NULL where the denominator is zero or NULL.

    The types of the operands set how many decimals the quotient is computed with, so that there
    is one division whatever the values: two decimal(10,2) give 13, two decimal(18,0) 19.  Wider
    operands leave too few and name a type to be divided as: decimal(26,8) leaves 12.  A value
    beyond that type has no ratio; `quality.overflow_counts` counts those.
    """
    if operands is not None:
        numerator, denominator = numerator.try_cast(operands), denominator.try_cast(operands)
    # The cast rounds half up.
    return (numerator / F.nullif(denominator, F.lit(0))).cast(f"decimal({precision},{scale})")


def money_text(c: Column | str) -> Column:
    """Whole-dollar display text such as $78,454.  For display only."""
    return F.concat(F.lit("$"), F.format_number(F.round(_col(c), 0).cast("decimal(18,0)"), 0))


def label_by_members(c: Column | str, groups: Mapping[str, Sequence[str]], other: str) -> Column:
    """Label of the group a value is listed in, `other` for everything else."""
    label = F
    for name, members in groups.items():
        label = label.when(_col(c).isin(list(members)), name)
    return label.otherwise(other) if groups else F.lit(other)


def tier_label(
    c: Column | str,
    tiers: Sequence[tuple[int, str]],
    top: str,
    unknown: str | None = None,
) -> Column:
    """Label of the first tier whose upper bound exceeds the value.

    NULL passes every comparison and lands in `top`, unless `unknown` names a label for it.
    """
    value = _col(c)
    label = F.when(value.isNull(), unknown) if unknown is not None else F
    for bound, name in tiers:
        label = label.when(value < bound, name)
    return label.otherwise(top)
