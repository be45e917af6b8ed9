import datetime as dt

import pytest
from pyspark.sql import functions as F

from star_marts.functions import calendar_covering, dim_date
from star_marts.plans import quality


def test_daily_calendar_size_and_bounds(spark):
    days = dim_date(spark, "2014-01-01", "2026-12-31")
    row = quality.bounds(days, "full_date").first()
    assert row.asDict() == {
        "total_rows": 4748,
        "min_value": dt.date(2014, 1, 1),
        "max_value": dt.date(2026, 12, 31),
    }


def test_one_year(spark):
    assert dim_date(spark, "2025-01-01", "2025-12-31").count() == 365


def test_yearly_calendar_holds_first_of_january(spark):
    years = dim_date(spark, "2014-01-01", "2026-12-31", "year").collect()
    assert len(years) == 13
    assert years[0].asDict() == {"date_key": 20140101, "year": 2014, "full_date": dt.date(2014, 1, 1)}


def test_day_columns_and_week(spark):
    week = quality.slice_between(
        dim_date(spark, "2025-01-01", "2025-12-31"), "full_date", dt.date(2025, 6, 1), dt.date(2025, 6, 7)
    ).collect()
    assert [r.day_name for r in week] == ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
    assert [r.day_of_week for r in week] == list(range(7))
    assert [r.is_weekend for r in week] == [True, False, False, False, False, False, True]
    first = week[0]
    assert (first.date_key, first.quarter, first.month, first.month_name, first.day) == (
        20250601, 2, 6, "Jun", 1,
    )


def test_weekend_as_number(spark):
    days = dim_date(spark, "2025-06-01", "2025-06-02", weekend_as="int")
    assert [r.is_weekend for r in days.orderBy("full_date").collect()] == [1, 0]


def test_covering_calendar_takes_whole_years(spark):
    dates = spark.createDataFrame([(dt.date(2023, 5, 4),), (dt.date(2024, 2, 1),), (None,)], "d date")
    days = calendar_covering(dates, "d")
    assert days.count() == 365 + 366
    assert calendar_covering(dates, "d", "year").count() == 2
    assert calendar_covering(dates.filter(F.lit(False)), "d").count() == 0


def test_any_length(spark):
    """One mistyped date makes a long calendar, not an error."""
    far = spark.createDataFrame([(dt.date(202, 1, 1),), (dt.date(2025, 5, 1),)], "d date")
    assert calendar_covering(far, "d", "year").count() == 2025 - 202 + 1
    assert dim_date(spark, "0202-01-01", "0203-12-31").count() == 730
