"""Calendar dimension at year or day grain."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts.functions.clean import date_key


def dim_date(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, grain: str = "day",
    weekend_as: str = "boolean",
) -> DataFrame:
    """Every day from start to end, or the first of January of every year in between."""
    first, last = (dt.date.fromisoformat(str(d)) for d in (start, end))
    day = lambda d: F.lit(d.isoformat()).cast("date")
    bounds = spark.range(1).select(day(first).alias("first"), day(last).alias("last"))
    return _expand(bounds, grain, weekend_as)


def calendar_covering(
    df: DataFrame, column: Column | str, grain: str = "day", weekend_as: str = "boolean"
) -> DataFrame:
    """Calendar of the whole years that a date column of some table touches."""
    seen = df.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    bounds = seen.filter(F.col("first").isNotNull()).select(
        F.trunc("first", "year").alias("first"),
        F.make_date(F.year("last"), F.lit(12), F.lit(31)).alias("last"),
    )
    return _expand(bounds, grain, weekend_as)


def _expand(bounds: DataFrame, grain: str, weekend_as: str) -> DataFrame:
    if grain == "year":
        every = F.expr("sequence(trunc(first, 'year'), last, interval 1 year)")
    elif grain == "day":
        every = F.expr("sequence(first, last, interval 1 day)")
    else:
        raise ValueError(f"unknown grain {grain!r}")
    days = bounds.select(F.explode(every).alias("full_date"))
    d = F.col("full_date")
    if grain == "year":
        return days.select(date_key(d).alias("date_key"), F.year(d).alias("year"), d)
    sunday_is_zero = F.dayofweek(d) - 1
    weekend = sunday_is_zero.isin(0, 6)
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day"),
        sunday_is_zero.alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        (weekend if weekend_as == "boolean" else weekend.cast(weekend_as)).alias("is_weekend"),
    )
