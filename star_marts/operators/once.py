"""Expressions that several operators use, computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """The frame with a column that later filters and projections do not compute again.

    The optimizer moves a filter below the projection it reads from, and copies the expression on
    the way.  It moves none below a generator, so the value is generated, one row from each.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))
