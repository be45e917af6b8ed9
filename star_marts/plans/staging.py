"""Staging tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts.functions import norm_text, normalize_zip, try_whole


def clean_registrations(
    raw: DataFrame, state: str = "NY", zip_rule: Callable[[str], Column] = normalize_zip
) -> DataFrame:
    """Name the first 17 of 20 positional columns, standardise them, keep one state.

    The state test is on the text as delivered, so it reaches the scan; ' ny' is not kept.
    """
    names = fixed.CLEAN_REGISTRATION_COLUMNS
    surplus = [f"_{i}" for i in range(len(raw.columns) - len(names))]
    rows = raw.toDF(*names, *surplus).filter(F.col("state") == state)
    rules = {
        "city": norm_text,
        "state": norm_text,
        "zip": zip_rule,
        "county": norm_text,
        "make": norm_text,
        "model_year": lambda c: try_whole(c, "int"),
    }
    return rows.select(*[rules.get(n, F.col)(n).alias(n) for n in names])
