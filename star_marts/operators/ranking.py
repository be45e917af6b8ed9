"""Top-k with a stated place for NULLs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """Highest `k` rows; NULL ranks above every value, `ties` break equal ones ascending.

    Each task keeps its own k best rows, so only k rows per task travel.
    """
    return df.orderBy(
        F.col(by).desc_nulls_first(), *[F.col(c).asc_nulls_last() for c in ties]
    ).limit(k)
