"""Dense entity-by-period series with running totals."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def densify(
    entities: DataFrame, entity: str, period: str, first: int, last: int,
    series: Mapping[str, DataFrame],
) -> DataFrame:
    """Every entity in every period, with each series' count and its running total.

    `series` maps a name to counts with columns `entity, period, n`, one row per pair;
    missing pairs count zero, entities not listed are dropped, and totals start at `first`.
    Adds `<name>` and `<name>_cum`, keeps all columns of `entities`.

    All series share one join and one window.  Periods of an entity are made in place from
    its own row, so there is no product join; the window holds `last - first + 1` rows per
    entity however large the counted tables are.
    """
    names = list(series)
    stacked = reduce(
        DataFrame.unionByName,
        [
            counts.filter(F.col(period).between(first, last)).select(
                entity,
                period,
                *[(F.col("n") if other == name else F.lit(0).cast("bigint")).alias(other) for other in names],
            )
            for name, counts in series.items()
        ],
    )
    counts = stacked.groupBy(entity, period).agg(*[F.sum(name).alias(name) for name in names])
    grid = entities.withColumn(period, F.explode(F.sequence(F.lit(first), F.lit(last))))
    filled = grid.join(counts, [entity, period], "left").fillna(0, subset=names)
    to_date = (
        Window.partitionBy(entity).orderBy(period)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return filled.withColumns({f"{name}_cum": F.sum(name).over(to_date) for name in names})
