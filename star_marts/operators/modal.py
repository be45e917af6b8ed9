"""Most frequent values and weighted means, all with map-side combination.

Counts per (group, value) are spread by both columns, and the winner is a plain minimum, so
a group with a third of all rows, or with millions of values, never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _winner(count: Column, value: Column, when: Column | None = None) -> Column:
    """Value of the highest count, the lowest value among equals."""
    rank = F.struct((-count).alias("rank"), value.alias("value"))
    return F.min(rank if when is None else F.when(when, rank))["value"]


def modal_lookup(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key with its most frequent value."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(_winner(F.col("n"), F.col(value)).alias(value))


def profile_groups(
    df: DataFrame, key: str, modes: Sequence[str], distinct: Sequence[str] = ()
) -> DataFrame:
    """Row count, modes and distinct counts per key in one scan.

    Gives `key, total, <column>_mode..., <column>_distinct...`.  NULLs win no mode and count
    as no value, like the built-in aggregates.
    """
    columns = list(dict.fromkeys([*modes, *distinct]))
    combos = df.groupBy(key, *columns).agg(F.count("*").alias("n"))
    # Turn each combination into one row per column plus one row that carries the total.
    entries = F.array(
        F.struct(F.lit(None).cast("string").alias("attr"), F.lit(None).cast("string").alias("value")),
        *[
            F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("value"))
            for c in columns
        ],
    )
    counts = (
        combos.select(key, "n", F.inline(entries))
        .filter(F.col("attr").isNull() | F.col("value").isNotNull())
        .groupBy(key, "attr", "value")
        .agg(F.sum("n").alias("n"))
    )
    of = {c: F.col("attr") == c for c in columns}
    return counts.groupBy(key).agg(
        F.sum(F.when(F.col("attr").isNull(), F.col("n"))).alias("total"),
        *[_winner(F.col("n"), F.col("value"), of[c]).alias(f"{c}_mode") for c in modes],
        *[F.count(F.when(of[c], 1)).alias(f"{c}_distinct") for c in distinct],
    )


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean weighted over the rows that have a value; NULL if no weight is left.

    An aggregate expression: it combines map-side like the sums it is made of.
    """
    weight_of_known = F.sum(F.when(value.isNotNull(), weight).otherwise(0))
    return F.sum(weight * value) / F.nullif(weight_of_known, F.lit(0))
