"""Foreign-key lookups that hold up when one key has a large share of the rows.

Not needed after a roll-up by the foreign key: that leaves one row per key, and a plain join
then re-uses the partitioning of the roll-up.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from star_marts.session import stage

_SHARES = 4  # a key is hot above this part of a shuffle partition's fair share of the rows


def size_in_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate, None for a session that does not show its plans."""
    if not hasattr(df, "_jdf"):
        return None
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the optimizer, by its statistics, would broadcast this side of a join."""
    if not hasattr(df, "_jdf"):
        return False
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return size_in_bytes(df) <= limit


def lookup_join(
    facts: DataFrame, dimension: DataFrame, on: str | Sequence[str], how: str = "left",
) -> DataFrame:
    """Join facts to a dimension on its key columns; `how` is left, inner or left_anti.

    If the dimension's statistics let the optimizer broadcast it, that is all: no fact row moves.
    Pass stored or staged dimensions: their size is that of their files, while the estimate for
    a join is the product of its sides.  A larger dimension is shuffled, and the rows of hot keys
    are spread.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(dimension):
        return facts.join(dimension, keys, how)
    return salted_join(facts, dimension, keys, how)


def hot_keys(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, missing ones included, with more than a quarter of a task's fair share of the rows.

    `_salts` is the number of such quarters they have.  All rows are counted, once.  There are
    fewer hot keys than four times the shuffle partitions.
    """
    seen = Observation()
    per_key = facts.groupBy(*keys).agg(F.count("*").alias("_n")).observe(seen, F.sum("_n").alias("total"))
    counts = stage(per_key, "counts")
    total = seen.get.get("total") or 0
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, total // (_SHARES * tasks))
    hot = counts.filter(F.col("_n") > most)
    return hot.select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_salts"))


def salted_join(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "left",
) -> DataFrame:
    """The shuffled form of `lookup_join`: salts in proportion to the rows of a key.

    The salt is a hash of the row, not a random number: a retried task must repeat its choice.
    Rows that are equal in every column therefore stay together.
    """
    keys = list(keys)
    hot = hot_keys(facts, keys)

    def same(df: DataFrame) -> Column:
        return reduce(Column.__and__, [df[k].eqNullSafe(hot[k]) for k in keys])

    spread = F.pmod(F.xxhash64(*[facts[c] for c in facts.columns]), hot["_salts"])
    salted_facts = facts.join(hot, same(facts), "left").select(
        *[facts[c] for c in facts.columns], F.coalesce(spread, F.lit(0)).cast("int").alias("_salt")
    )
    every_salt = F.sequence(F.lit(0), F.coalesce(hot["_salts"], F.lit(1)) - 1)
    salted_dimension = dimension.join(hot, same(dimension), "left").select(
        *[dimension[c] for c in dimension.columns], F.explode(every_salt).alias("_salt")
    )
    joined = salted_facts.join(salted_dimension, [*keys, "_salt"], how).drop("_salt")
    tail = [c for c in dimension.columns if c not in keys] if how != "left_anti" else []
    return joined.select(*keys, *[c for c in facts.columns if c not in keys], *tail)


def lookup_star(
    facts: DataFrame, lookups: Sequence[tuple[DataFrame, str | Sequence[str], Sequence[str | Column]]]
) -> DataFrame:
    """Left lookups of one fact in several dimensions; unmatched keys stay NULL.

    Each lookup is (dimension, key columns, columns to bring).
    """
    for dimension, on, bring in lookups:
        keys = [on] if isinstance(on, str) else list(on)
        facts = lookup_join(facts, dimension.select(*keys, *bring), keys, "left")
    return facts
