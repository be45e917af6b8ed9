"""Dense surrogate keys and the modulo bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from star_marts.session import stage

# monotonically_increasing_id() holds the partition in its upper 31 bits and the row's
# position inside the partition in the lower 33.
_POSITION_BITS = 33


def with_surrogate_key(
    df: DataFrame, name: str, order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """Prefix a dense key 1..n.

    With `order_by` the key is the row's rank in that order (NULLs last), the same on every
    rebuild as long as the order is total.  Rows are spread by ranges of the whole order, so
    no task sees more than its share, and only one count per task is summed up globally.

    Without `order_by` rows keep the partitions they are in and nothing is shuffled; the key
    is dense and unique but not the same from one rebuild to the next.

    The numbered rows are staged once, because positions hold only for one run of the plan.
    What comes back is a scan of that table, joined to the first key of each write task.
    """
    return _numbered(df, name, order_by, 1)[0]


def keyed_from(
    df: DataFrame, name: str, order_by: Sequence[str | Column] | None, first: int
) -> tuple[DataFrame, int]:
    """`with_surrogate_key` from `first` on, and how many keys it took."""
    keyed, starts = _numbered(df, name, order_by, first)
    return keyed, starts.agg(F.max(F.col("_start") + F.col("_size"))).first()[0] or 0


def _numbered(
    df: DataFrame, name: str, order_by: Sequence[str | Column] | None, first: int
) -> tuple[DataFrame, DataFrame]:
    rows = df
    if order_by:
        order = [
            (F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order_by
        ]
        rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stage(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    chunk = F.shiftright("_row", _POSITION_BITS).alias("_chunk")
    position = F.col("_row").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_position")
    placed = numbered.select(chunk, position, *df.columns)
    # A row per write task, however many rows it wrote: their running total is the one global step.
    sizes = placed.groupBy("_chunk").agg((F.max("_position") + 1).alias("_size"))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        sizes.select("_chunk", "_size", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")),
        f"{name}-starts",
    )
    key = F.col("_start") + F.col("_position") + first
    return placed.join(starts, "_chunk").select(key.alias(name), *df.columns), starts


def modulo_bridge_key(identifier: Column, dimension: DataFrame) -> Column:
    """Dense key of a dimension that an unrelated integer id is wrapped around to.

    The remainder keeps its sign, so ids below one point at no row unless `id - 1` is a
    multiple of the row count.  An empty dimension gives NULL.  The count is a scalar
    subquery, evaluated once for the whole join.
    """
    size = dimension.select(F.nullif(F.count("*"), F.lit(0)).alias("n")).scalar()
    return (identifier - 1) % size + 1
