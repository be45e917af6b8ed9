"""Data-quality checks.  Each is a small report; none changes a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from star_marts.functions import try_number
from star_marts.sources import Layers


def row_counts(tables: Mapping[str, DataFrame], name: str = "table_name") -> DataFrame:
    """One row per table with its row count."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(table).alias(name), "row_count")
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once; no rows is good news."""
    return df.groupBy(*keys).agg(F.count("*").alias("dup_count")).filter(F.col("dup_count") > 1)


def fill_counts(df: DataFrame, columns: Mapping[str, str], total: str = "total_rows") -> DataFrame:
    """Row count and, per {alias: column}, the rows in which the column is filled."""
    return df.agg(
        F.count("*").alias(total), *[F.count(c).alias(alias) for alias, c in columns.items()]
    )


def reconcile(raw: DataFrame, loaded: DataFrame) -> DataFrame:
    """raw_rows, loaded_rows, dropped_rows."""
    sides = raw.agg(F.count("*").alias("r"), F.lit(0).cast("bigint").alias("l")).unionAll(
        loaded.agg(F.lit(0).cast("bigint").alias("r"), F.count("*").alias("l"))
    )
    return sides.agg(
        F.sum("r").alias("raw_rows"),
        F.sum("l").alias("loaded_rows"),
        (F.sum("r") - F.sum("l")).alias("dropped_rows"),
    )


def bounds(df: DataFrame, column: str) -> DataFrame:
    """total_rows, min_value and max_value of a column."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
    )


def slice_between(df: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Rows in a closed range, in order of the column."""
    return df.filter(F.col(column).between(F.lit(low), F.lit(high))).orderBy(column)


# --- the same counts from what the writes of stored tables counted: no table is read -----------


def loaded_row_counts(layers: Layers, tables: Mapping[str, str], name: str = "table_name") -> DataFrame:
    """`row_counts` of stored tables, given as {label: 'layer.table'}."""
    rows = [(label, layers.loaded(table).rows) for label, table in tables.items()]
    return layers.spark.createDataFrame(rows, f"{name} string, row_count bigint")


def loaded_fill_counts(
    layers: Layers, table: str, columns: Mapping[str, str], total: str = "total_rows"
) -> DataFrame:
    """`fill_counts` of a stored table."""
    counts = layers.loaded(table)
    values = [counts.rows, *[counts.filled[c] for c in columns.values()]]
    return layers.spark.createDataFrame([tuple(values)], ", ".join(f"`{n}` bigint" for n in [total, *columns]))


def loaded_reconciliation(layers: Layers, raw: str, loaded: str) -> DataFrame:
    """`reconcile` of two stored tables."""
    before, after = layers.loaded(raw).rows, layers.loaded(loaded).rows
    return layers.spark.createDataFrame(
        [(before, after, before - after)], "raw_rows bigint, loaded_rows bigint, dropped_rows bigint"
    )


def missing_references(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct foreign keys without a dimension row."""
    used = facts.select(key).filter(F.col(key).isNotNull()).distinct()
    return used.join(dimension.select(key), key, "left_anti")


def placeholder_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Rows for which each named condition holds, such as an all-zero zip or a blank county."""
    return df.agg(*[F.count(F.when(test, 1)).alias(name) for name, test in checks.items()])


def overflow_counts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Per column of the schema, the values that would not fit its declared type.

    Text is read as numbers of 38 digits first, at the scale of the declared type; what is no
    number at all does not count.
    """

    def misfit(f: T.StructField) -> Column:
        value = F.col(f.name)
        if isinstance(df.schema[f.name].dataType, T.StringType) and isinstance(f.dataType, T.NumericType):
            value = try_number(value, 38, getattr(f.dataType, "scale", 0))
        return F.count_if(value.isNotNull() & value.try_cast(f.dataType).isNull()).alias(f.name)

    return df.agg(*[misfit(f) for f in schema.fields if f.name in df.columns])
