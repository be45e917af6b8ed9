"""Raw, staging and mart tables in the session catalog.

A table is a view over one version of it, a table `name__version` with a folder of its own.  A new
version is written beside the old one, then the view is moved to it in one step of the catalog, and
only then the old version is dropped: a write that fails leaves everything as it was.

Each write counts its rows, and the filled values of every column, as it goes.  The counts are kept
with the version, as are its size for the optimizer and the next key of an identity column.
One writer per table at a time is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from star_marts.operators.keys import keyed_from
from star_marts.schemas import RAW_TABLES, conform
from star_marts.session import delete_folder

LAYERS = ("raw", "staging", "marts")
_ROWS, _FILLED = "load.rows", "load.filled."
_IDENTITY, _NEXT = "identity.column", "identity.next"


@dataclass(frozen=True)
class Loaded:
    """What the writes of a table counted: its rows, and per column the rows that have a value."""

    rows: int
    filled: dict[str, int]


def sql_text(value: str) -> str:
    """A text for between single quotes."""
    return value.replace("\\", "\\\\").replace("'", "\\'")


class Layers:
    """Three databases under one root folder; tables are named 'layer.table'.

    `prefix` keeps several warehouses apart in one catalog.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def create(self) -> Layers:
        for layer in LAYERS:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{layer}` "
                f"LOCATION '{sql_text(f'{self.root}/{layer}')}'"
            )
        return self

    def name(self, table: str) -> str:
        layer, _, short = table.partition(".")
        if layer not in LAYERS or not short:
            raise ValueError(f"not a 'layer.table' name: {table!r}")
        return f"`{self.prefix}{layer}`.`{short}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def drop(self, table: str) -> None:
        """Drop the table and its files, if there is one."""
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name(table)}")
        for version in self._versions(table):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")
        delete_folder(self.spark, self._folder(table))

    def _folder(self, table: str) -> str:
        return f"{self.root}/{table.replace('.', '/')}"

    def _versions(self, table: str) -> list[str]:
        """Every stored version, the current one among them."""
        layer, _, short = table.partition(".")
        found = self.spark.sql(f"SHOW TABLES IN `{self.prefix}{layer}` LIKE '{short}__*'").collect()
        return [f"{layer}.{row['tableName']}" for row in found]

    def current(self, table: str) -> str:
        """The version that the view shows."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name(table)}").collect()
        text = next(row["data_type"] for row in described if row["col_name"] == "View Text")
        layer = table.partition(".")[0]
        return f"{layer}.{text.rsplit('`.`', 1)[1].rstrip('`')}"

    def _properties(self, version: str) -> dict[str, str]:
        return {row["key"]: row["value"] for row in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(version)}").collect()}

    def _set(self, version: str, properties: dict[str, object]) -> None:
        pairs = ", ".join(f"'{sql_text(k)}' = '{sql_text(str(v))}'" for k, v in properties.items())
        self.spark.sql(f"ALTER TABLE {self.name(version)} SET TBLPROPERTIES ({pairs})")

    def loaded(self, table: str) -> Loaded:
        """Counts of everything that was written to the table; no data are read."""
        properties = self._properties(self.current(table))
        return Loaded(
            int(properties.get(_ROWS, 0)),
            {k.removeprefix(_FILLED): int(v) for k, v in properties.items() if k.startswith(_FILLED)},
        )

    def _written(self, version: str, columns: Sequence[str], seen: Observation, before: dict[str, str]) -> None:
        """Add a write's counts to the version's, and tell the optimizer its size, from the files alone."""
        found = seen.get
        counts = {_ROWS: found.get("rows", 0)} | {f"{_FILLED}{c}": found.get(f"c{i}", 0) for i, c in enumerate(columns)}
        self._set(version, {k: n + int(before.get(k, 0)) for k, n in counts.items()})
        self.spark.sql(f"ANALYZE TABLE {self.name(version)} COMPUTE STATISTICS NOSCAN")

    def declare(self, table: str, schema: T.StructType, identity: str | None = None) -> DataFrame:
        """An empty table of a declared schema, in place of any older one.

        Inserts that leave the `identity` column out, or NULL, fill it: 1, 2, 3 ...
        """
        empty = self.spark.createDataFrame([], schema)
        shown = self.replace(empty, table)
        if identity is not None:
            self._set(self.current(table), {_IDENTITY: schema[identity].name, _NEXT: 1})
        return shown

    def reset_raw(self) -> dict[str, DataFrame]:
        """Every text landing table, empty, whatever was in it before."""
        for table in RAW_TABLES:
            self.drop(f"raw.{table}")
        return {t: self.declare(f"raw.{t}", schema) for t, schema in RAW_TABLES.items()}

    def replace(
        self, df: DataFrame, table: str, schema: T.StructType | None = None,
        partition_by: Sequence[str] = (), bucket_by: tuple[str, int] | None = None,
    ) -> DataFrame:
        """Create the table from a frame, in place of any older one, in one step.

        Partitioned tables are rebalanced by their partition columns first: few large files
        each, while a partition with most of the rows is still written by many tasks.
        `bucket_by` is a column and a number of buckets: roll-ups and joins by that column move no
        row of the table.  A bucket is written and read by one task, so it is for columns without
        hot keys.
        """
        rows = conform(df, schema) if schema is not None else df
        if bucket_by:
            rows = rows.repartition(bucket_by[1], F.col(bucket_by[0]))
        elif partition_by:
            rows = rows.hint("rebalance", *[F.col(c) for c in partition_by])
        label = uuid.uuid4().hex[:8]
        version, folder = f"{table}__{label}", f"{self._folder(table)}/{label}"
        rows, seen = _observed(rows)
        writer = rows.write.format("parquet").option("path", folder)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if bucket_by:
            writer = writer.bucketBy(bucket_by[1], bucket_by[0]).sortBy(bucket_by[0])
        try:
            writer.saveAsTable(self.name(version))
            self._written(version, rows.columns, seen, {})
        except Exception:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(version)}")
            delete_folder(self.spark, folder)
            raise
        older = [v for v in self._versions(table) if v.lower() != version.lower()]
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name(table)} AS SELECT * FROM {self.name(version)}")
        for old in older:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name(old)}")
            delete_folder(self.spark, f"{self._folder(table)}/{old.rsplit('__', 1)[1]}")
        return self.read(table)

    def append(self, df: DataFrame, table: str, order_by: Sequence[str | Column] | None = None) -> None:
        """Insert by column name; columns the frame lacks become NULL, but for an identity column.

        Its keys go on from the highest so far, in the order of `order_by` if that is given.  The
        range of keys is set aside before anything is written: an insert that fails leaves a gap.
        """
        version = self.current(table)
        column = self._properties(version).get(_IDENTITY)
        if column is not None:
            df = self._with_identity(df, version, column, order_by)
        self._insert(conform(df, self.read(table).schema), version)

    def _with_identity(
        self, df: DataFrame, version: str, column: str, order_by: Sequence[str | Column] | None
    ) -> DataFrame:
        own = next((c for c in df.columns if c.lower() == column.lower()), None)
        given = df.filter(F.col(own).isNotNull()) if own is not None else None
        bare = df.filter(F.col(own).isNull()).drop(own) if own is not None else df
        first = int(self._properties(version)[_NEXT])
        if given is not None:
            first = max(first, (given.agg(F.max(F.col(own).cast("bigint"))).first()[0] or 0) + 1)
        keyed, count = keyed_from(bare, column, order_by, first)
        self._set(version, {_NEXT: first + count})
        return keyed if given is None else keyed.unionByName(given.withColumnRenamed(own, column))

    def append_positional(self, df: DataFrame, table: str) -> None:
        """Insert by position, whatever the columns are called."""
        target = self.read(table).schema
        if len(df.columns) != len(target):
            raise ValueError(f"{table} has {len(target)} columns, the frame {len(df.columns)}")
        self._insert(conform(df.toDF(*target.fieldNames()), target), self.current(table))

    def _insert(self, df: DataFrame, version: str) -> None:
        before = self._properties(version)
        rows, seen = _observed(df)
        rows.write.insertInto(self.name(version))
        self._written(version, df.columns, seen, before)
        self.spark.catalog.refreshTable(self.name(version))


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame, and what a write of it will have counted."""
    seen = Observation()
    filled = [F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *filled), seen
