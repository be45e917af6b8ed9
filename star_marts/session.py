"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the marts are tested with.  Partition counts stay with the cluster's own settings.
SESSION_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
}

_local_scratch: str | None = None
_scratch: list[str] = []


def local_session(cores: int | str = "*", name: str = "star-marts", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in {**SESSION_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Only a local master may go without: it gets a temporary folder, since its executors
    are this very process.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="star-marts-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name; `drop_scratch` deletes what was written there."""
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    _scratch.append(path)
    return path


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage with something that outlives executors, and gives later plans a
    columnar scan with true sizes instead of a re-run of what came before.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Delete this process's scratch folders, once nothing reads them any more; their number."""
    dropped = len(_scratch)
    while _scratch:
        delete_folder(spark, _scratch.pop())
    return dropped


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
