"""What the operators share: reading, whole-text words, and joins that split hot keys."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but these six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"

TEXTS_PER_BATCH = 500
_HOT_KEYS = 1000  # a key is hot above this share of the rows, so fewer keys than this are hot
_LEAST_HOT = 20_000  # rows that one task takes without trouble


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def word_list(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 bytes: `bytes` knows exactly the blanks of `WORD` and A-Z."""
    return text.lower().split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spread_join(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str], rows_of_key: str,
    salt_by: Sequence[str], how: str = "inner",
) -> DataFrame:
    """Join rows to one row per key; keys with many rows are split over several tasks.

    `keyed[rows_of_key]` is the exact number of rows of the key, `salt_by` are columns by which
    the rows of one key differ.  A key above both a thousandth of all rows and 20,000 gets salts
    in proportion to its rows.  Fewer than a thousand keys can be that hot, so the list of them
    is broadcast; nothing else is.  `keyed` should be stored: it is read three times.
    """
    salted, repeated = salted_sides(rows, keyed, keys, rows_of_key, salt_by)
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def salted_sides(
    rows: DataFrame, keyed: DataFrame, keys: Sequence[str], rows_of_key: str, salt_by: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Both sides of `spread_join` with their column `_salt`."""
    total = keyed.agg(F.sum(rows_of_key)).first()[0] or 0
    most = max(_LEAST_HOT, total // _HOT_KEYS)
    salts = F.ceil(F.col(rows_of_key) / F.lit(most)).cast("int")
    hot = keyed.filter(F.col(rows_of_key) > most).select(*keys, salts.alias("_salts"))
    salted = rows.join(F.broadcast(hot), list(keys), "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(*salt_by), F.col("_salts")), F.lit(0)).cast("int")
    ).drop("_salts")
    repeated = keyed.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.greatest(salts, F.lit(1)) - 1))
    )
    return salted, repeated


def text_batches(spark: SparkSession) -> None:
    """Hand texts to Python in small batches, so that a batch of long texts still fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))
