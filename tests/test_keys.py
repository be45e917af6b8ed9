import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from star_marts.operators import modulo_bridge_key, with_surrogate_key


def test_equals_global_row_number(spark):
    values = random.Random(7).sample(range(1_000_000), 5000)
    df = spark.createDataFrame([(v % 97, str(v)) for v in values], "a int, b string").repartition(7)
    keyed = with_surrogate_key(df, "k", ["a", "b"])
    order = Window.orderBy("a", "b")
    wrong = keyed.withColumn("want", F.row_number().over(order)).filter("k <> want")
    assert keyed.columns == ["k", "a", "b"]
    assert keyed.count() == 5000
    assert wrong.count() == 0


def test_many_ranges(spark):
    """No coalescing: the offsets of many chunks add up."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        keyed = with_surrogate_key(spark.range(0, 10_000, 1, 5), "k", ["id"])
        assert keyed.filter("k <> id + 1").count() == 0
        assert keyed.count() == 10_000
    finally:
        spark.conf.set(key, "true")


def test_one_value_in_a_third_of_the_rows(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("a"), "id"
    )
    keyed = with_surrogate_key(df, "k", ["a", "id"])
    want = F.row_number().over(Window.orderBy("a", "id"))
    assert keyed.withColumn("want", want).filter("k <> want").count() == 0


def test_nulls_come_last(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "v string")
    rows = with_surrogate_key(df, "k", ["v"]).orderBy("k").collect()
    assert [r.v for r in rows] == ["a", "b", None]


def test_identity_key_is_dense_and_keeps_rows(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("v")).repartition(6)
    row = with_surrogate_key(df, "k").agg(
        F.min("k"), F.max("k"), F.countDistinct("k"), F.sum("v")
    ).first()
    assert tuple(row) == (1, 1000, 1000, 4500)


def test_empty(spark):
    assert with_surrogate_key(spark.range(0), "k", ["id"]).count() == 0
    assert with_surrogate_key(spark.range(0), "k").count() == 0


@pytest.mark.parametrize(
    "identifier, key",
    [(1, 1), (7, 7), (8, 1), (0, 0), (-1, -1), (1 - 7, 1), (None, None), (15, 1)],
)
def test_bridge(spark, identifier, key):
    dimension = spark.range(7)
    ids = spark.createDataFrame([(identifier,)], "s long")
    got = ids.select(modulo_bridge_key(F.col("s"), dimension)).first()[0]
    assert got == key


def test_bridge_to_nothing(spark):
    ids = spark.createDataFrame([(3,)], "s long")
    assert ids.select(modulo_bridge_key(F.col("s"), spark.range(0))).first()[0] is None
