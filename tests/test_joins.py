import pytest
from pyspark.sql import functions as F

from star_marts.operators import lookup_join, lookup_star, size_in_bytes
from star_marts.operators.joins import hot_keys, salted_join
from star_marts.session import stage


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def facts(spark):
    """A third of the rows on one key, some without a key, some of an unknown key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 1).when(n % 11 == 0, None).otherwise(n % 50)
    return spark.range(6000).select(key.alias("k"), n.alias("row"))


@pytest.fixture
def dimension(spark):
    return spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("attr"))


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_salted_equals_plain(facts, dimension, how):
    salted = salted_join(facts, dimension, ["k"], how)
    assert plain(salted) == plain(facts.join(dimension, "k", how))


def largest_task(df):
    """Share of the rows that the fullest task of a join holds."""
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture
def fixed_tasks(spark, no_broadcast):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_hot_and_missing_keys_are_spread(spark, fixed_tasks):
    n = F.col("id")
    key = F.when(n % 3 == 0, 1).when(n % 3 == 1, None).otherwise(n % 500)
    facts = spark.range(30_000).select(key.alias("k"), n.alias("row"))
    dimension = spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("attr"))
    assert largest_task(facts.join(dimension, "k", "left")) > 0.3
    assert largest_task(lookup_join(facts, dimension, "k", "left")) < 0.15


def test_only_hot_keys_repeat_in_the_dimension(spark, fixed_tasks):
    facts = spark.range(10_000).select(F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("k"))
    salted = salted_join(facts, spark.range(10_000).withColumnRenamed("id", "k"), ["k"], "inner")
    assert salted.count() == 10_000


def test_composite_key(spark, facts):
    two = facts.withColumn("j", F.col("row") % 2)
    dimension = two.select("k", "j").dropna().distinct().withColumn("attr", F.lit(1))
    salted = salted_join(two, dimension, ["k", "j"], "left")
    assert plain(salted) == plain(two.join(dimension, ["k", "j"], "left"))


def test_lookup_in_both_forms(spark, facts, dimension, no_broadcast):
    shuffled = plain(lookup_join(facts, dimension, "k", "left"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    small = lookup_join(facts, stage(dimension, "dimension"), "k", "left")
    assert "_salt" not in small._jdf.queryExecution().optimizedPlan().toString()
    assert plain(small) == shuffled


def test_star_keeps_the_grain(spark, facts, dimension):
    other = spark.range(5).select(F.col("id").alias("row"), F.lit("x").alias("tag"))
    star = lookup_star(facts, [(dimension, "k", ["attr"]), (other, "row", ["tag"])])
    assert star.count() == facts.count()
    assert star.filter("tag = 'x'").count() == 5


def test_sizes(spark, dimension):
    assert size_in_bytes(stage(dimension, "dimension")) < 10_000


def test_salts_follow_the_rows_of_a_key(spark, fixed_tasks):
    """Sixteen tasks, so a key is hot above a 64th of the rows."""
    n = F.col("id")
    key = F.when(n < 32_000, 1).when(n < 48_000, None).otherwise(n)
    facts = spark.range(64_000).select(key.alias("k"))
    assert plain(hot_keys(facts, ["k"])) == [(1, 32), (None, 16)]


def test_many_keys_just_under_the_old_share_are_even(spark, fixed_tasks):
    """Each key has less than a thousandth of the rows, and some share a task."""
    facts = spark.range(48_000).select((F.col("id") % 1100).alias("k"), F.col("id").alias("row"))
    dimension = spark.range(1100).select(F.col("id").alias("k"), F.lit("x").alias("attr"))
    assert largest_task(lookup_join(facts, dimension, "k", "left")) < 2 / 16


def test_a_third_of_the_rows_on_one_key(spark, fixed_tasks):
    n = F.col("id")
    facts = spark.range(48_000).select(F.when(n % 3 == 0, 1).otherwise(n % 5000).alias("k"), n.alias("row"))
    dimension = spark.range(5000).select(n.alias("k"), F.lit("x").alias("attr"))
    assert largest_task(lookup_join(facts, dimension, "k", "inner")) < 2 / 16
