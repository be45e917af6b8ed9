import uuid
from decimal import Decimal

import pytest

from star_marts import Layers, schemas


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path), prefix=f"t{uuid.uuid4().hex[:8]}_").create()


PAIR = schemas.typed(k=schemas.INT, v=schemas.STRING)


def test_create_twice(layers):
    assert layers.create() is layers


def test_declare_is_empty_and_replaces(spark, layers):
    layers.replace(spark.createDataFrame([(1, "a")], PAIR), "raw.t")
    assert layers.read("raw.t").count() == 1
    empty = layers.declare("raw.t", PAIR)
    assert empty.count() == 0
    assert [f.dataType for f in empty.schema] == [schemas.INT, schemas.STRING]


def test_append_by_name_fills_what_is_missing(spark, layers):
    layers.declare("marts.t", PAIR)
    layers.append(spark.createDataFrame([("x", "1")], "V string, k string"), "marts.t")
    layers.append(spark.createDataFrame([(2,)], "k int"), "marts.t")
    assert sorted(map(tuple, layers.read("marts.t").collect())) == [(1, "x"), (2, None)]


def test_append_by_position(spark, layers):
    layers.declare("marts.t", PAIR)
    layers.append_positional(spark.createDataFrame([(5, "z")], "v int, k string"), "marts.t")
    assert [tuple(r) for r in layers.read("marts.t").collect()] == [(5, "z")]
    with pytest.raises(ValueError):
        layers.append_positional(spark.range(1), "marts.t")


def test_replace_checks_declared_types(spark, layers):
    narrow = schemas.typed(p=schemas.T.DecimalType(6, 3))
    wide = spark.createDataFrame([(Decimal("1234.5"),)], "p decimal(18,3)")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|cannot be represented"):
        layers.replace(wide, "marts.t", narrow)


def test_partitions_are_pruned(spark, layers):
    df = spark.range(100).selectExpr("id", "cast(id % 4 as int) as month")
    stored = layers.replace(df, "marts.t", partition_by=["month"])
    one = stored.filter("month = 2")
    assert one.count() == 25
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_rebuild_where_the_catalog_is_new(spark, layers):
    layers.replace(spark.createDataFrame([(1, "a"), (2, "b")], PAIR), "marts.t")
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"DROP DATABASE {layers.prefix}{layer} CASCADE")
    layers.create()
    again = layers.replace(spark.createDataFrame([(3, "c")], PAIR), "marts.t")
    assert [tuple(r) for r in again.collect()] == [(3, "c")]


def test_drop_deletes_the_files(spark, layers, tmp_path):
    layers.declare("raw.t", PAIR)
    assert (tmp_path / "raw" / "t").exists()
    layers.drop("raw.t")
    assert not (tmp_path / "raw" / "t").exists()


def test_drop_and_names(spark, layers):
    layers.declare("staging.t", PAIR)
    assert layers.exists("staging.t")
    layers.drop("staging.t")
    layers.drop("staging.t")
    assert not layers.exists("staging.t")
    with pytest.raises(ValueError):
        layers.name("elsewhere.t")
    with pytest.raises(ValueError):
        layers.name("t")
