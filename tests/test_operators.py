from pyspark.sql import functions as F

from star_marts.operators import densify, modal_lookup, profile_groups, top_k, weighted_mean


def test_modal_ties_take_the_lowest_value(spark):
    df = spark.createDataFrame(
        [("A", "Y"), ("A", "X"), ("A", "Y"), ("A", "X"), ("B", "Z"), ("B", "Q"), ("B", "Z")],
        "k string, v string",
    )
    got = {r.k: r.v for r in modal_lookup(df, "k", "v").collect()}
    assert got == {"A": "X", "B": "Z"}


def test_profile_matches_builtin_aggregates(spark):
    n = F.col("id")
    df = spark.range(3000).select(
        (n % 7).cast("string").alias("k"),
        F.when(n % 5 > 0, (n % 13).cast("string")).alias("a"),
        (n * n % 11).cast("string").alias("b"),
    )
    got = profile_groups(df, "k", modes=["a", "b"], distinct=["a"])
    want = df.groupBy("k").agg(
        F.count("*").alias("total"),
        F.mode("a", True).alias("a_mode"),
        F.mode("b", True).alias("b_mode"),
        F.countDistinct("a").alias("a_distinct"),
    )
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_profile_of_nulls(spark):
    df = spark.createDataFrame([("A", None), ("A", None), ("B", "")], "k string, v string")
    rows = profile_groups(df, "k", ["v"], ["v"]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [("A", 2, None, 0), ("B", 1, "", 1)]


def test_weighted_mean_leaves_out_unknown_values(spark):
    df = spark.createDataFrame(
        [("a", 10, 100), ("a", 30, None), ("a", 30, 200), ("b", 5, None)], "k string, w int, v int"
    )
    got = {
        r.k: r.m for r in df.groupBy("k").agg(weighted_mean(F.col("v"), F.col("w")).alias("m")).collect()
    }
    assert got == {"a": 175.0, "b": None}


def test_densify_fills_and_accumulates(spark):
    entities = spark.createDataFrame([("x", 1), ("y", 2)], "e string, key int")
    early = spark.createDataFrame([("x", 2014, 9), ("x", 2016, 2), ("z", 2015, 4)], "e string, p int, n long")
    other = spark.createDataFrame([("y", 2015, 3)], "e string, p int, n long")
    rows = densify(entities, "e", "p", 2015, 2017, {"a": early, "b": other}).orderBy("e", "p").collect()
    got = [(r.e, r.p, r.a, r.a_cum, r.b, r.b_cum, r.key) for r in rows]
    assert got == [
        ("x", 2015, 0, 0, 0, 0, 1), ("x", 2016, 2, 2, 0, 0, 1), ("x", 2017, 0, 2, 0, 0, 1),
        ("y", 2015, 0, 0, 3, 3, 2), ("y", 2016, 0, 0, 0, 3, 2), ("y", 2017, 0, 0, 0, 3, 2),
    ]


def test_top_k_puts_null_first_and_breaks_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", None), ("d", 0)], "n string, v int")
    assert [r.n for r in top_k(df, "v", 3, "n").collect()] == ["c", "a", "b"]
