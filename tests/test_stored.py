"""What stored tables do: one-step replacement, keys on insert, counts from the load, buckets, months."""

import json
import subprocess
import sys
import uuid
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from star_marts import Layers, Marts, schemas
from star_marts.operators import count_keys, key_bitmaps, merge_bitmaps
from star_marts.plans import quality, reports
from star_marts.sample_layer import SAMPLE_SETTINGS, SampleLayer

SF_DIR = "/root/testdata/sf0.001"
PAIR = schemas.typed(k=schemas.LONG, v=schemas.STRING)


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "warehouse"), prefix=f"s{uuid.uuid4().hex[:8]}_").create()


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- replace ---------------------------------------------------------------------------------


def test_a_failed_replacement_leaves_the_old_table(spark, layers, tmp_path):
    layers.replace(spark.createDataFrame([(1, "a")], PAIR), "marts.t")
    held = layers.read("marts.t")
    some_fail = spark.range(0, 1000, 1, 8).select(
        "id", F.when(F.col("id") == 999, F.raise_error(F.lit("midway"))).otherwise(F.lit("x")).alias("v")
    )
    with pytest.raises(Exception, match="midway"):
        layers.replace(some_fail, "marts.t")
    assert rows(layers.read("marts.t")) == rows(held) == [(1, "a")]
    assert layers.loaded("marts.t").rows == 1
    assert len([p for p in (tmp_path / "warehouse" / "marts" / "t").iterdir()]) == 1


def test_a_table_may_be_replaced_from_itself(spark, layers, tmp_path):
    layers.replace(spark.createDataFrame([(1, "a"), (2, "b")], PAIR), "marts.t")
    layers.replace(layers.read("marts.t").filter("k = 2").withColumn("w", F.lit(3)), "marts.t")
    assert rows(layers.read("marts.t")) == [(2, "b", 3)]
    assert len([p for p in (tmp_path / "warehouse" / "marts" / "t").iterdir()]) == 1
    assert len(layers._versions("marts.t")) == 1


# --- keys on insert ----------------------------------------------------------------------------


def test_inserts_fill_the_identity_column(spark, layers):
    layers.declare("marts.t", PAIR, identity="k")
    layers.append(spark.createDataFrame([(v,) for v in "dbca"], "v string"), "marts.t", ["v"])
    first = rows(layers.read("marts.t"))
    assert first == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    layers.append(spark.range(500).selectExpr("concat('x', id) AS v").repartition(7), "marts.t")
    layers.append(spark.createDataFrame([(None, "e"), (9000, "f")], "k long, v string"), "marts.t")
    layers.append(spark.createDataFrame([("g",)], "v string"), "marts.t")
    layers.append(spark.createDataFrame([], "v string"), "marts.t")
    every = rows(layers.read("marts.t"))
    keys = [k for k, _ in every]
    assert len(set(keys)) == len(every) == 507 and None not in keys
    assert [r for r in every if r[0] <= 4] == first
    assert sorted(keys)[:504] == list(range(1, 505))
    assert {v: k for k, v in every}["f"] == 9000 and {v: k for k, v in every}["g"] > 9000


def test_a_failed_insert_does_not_give_its_keys_again(spark, layers):
    layers.declare("marts.t", PAIR, identity="k")
    layers.append(spark.createDataFrame([("a",)], "v string"), "marts.t")
    insert = layers._insert
    layers._insert = lambda *_: 1 / 0
    with pytest.raises(ZeroDivisionError):
        layers.append(spark.createDataFrame([("b",)], "v string"), "marts.t")
    layers._insert = insert
    layers.append(spark.createDataFrame([("c",)], "v string"), "marts.t")
    assert rows(layers.read("marts.t")) == [(1, "a"), (3, "c")]


# --- counts and sizes from the load ------------------------------------------------------------------


def test_counts_come_with_the_writes(spark, layers):
    frame = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], PAIR)
    layers.replace(frame, "marts.t")
    layers.append(frame, "marts.t")
    layers.append_positional(frame.filter("k = 1").toDF("x", "y"), "marts.t")
    assert (layers.loaded("marts.t").rows, layers.loaded("marts.t").filled) == (7, {"k": 5, "v": 5})
    layers.declare("marts.t", PAIR)
    assert layers.loaded("marts.t").rows == 0
    layers.replace(frame.filter("k > 5"), "marts.u")
    assert layers.loaded("marts.u").rows == 0
    assert [tuple(r) for r in quality.loaded_row_counts(layers, {"one": "marts.t", "two": "marts.u"}).collect()] == [("one", 0), ("two", 0)]


def test_reports_from_counts_read_no_table(spark, layers):
    marts = Marts(spark, SampleLayer(spark, SF_DIR), SAMPLE_SETTINGS, layers)
    layers.replace(marts.raw.sessions, "raw.sessions")
    fact = marts.fact_session_matched
    found = quality.loaded_reconciliation(layers, "raw.sessions", "marts.fact_session_matched")
    assert "FileScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert rows(found) == rows(quality.reconcile(layers.read("raw.sessions"), fact))
    filled = {"s": "station_key", "p": "revenue_per_kwh", "k": "kwh_delivered"}
    assert rows(quality.loaded_fill_counts(layers, "marts.fact_session_matched", filled)) == rows(quality.fill_counts(fact, filled))


def test_the_optimizer_knows_the_size(spark, layers):
    layers.replace(spark.range(10_000).select("id", (F.col("id") * 2).alias("v")), "marts.t")
    size = int(str(layers.read("marts.t")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    assert 10_000 < size < 400_000


# --- facts by station and by month --------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def by_station(spark, layers):
    settings = replace(SAMPLE_SETTINGS, station_buckets=4)
    return Marts(spark, SampleLayer(spark, SF_DIR), settings, layers)


def test_facts_by_station_move_no_row(spark, by_station, no_broadcast):
    from star_marts.plans import facts

    snapshot = facts.fact_station_daily_snapshot(by_station.fact_session_matched, by_station.dim_station_matched)
    assert "Exchange" not in plan(snapshot)
    stored = by_station.fact_station_daily_snapshot
    per_station = stored.groupBy("station_key").agg(F.sum("total_revenue")).join(
        by_station.dim_station_matched.select("station_key", "station_name"), "station_key"
    )
    assert "Exchange" not in plan(per_station)
    # The report moves a row per station to merge those of one name, and nothing before that.
    report = reports.top_stations_lifetime(stored, by_station.dim_station_matched)
    text = plan(report)
    assert text.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(station_name" in text
    plain = Marts(spark, by_station.raw, SAMPLE_SETTINGS)
    want = reports.top_stations_lifetime(plain.fact_station_daily_snapshot, plain.dim_station_matched)
    assert rows(report) == rows(want)


def test_a_hot_station_is_not_stored_in_one_bucket(spark, layers):
    marts = Marts(spark, SampleLayer(spark, SF_DIR), replace(SAMPLE_SETTINGS, station_buckets=8), layers)
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("station_key"))
    assert marts._buckets(hot) is None
    assert marts._buckets(spark.range(1000).withColumnRenamed("id", "station_key")) == ("station_key", 8)
    assert marts._buckets(spark.range(5)) is None


def test_buckets_grow_with_the_rows(spark, layers, monkeypatch):
    """A bucket is one task's, so there are more of them for more rows, and as many in all tables."""
    from star_marts.plans import marts as plans

    monkeypatch.setattr(plans, "BUCKET_ROWS", 200)
    raw = SampleLayer(spark, SF_DIR)
    stored = Marts(spark, raw, replace(SAMPLE_SETTINGS, station_buckets=2), layers)
    assert stored._enough_buckets(400) == 2 and stored._enough_buckets(401) == 4
    want = stored._enough_buckets(raw.sessions.count())
    assert stored.station_buckets == want > 8
    assert stored._buckets(spark.range(200 * want + 1).withColumnRenamed("id", "station_key")) == ("station_key", 2 * want)
    stations = stored.dim_station_matched
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {layers.name(layers.current('marts.dim_station_matched'))}").collect()}
    assert described["Num Buckets"] == str(want) and stations.count() > 0
    plain = Marts(spark, raw, SAMPLE_SETTINGS)
    report = reports.top_stations_lifetime(stored.fact_station_daily_snapshot, stored.dim_station_matched)
    assert rows(report) == rows(reports.top_stations_lifetime(plain.fact_station_daily_snapshot, plain.dim_station_matched))


def test_reports_of_a_year_read_its_months(spark, layers):
    settings = replace(SAMPLE_SETTINGS, facts_by_month=True)
    marts = Marts(spark, SampleLayer(spark, SF_DIR), settings, layers)
    plain = Marts(spark, marts.raw, SAMPLE_SETTINGS)
    pairs = [
        (reports.monthly_revenue(marts.fact_session_bridged, marts.dim_date_bridged, 1998),
         reports.monthly_revenue(plain.fact_session_bridged, plain.dim_date_bridged, 1998)),
        (reports.underserved_markets(marts.fact_market_demand, marts.dim_location_county, marts.dim_date, 2000, 0, 0),
         reports.underserved_markets(plain.fact_market_demand, plain.dim_location_county, plain.dim_date, 2000, 0, 0)),
    ]
    for stored, want in pairs:
        assert rows(stored) == rows(want) != []
        assert "dynamicpruning" in plan(stored)
    every = reports.monthly_revenue(marts.fact_session_bridged, marts.dim_date_bridged)
    one_year, all_years = (_files_read(spark, df) for df in (pairs[0][0], every))
    assert 0 < one_year < all_years / 3


def _files_read(spark, df):
    """Files that the scan of the fact opened."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    found = []

    def visit(node):
        if "AdaptiveSparkPlan" in node.nodeName():
            return visit(node.executedPlan())
        if hasattr(node, "plan") and "QueryStage" in node.nodeName():
            return visit(node.plan())
        metrics = node.metrics()
        if "month_key" in node.toString() and node.nodeName().startswith("Scan parquet") and metrics.contains("numFiles"):
            found.append(metrics.apply("numFiles").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(query.executedPlan())
    return max(found)


# --- distinct counts that merge ---------------------------------------------------------------------------


def test_bitmaps_merge(spark):
    n = F.col("id")
    listed = spark.range(200_000).select(
        (n % 7).alias("fine"), (n % 7 % 2).alias("coarse"), F.when(n % 11 != 0, n * n % 90_001 + 1).alias("key")
    )
    fine = key_bitmaps(listed, ["coarse", "fine"], "key")
    for bitmaps, groups in ((fine, ["coarse", "fine"]), (merge_bitmaps(fine, ["coarse"]), ["coarse"]), (merge_bitmaps(fine, []), [])):
        want = listed.groupBy(*groups).agg(F.countDistinct("key").alias("n")) if groups else listed.agg(F.countDistinct("key").alias("n"))
        assert rows(count_keys(bitmaps, groups, "n")) == rows(want)


def test_a_station_in_two_zips_counts_once(spark):
    markets = spark.createDataFrame(
        [("1", "A", "C", 10), ("2", "A", "C", 10), ("3", "B", "C", 5)], "zip string, city string, county string, total_ev_registrations long"
    )
    stations = spark.createDataFrame([(1, "1"), (1, "2"), (2, "2"), (2, "3"), (3, None), (None, "1")], "station_key long, zip string")
    found = reports.evs_per_station(markets, stations).collect()
    assert [(r.city, r.station_count, float(r.evs_per_station)) for r in found] == [("A", 2, 5.0), ("B", 1, 5.0)]
    assert rows(reports.county_stations(markets, stations)) == [("C", 2)]


# --- one parse per file ----------------------------------------------------------------------------------


SCANS = """
import json, sys
sys.path.insert(0, {root!r})
from star_marts import local_session
from checks.queries import QUERIES
spark = local_session(2, **{{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {log!r}, "spark.eventLog.compress": "false", "spark.sql.shuffle.partitions": "2"}})
QUERIES["csv_source_counts"](spark, {sf!r}).collect()
spark.stop()
"""


def test_each_file_is_parsed_once(tmp_path):
    """From the event log: the bytes of CSV scans over all stages, against the files."""
    log = tmp_path / "log"
    log.mkdir()
    root = str(Path(__file__).resolve().parent.parent)
    code = SCANS.format(root=root, log=str(log), sf=SF_DIR)
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    scans: dict[str, int] = {}

    def visit(node, execution):
        if node["nodeName"].startswith("Scan csv"):
            place = node["metadata"]["Location"].split("[", 1)[1]
            scans.setdefault(place, set()).add(execution)
        for child in node["children"]:
            visit(child, execution)

    for file in log.rglob("*"):
        if file.is_file() and not file.name.startswith("."):
            for line in file.read_text().splitlines():
                event = json.loads(line) if line.startswith("{") else {}
                if event.get("Event", "").endswith("SparkListenerSQLExecutionStart"):
                    visit(event["sparkPlanInfo"], event["executionId"])
    assert len(scans) >= 6
    assert all(len(found) == 1 for found in scans.values()), scans
