"""One query per operator, on the raw layer derived from the test tables.

Every query starts from the parquet tables: nothing is kept from one query to the next.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from star_marts import CsvSources, Layers, Marts, read_csv_sources, schemas, store_raw
from star_marts.functions import calendar_covering, try_date
from star_marts.operators import densify, with_surrogate_key
from star_marts.plans import dimensions, facts, quality, reports
from star_marts.sample_layer import SAMPLE_SETTINGS, SampleLayer
from star_marts.session import scratch_path
from star_marts.sources import apply_types, read_by_header, read_positional, read_typed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as ISO text, to compare with another engine."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name).cast("string").alias(f.name)
            if isinstance(f.dataType, T.DateType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(build(spark, sf_dir))

    QUERIES[build.__name__] = run
    return run


def on_marts(build: Callable[[Marts], DataFrame]) -> Query:
    """A query on freshly derived marts."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Marts(spark, SampleLayer(spark, sf_dir), SAMPLE_SETTINGS))

    return query(run)


def on_oversized(build: Callable[[Marts], DataFrame]) -> Query:
    """A query on marts whose sessions have measures beyond their declared types."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Marts(spark, SampleLayer(spark, sf_dir, oversized=True), SAMPLE_SETTINGS))

    return query(run)


def _layers(spark: SparkSession) -> Layers:
    root = scratch_path(spark, "layers")
    return Layers(spark, root, prefix=root.rsplit("-", 1)[1] + "_").create()


# --- staging, calendar, lookups ---------------------------------------------------------


@on_marts
def clean_registrations(m: Marts) -> DataFrame:
    return m.registrations_clean


@on_marts
def zip_to_county(m: Marts) -> DataFrame:
    return dimensions.zip_to_county(m.raw.registrations)


def _session_dates(m: Marts) -> DataFrame:
    return m.raw.sessions.select(try_date("session_date").alias("session_date"))


@on_marts
def calendar_year(m: Marts) -> DataFrame:
    return calendar_covering(_session_dates(m), "session_date", "year")


@on_marts
def calendar_day(m: Marts) -> DataFrame:
    return reports.calendar_listing(calendar_covering(_session_dates(m), "session_date"))


@on_marts
def calendar_bounds(m: Marts) -> DataFrame:
    return quality.bounds(
        calendar_covering(_session_dates(m), "session_date", weekend_as="int"), "full_date"
    )


@on_marts
def calendar_slice(m: Marts) -> DataFrame:
    days = calendar_covering(_session_dates(m), "session_date", weekend_as="int")
    week = quality.slice_between(days, "date_key", 19980601, 19980607)
    return week.select("date_key", "full_date", "day_name", "is_weekend")


@on_marts
def census_weighted_income(m: Marts) -> DataFrame:
    return dimensions.county_census(
        m.raw.census_population, m.raw.census_income, m.zip_to_county
    )


# --- dimensions and keys ----------------------------------------------------------------


@on_marts
def dim_location_county(m: Marts) -> DataFrame:
    return m.dim_location_county


@on_marts
def dim_location_zip_city(m: Marts) -> DataFrame:
    return m.dim_location_zip_city


@on_marts
def location_variants(m: Marts) -> DataFrame:
    return dimensions.location_variants(m.dim_station_bridged, m.registrations_clean)


@on_marts
def dim_station_matched(m: Marts) -> DataFrame:
    return m.dim_station_matched


@on_marts
def dim_station_bridged(m: Marts) -> DataFrame:
    return m.dim_station_bridged


@on_marts
def dim_ev_market(m: Marts) -> DataFrame:
    return m.dim_ev_market


@query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderdate", "o_orderkey")
    keyed = with_surrogate_key(orders, "order_rank", ["o_orderdate", "o_orderkey"])
    return keyed.select("order_rank", "o_orderkey")


@on_marts
def identity_keys(m: Marts) -> DataFrame:
    return _key_counts(facts.with_identity_key(m.fact_session_matched, "session_key"), "session_key")


@on_marts
def snapshot_identity_keys(m: Marts) -> DataFrame:
    snapshot = facts.with_identity_key(m.fact_station_daily_snapshot, "snapshot_key")
    return _key_counts(snapshot, "snapshot_key")


def _key_counts(fact: DataFrame, key: str) -> DataFrame:
    return fact.agg(
        F.count("*").alias("row_count"),
        F.countDistinct(key).alias("distinct_keys"),
        F.count_if(F.col(key).isNull()).alias("missing_keys"),
    )


# --- demand -----------------------------------------------------------------------------


@on_marts
def new_registrations_by_county_year(m: Marts) -> DataFrame:
    return m.new_registrations.withColumnRenamed("n", "new_evs")


@on_marts
def station_openings_by_county_year(m: Marts) -> DataFrame:
    return m.new_stations.withColumnRenamed("n", "new_stations")


def _cumulative(m: Marts, name: str, counts: DataFrame) -> DataFrame:
    counties = m.dim_location_county.select("location_key", F.col("county_name").alias("county"))
    s = m.settings
    return densify(counties, "county", "year", s.demand_first, s.demand_last, {name: counts})


@on_marts
def cumulative_registrations(m: Marts) -> DataFrame:
    return _cumulative(m, "new_evs", m.new_registrations)


@on_marts
def cumulative_stations(m: Marts) -> DataFrame:
    return _cumulative(m, "new_stations", m.new_stations)


@on_marts
def market_demand(m: Marts) -> DataFrame:
    return m.fact_market_demand


@on_marts
def underserved_markets(m: Marts) -> DataFrame:
    return reports.underserved_markets(
        m.fact_market_demand, m.dim_location_county, m.dim_date, year=2000
    )


@on_marts
def regional_growth(m: Marts) -> DataFrame:
    return reports.regional_growth(
        m.fact_market_demand, m.dim_location_county, m.dim_date, 1997, 2000
    )


@on_marts
def largest_locations(m: Marts) -> DataFrame:
    return reports.largest_locations(m.dim_location_county)


# --- session facts ----------------------------------------------------------------------


@on_oversized
def session_fact_matched(m: Marts) -> DataFrame:
    return m.fact_session_matched


@on_marts
def session_fact_whole_numbers(m: Marts) -> DataFrame:
    """The reading that takes every measure as a whole number."""
    fact = facts.fact_session_matched(m.raw.sessions, m.dim_station_matched, scale=0)
    return fact.select(
        "session_id", "station_key", "date_key", "kwh_delivered", "revenue_usd", "revenue_per_kwh"
    )


@on_marts
def orphan_sessions(m: Marts) -> DataFrame:
    return facts.orphan_sessions(m.raw.sessions, m.dim_station_matched)


@on_marts
def load_reconciliation(m: Marts) -> DataFrame:
    return quality.reconcile(m.raw.sessions, m.fact_session_matched)


@on_marts
def station_daily_snapshot(m: Marts) -> DataFrame:
    return m.fact_station_daily_snapshot


@on_marts
def session_fact_bridged(m: Marts) -> DataFrame:
    return m.fact_session_bridged


@on_marts
def session_sample(m: Marts) -> DataFrame:
    """Any five rows: how many there are, and how many of them the raw table has."""
    sample = reports.sample_rows(m.raw.sessions)
    known = sample.join(m.raw.sessions.select("session_id"), "session_id", "left_semi")
    return quality.row_counts({"sample": sample, "known": known}, "rows_of")


# --- reports ----------------------------------------------------------------------------


@on_marts
def revenue_by_network(m: Marts) -> DataFrame:
    return reports.revenue_by_network(m.fact_session_matched, m.dim_station_matched)


@on_marts
def top_networks(m: Marts) -> DataFrame:
    return reports.top_networks(m.dim_station_matched)


@on_marts
def port_totals(m: Marts) -> DataFrame:
    return reports.port_totals(m.dim_station_matched)


@on_marts
def county_ports(m: Marts) -> DataFrame:
    return reports.county_ports(m.dim_station_matched, m.dim_location_county)


@on_marts
def utilization_tiers(m: Marts) -> DataFrame:
    return reports.utilization_tiers(m.fact_station_daily_snapshot)


@on_marts
def utilization_tiers_known(m: Marts) -> DataFrame:
    return reports.utilization_tiers(m.fact_station_daily_snapshot, unknown="unknown")


@on_marts
def top_stations_lifetime(m: Marts) -> DataFrame:
    return reports.top_stations_lifetime(m.fact_station_daily_snapshot, m.dim_station_matched)


@on_marts
def top_stations_revenue(m: Marts) -> DataFrame:
    return reports.top_stations_revenue(m.bridged_sessions, m.dim_station_bridged)


@on_marts
def monthly_revenue(m: Marts) -> DataFrame:
    return reports.monthly_revenue(m.bridged_sessions, m.dim_date_bridged)


@on_marts
def evs_per_station(m: Marts) -> DataFrame:
    return reports.evs_per_station(m.dim_ev_market, m.dim_station_bridged)


def _listed_twice(m: Marts) -> DataFrame:
    """Stations, each third one listed under the next zip as well."""
    listed = m.dim_station_bridged.select("station_key", "zip")
    second = listed.filter("station_key % 3 = 0").select(
        "station_key", (F.col("zip").cast("int") + 1).cast("string").alias("zip")
    )
    return listed.unionByName(second)


@on_marts
def evs_per_station_listed(m: Marts) -> DataFrame:
    """The expansion report where a station may be listed under two zips."""
    return reports.evs_per_station(m.dim_ev_market, _listed_twice(m))


@on_marts
def county_stations_listed(m: Marts) -> DataFrame:
    """Distinct stations per county, merged from those of its markets."""
    return reports.county_stations(m.dim_ev_market, _listed_twice(m))


# --- quality ----------------------------------------------------------------------------


@on_marts
def row_counts(m: Marts) -> DataFrame:
    return quality.row_counts(
        {
            "raw_ev_stations": m.raw.station_feed,
            "raw_ev_registrations": m.raw.registrations_positional,
            "raw_sessions": m.raw.sessions,
            "dim_location": m.dim_location_zip_city,
            "dim_ev_market": m.dim_ev_market,
            "fact_charging_session": m.fact_session_bridged,
        }
    )


@on_marts
def duplicate_keys(m: Marts) -> DataFrame:
    return quality.duplicate_keys(m.raw.sessions, "session_id")


@on_marts
def duplicate_zip_city(m: Marts) -> DataFrame:
    return quality.duplicate_keys(m.registrations_clean, "zip", "city")


@on_marts
def dimension_duplicates(m: Marts) -> DataFrame:
    """Keys that occur twice in the (zip, city) dimension: none do."""
    return quality.duplicate_keys(m.dim_location_zip_city, "zip", "city")


@on_marts
def fk_fill_rates(m: Marts) -> DataFrame:
    return quality.fill_counts(
        m.fact_session_bridged,
        {
            "has_station": "station_key",
            "has_date": "date_key",
            "has_location": "location_key",
            "has_market": "market_key",
        },
        total="total_sessions",
    )


@on_marts
def missing_dates(m: Marts) -> DataFrame:
    """Date keys of matched sessions that the later calendar does not have."""
    return quality.missing_references(m.fact_session_matched, m.dim_date_bridged, "date_key")


@on_marts
def placeholder_counts(m: Marts) -> DataFrame:
    return quality.placeholder_counts(
        m.registrations_clean,
        {
            "blank_counties": F.col("county") == "",
            "placeholder_zips": F.col("zip") == "00000",
            "unknown_years": F.col("model_year").isNull(),
        },
    )


@on_oversized
def overflow_counts(m: Marts) -> DataFrame:
    """Of the text, before anything is lost; minutes by the type of the typed sessions."""
    declared = T.StructType(
        [schemas.FACT_SESSION_MATCHED[c] for c in ("kwh_delivered", "revenue_usd")]
        + [schemas.TYPED_SESSIONS["duration_minutes"]]
    )
    return quality.overflow_counts(m.raw.sessions, declared)


@on_oversized
def overflow_ratios(m: Marts) -> DataFrame:
    ratio = m.fact_session_matched.select("revenue_per_kwh")
    return quality.overflow_counts(ratio, schemas.FACT_SESSION_MATCHED)


@on_marts
def market_duplicates(m: Marts) -> DataFrame:
    return quality.duplicate_keys(m.dim_ev_market, "zip")


def _stored(m: Marts) -> Marts:
    """Marts that are stored in layers of their own."""
    return Marts(m.spark, m.raw, m.settings, _layers(m.spark))


@on_marts
def stored_row_counts(m: Marts) -> DataFrame:
    """Row counts as the writes counted them; no stored table is read for them."""
    stored = _stored(m)
    layers = stored.layers
    for table, rows in {
        "raw.station_feed": m.raw.station_feed, "raw.registrations": m.raw.registrations_positional,
        "raw.sessions": m.raw.sessions,
    }.items():
        layers.replace(rows, table)
    for built in (stored.dim_location_zip_city, stored.dim_ev_market, stored.fact_session_bridged):
        assert built is not None
    return quality.loaded_row_counts(layers, {
        "raw_ev_stations": "raw.station_feed", "raw_ev_registrations": "raw.registrations",
        "raw_sessions": "raw.sessions", "dim_location": "marts.dim_location_zip_city",
        "dim_ev_market": "marts.dim_ev_market", "fact_charging_session": "marts.fact_session_bridged",
    })


@on_marts
def stored_fk_fill_rates(m: Marts) -> DataFrame:
    """Filled keys of the bridged fact as its write counted them."""
    stored = _stored(m)
    assert stored.fact_session_bridged is not None
    keys = {
        "has_station": "station_key", "has_date": "date_key", "has_location": "location_key",
        "has_market": "market_key",
    }
    return quality.loaded_fill_counts(stored.layers, "marts.fact_session_bridged", keys, "total_sessions")


@on_marts
def stored_load_reconciliation(m: Marts) -> DataFrame:
    """Raw against loaded sessions as the writes counted them."""
    stored = _stored(m)
    stored.layers.replace(m.raw.sessions, "raw.sessions")
    assert stored.fact_session_matched is not None
    return quality.loaded_reconciliation(stored.layers, "raw.sessions", "marts.fact_session_matched")


@on_marts
def stored_monthly_revenue(m: Marts) -> DataFrame:
    """Months of one year from a fact stored by month, of which only these are read."""
    stored = Marts(m.spark, m.raw, replace(m.settings, facts_by_month=True), _layers(m.spark))
    return reports.monthly_revenue(stored.fact_session_bridged, stored.dim_date_bridged, 1998)


@on_marts
def stored_stations_lifetime(m: Marts) -> DataFrame:
    """The lifetime report on facts and stations stored by station."""
    stored = Marts(m.spark, m.raw, replace(m.settings, station_buckets=8), _layers(m.spark))
    return reports.top_stations_lifetime(stored.fact_station_daily_snapshot, stored.dim_station_matched)


# --- landing and tables -----------------------------------------------------------------


@query
def csv_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """75 text columns by position, with commas and quotes inside a field."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.concat(F.lit(", "), F.col("p_type"), F.lit(' "model"')).alias("suffix"),
    )
    stations = SampleLayer(spark, sf_dir).stations.join(part, "id").withColumn(
        "station_name", F.concat("station_name", "suffix")
    )
    path = scratch_path(spark, "stations-csv")
    _write_csv(stations.select(*schemas.RAW_STATIONS.fieldNames()), path)
    landed = read_positional(spark, path, schemas.RAW_STATIONS).good
    return landed.select(
        "id", "station_name", "ev_network", "city", "zip", "ev_level2_evse_num", "open_date"
    )


@query
def csv_stations_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations whose names have line breaks, separators and quotes inside quotes."""
    stations = SampleLayer(spark, sf_dir).stations
    k = F.col("id").cast("bigint")
    name = F.when(k % 3 == 0, F.concat("station_name", F.lit('\n"second, line",\n'), "id")).otherwise(F.col("station_name"))
    path = scratch_path(spark, "lines-csv")
    _write_csv(stations.withColumn("station_name", name), path)
    landed = read_positional(spark, path, schemas.RAW_STATIONS, multiline=True).good
    return landed.select("id", "station_name", "zip", "open_date")


@query
def csv_station_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns by header name, padded and in another order, with null tokens."""
    feed = SampleLayer(spark, sf_dir).station_feed
    k = F.col("ID").cast("bigint")
    token = F.when(k % 2 == 0, "NULL").otherwise("null")
    padded = feed.select(
        F.concat(F.lit("  "), "CITY", F.lit(" ")).alias("City"),
        F.col("ZIP").alias("zip"),
        F.coalesce("EVNETWORK", token).alias("EV Network"),
        F.col("STATIONNAME").alias("Station Name"),
        F.col("OPENDATE").alias("Open_Date"),
        F.col("ID").alias("id"),
    )
    path = scratch_path(spark, "feed-csv")
    _write_csv(padded, path)
    landed = read_by_header(spark, path, schemas.RAW_STATION_FEED)
    return landed.select("ID", "STATIONNAME", "EVNETWORK", "ZIP", "CITY", "STATE", "OPENDATE")


@query
def csv_station_feed_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of files with different column order, one of them without a column."""
    feed = SampleLayer(spark, sf_dir).station_feed
    k = F.col("ID").cast("bigint") % 3
    path = scratch_path(spark, "mixed-csv")
    orders = [["ID", "ZIP", "CITY", "STATIONNAME"], ["CITY", "ID", "STATIONNAME", "ZIP"], ["STATIONNAME", "ID", "CITY"]]
    for n, columns in enumerate(orders):
        _write_csv(feed.filter(k == n).select(*columns), path)
    landed = read_by_header(spark, path, schemas.RAW_STATION_FEED)
    return landed.select("ID", "STATIONNAME", "ZIP", "CITY")


def _write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(
        header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def _ragged_sessions(spark: SparkSession, sf_dir: str) -> str:
    """Session lines of which some have a field too many and some one too few."""
    sessions = SampleLayer(spark, sf_dir).numbered_sessions
    number = F.col("session_id").cast("bigint")
    fields = [F.coalesce(c, F.lit("")) for c in sessions.columns]
    line = (
        F.when(number % 89 == 0, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(number % 83 == 0, F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = scratch_path(spark, "sessions-csv")
    sessions.select(line.alias("value")).write.text(path)
    return path


@query
def csv_sessions_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _ragged_sessions(spark, sf_dir)
    return read_typed(spark, path, schemas.TYPED_SESSIONS, header=False).good


@query
def csv_sessions_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _ragged_sessions(spark, sf_dir)
    rejected = read_typed(spark, path, schemas.TYPED_SESSIONS, header=False).rejected
    return rejected.groupBy("reason").agg(
        F.count("*").alias("row_count"), F.countDistinct("session_id").alias("session_ids")
    )


@on_marts
def typed_sessions_rejected(m: Marts) -> DataFrame:
    split = apply_types(m.raw.sessions, schemas.TYPED_SESSIONS)
    return split.rejected.groupBy("reason").agg(F.count("*").alias("row_count"))


@on_marts
def inserted_locations(m: Marts) -> DataFrame:
    """Two inserts by name into a declared table, columns out of order; the table fills its keys."""
    layers = _layers(m.spark)
    layers.declare("marts.dim_location", schemas.DIM_LOCATION_COUNTY, identity="location_key")
    rows = m.dim_location_county.select("median_income", "population", "county_name", "region")
    north = F.col("region") == "North"
    layers.append(rows.filter(north), "marts.dim_location", ["county_name"])
    layers.append(rows.filter(~north), "marts.dim_location", ["county_name"])
    return layers.read("marts.dim_location")


@on_marts
def inserted_calendar(m: Marts) -> DataFrame:
    """Drop, declare and insert by position."""
    layers = _layers(m.spark)
    layers.drop("marts.dim_date")
    layers.declare("marts.dim_date", schemas.DIM_DATE_YEAR)
    years = calendar_covering(_session_dates(m), "session_date", "year")
    layers.append_positional(years.toDF("a", "b", "c"), "marts.dim_date")
    return layers.read("marts.dim_date")


@on_marts
def loaded_raw_counts(m: Marts) -> DataFrame:
    """Reset the landing tables, load them by position, count them."""
    layers = _layers(m.spark)
    tables = layers.reset_raw()
    for table in tables:
        layers.append_positional(getattr(m.raw, table), f"raw.{table}")
    return quality.row_counts({t: layers.read(f"raw.{t}") for t in tables}, "tbl")


@query
def csv_source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All source files written as CSV and read back: loaded and skipped rows per table."""
    sample = SampleLayer(spark, sf_dir)
    root = scratch_path(spark, "sources")
    for table in CSV_TABLES:
        _write_csv(getattr(sample, table), f"{root}/{table}")
    _write_csv(sample.numbered_sessions, f"{root}/sessions")
    paths = CsvSources(**{table: f"{root}/{table}" for table in [*CSV_TABLES, "sessions"]})
    raw, rejected = read_csv_sources(spark, paths)
    loaded = {name: getattr(raw, name) for name in [*CSV_TABLES, "sessions", "typed_sessions"]}
    skipped = {f"{name} skipped": rows for name, rows in rejected.items()}
    return quality.row_counts({**loaded, **skipped}, "tbl")


CSV_TABLES = ["stations", "station_feed", "registrations", "census_population", "census_income"]


@query
def rebuilt_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing tables and every table of both generations written to their layers, counted."""
    layers = _layers(spark)
    raw = store_raw(SampleLayer(spark, sf_dir), layers)
    return quality.row_counts(Marts(spark, raw, SAMPLE_SETTINGS, layers).build(), "tbl")
