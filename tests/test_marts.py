"""Traps of the dimensions, facts and reports on small literal frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts import schemas
from star_marts.functions import dim_date, half_up_ratio
from star_marts.plans import dimensions, facts, quality, reports, staging


def frame(spark, schema, *records):
    """Rows given as dicts; columns not mentioned are NULL."""
    data = [tuple(r.get(n) for n in schema.fieldNames()) for r in records]
    return spark.createDataFrame(data, schema)


def registrations(spark, *records):
    return frame(spark, schemas.RAW_REGISTRATIONS, *records)


def tuples(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


# --- staging ----------------------------------------------------------------------------


def test_registrations_are_mapped_by_position(spark):
    values = [f"v{i}" for i in range(1, 21)]
    values[3:9] = [" troy ", "NY", "12180-0001", " rensselaer", "2021.4", "tesla "]
    raw = spark.createDataFrame([tuple(values)], schemas.RAW_REGISTRATIONS_POSITIONAL)
    row = staging.clean_registrations(raw).first()
    assert row.__fields__ == fixed.CLEAN_REGISTRATION_COLUMNS
    assert row.asDict() == {
        "record_type": "v1", "vin_suffix": "v2", "registration_class": "v3", "city": "TROY",
        "state": "NY", "zip": "12180", "county": "RENSSELAER", "model_year": 2021, "make": "TESLA",
        "body_type": "v10", "fuel_type": "v11", "unladen_weight": "v12", "max_gross_weight": "v13",
        "passengers": "v14", "reg_valid_date": "v15", "reg_expiry_date": "v16", "color": "v17",
    }


def test_state_is_tested_as_delivered(spark):
    raw = registrations(spark, {"state": "NY"}, {"state": " ny"}, {"state": "ny"}, {"state": None})
    assert staging.clean_registrations(raw).count() == 1


def test_placeholder_zips_and_blank_counties_are_kept_and_counted(spark):
    raw = registrations(
        spark, {"state": "NY", "zip": "N/A", "county": "  "}, {"state": "NY", "zip": "10001", "county": "X"}
    )
    clean = staging.clean_registrations(raw)
    counts = quality.placeholder_counts(
        clean, {"zips": F.col("zip") == "00000", "blank": F.col("county") == ""}
    ).first()
    assert tuple(counts) == (1, 1)


# --- dimensions -------------------------------------------------------------------------


def test_zip_to_county_ignores_blanks_and_breaks_ties(spark):
    raw = registrations(
        spark,
        {"zip": "1", "county": " kings "}, {"zip": "1", "county": "KINGS"}, {"zip": "1", "county": "ERIE"},
        {"zip": "2", "county": "QUEENS"}, {"zip": "2", "county": "BRONX"},
        {"zip": "3", "county": "  "}, {"zip": "4", "county": None}, {"zip": None, "county": "KINGS"},
    )
    assert sorted(tuples(dimensions.zip_to_county(raw), "zip", "county")) == [("1", "KINGS"), ("2", "BRONX")]


def test_state_is_no_filter_unless_asked(spark):
    raw = registrations(
        spark, {"zip": "1", "county": "A", "state": "NY"}, {"zip": "2", "county": "B", "state": "NJ"}
    )
    assert dimensions.zip_to_county(raw).count() == 2
    assert dimensions.zip_to_county(raw, state="NY").count() == 1


def census(spark):
    population = frame(
        spark, schemas.RAW_CENSUS_POPULATION,
        {"geo_id": "g1", "name": "ZCTA5 10001", "population_estimate": "100"},
        {"geo_id": "g2", "name": "ZCTA5 10002", "population_estimate": "300"},
        {"geo_id": "g3", "name": "ZCTA5 10003", "population_estimate": "-"},
        {"geo_id": "g4", "name": "ZCTA5 10004", "population_estimate": "50"},
        {"geo_id": "g5", "name": "no code", "population_estimate": "50"},
    )
    income = frame(
        spark, schemas.RAW_CENSUS_INCOME,
        {"geo_id": "g1", "median_income": "1000"}, {"geo_id": "g2", "median_income": "2001"},
        {"geo_id": "g4", "median_income": "-"},
    )
    zips = spark.createDataFrame(
        [("10001", "KINGS"), ("10002", "KINGS"), ("10003", "KINGS"), ("10004", "ELSEWHERE")],
        "zip string, county string",
    )
    return population, income, zips


def test_county_locations(spark):
    got = dimensions.dim_location_county(*census(spark)).orderBy("location_key")
    assert [tuple(r) for r in got.collect()] == [
        (1, "ELSEWHERE", "NY", "Other NY", 50, None),
        (2, "KINGS", "NY", "NYC", 400, Decimal("1750.75")),
    ]


def stations(spark, *records):
    return frame(spark, schemas.RAW_STATIONS, *records)


@pytest.fixture
def matched_stations(spark):
    raw = stations(
        spark,
        {"id": "10", "fuel_type_code": "ELEC", "station_name": "b", "zip": "10001", "status_code": "E",
         "ev_level1_evse_num": "2", "ev_level2_evse_num": "n/a", "open_date": "2020-05-01",
         "latitude": "40.7128"},
        {"id": "9", "fuel_type_code": "ELEC", "station_name": "a", "zip": "99999", "ev_network": "Net",
         "open_date": "unknown"},
        {"id": "8", "fuel_type_code": "LPG", "zip": "10001"},
        {"id": None, "fuel_type_code": "ELEC", "zip": "10001"},
    )
    population, income, zips = census(spark)
    locations = dimensions.dim_location_county(population, income, zips)
    return dimensions.dim_station_matched(raw, zips, locations)


def test_matched_stations(spark, matched_stations):
    assert matched_stations.columns == schemas.DIM_STATION_MATCHED.fieldNames()
    assert [f.dataType for f in matched_stations.schema] == [f.dataType for f in schemas.DIM_STATION_MATCHED]
    nine, ten = matched_stations.orderBy("station_key").collect()
    assert (nine.station_key, nine.station_id, nine.county, nine.location_key) == (1, "9", None, None)
    assert (nine.ev_network, nine.total_port_count, nine.open_date, nine.is_active) == ("Net", 0, None, False)
    assert (ten.station_key, ten.county, ten.location_key, ten.ev_network) == (2, "KINGS", 2, "Non-Networked")
    assert (ten.level1_count, ten.level2_count, ten.total_port_count) == (2, None, 2)
    assert (ten.latitude, ten.open_date, ten.is_active) == (40.7128, dt.date(2020, 5, 1), True)


@pytest.fixture
def feed(spark):
    return frame(
        spark, schemas.RAW_STATION_FEED,
        {"ID": "10", "STATIONNAME": "x", "ZIP": " 10001 ", "CITY": "troy ", "STATE": "ny", "LATITUDE": "40.5"},
        {"ID": "9", "STATIONNAME": "y", "ZIP": "10002", "CITY": "ROME", "LATITUDE": "12345678.0"},
        {"ID": "11", "STATIONNAME": "z", "ZIP": "1", "CITY": "ROME"},
        {"ID": None, "STATIONNAME": "gone"},
    )


def test_bridged_stations_are_keyed_by_number(spark, feed):
    got = dimensions.dim_station_bridged(feed).orderBy("station_key")
    assert tuples(got, "station_key", "station_id", "zip", "city", "state", "latitude") == [
        (1, 9, "10002", "ROME", None, None),
        (2, 10, "10001", "TROY", "NY", Decimal("40.500000")),
        (3, 11, "1", "ROME", None, None),
    ]


def clean(spark, *records):
    return staging.clean_registrations(registrations(spark, *[{"state": "NY", **r} for r in records]))


def test_zip_city_locations(spark, feed):
    regs = clean(
        spark,
        {"zip": "10001", "city": "Troy", "county": "A"}, {"zip": "10001", "city": "TROY", "county": "B"},
        {"zip": "10009", "city": None, "county": "C"}, {"zip": "10003", "city": "Utica", "county": " "},
    )
    station_dim = dimensions.dim_station_bridged(feed)
    got = dimensions.dim_location_zip_city(station_dim, regs).orderBy("location_key")
    assert [tuple(r) for r in got.collect()] == [
        (1, "10001", "TROY", "NY", "B"), (2, "10002", "ROME", None, None), (3, "10003", "UTICA", "NY", ""),
    ]
    assert dimensions.location_variants(station_dim, regs).count() == 5
    assert quality.duplicate_keys(got, "zip", "city").count() == 0


def test_market_modes(spark):
    regs = clean(
        spark,
        {"zip": "10001", "make": "b", "city": "x", "county": " "},
        {"zip": "10001", "make": "a", "city": "x", "county": " "},
        {"zip": "10001", "make": None, "city": "y", "county": "K"},
        {"zip": None, "make": "q"},
    )
    got = dimensions.dim_ev_market(regs)
    assert [tuple(r) for r in got.collect()] == [(1, "10001", "X", "", 3, 2, "A")]


# --- demand -----------------------------------------------------------------------------


def test_demand(spark):
    locations = dimensions.dim_location_county(*census(spark))
    regs = registrations(
        spark,
        *[{"county": "kings ", "model_year": "2015", "fuel_type": "ELECTRIC", "reg_valid_date": "01/05/2024"}] * 3,
        {"county": "KINGS", "model_year": "2016", "fuel_type": "ELECTRIC", "reg_valid_date": "1/5/2024"},
        {"county": "KINGS", "model_year": "2016", "fuel_type": "GAS", "reg_valid_date": "01/05/2024"},
        {"county": "KINGS", "model_year": "2016", "fuel_type": "ELECTRIC", "reg_valid_date": "12/31/2023"},
        {"county": "KINGS", "model_year": "UNK", "fuel_type": "ELECTRIC", "reg_valid_date": "01/05/2024"},
        {"county": " ", "model_year": "2015", "fuel_type": "ELECTRIC", "reg_valid_date": "01/05/2024"},
    )
    raw_stations = stations(
        spark,
        {"zip": "10001", "fuel_type_code": "ELEC", "open_date": "2014-12-31"},
        {"zip": "10001", "fuel_type_code": "ELEC", "open_date": "2016-01-01"},
        {"zip": "10002", "fuel_type_code": "ELEC", "open_date": "2016-02-01"},
        {"zip": "10002", "fuel_type_code": "ELEC", "open_date": "unknown"},
        {"zip": "55555", "fuel_type_code": "ELEC", "open_date": "2016-02-01"},
    )
    zips = census(spark)[2]
    new_evs = facts.registrations_by_county_year(regs, 2015, 2017, dt.date(2024, 1, 1))
    openings = facts.station_openings_by_county_year(raw_stations, zips)
    demand = facts.fact_market_demand(locations, new_evs, openings, 2015, 2017)
    assert demand.count() == locations.count() * 3
    got = demand.filter("location_key = 2").orderBy("date_key")
    assert tuples(
        got, "market_key", "date_key", "ev_registrations_cum", "new_ev_registrations",
        "station_count_cum", "new_stations", "ev_per_station", "population",
    ) == [
        (4, 20150101, 3, 3, 0, 0, None, 400),
        (5, 20160101, 4, 1, 2, 2, Decimal("2.00"), 400),
        (6, 20170101, 4, 0, 2, 0, Decimal("2.00"), 400),
    ]
    daily = dim_date(spark, "2015-01-01", "2017-12-31")
    assert quality.missing_references(demand, daily, "date_key").count() == 0
    growth = reports.regional_growth(demand, locations, daily, 2015, 2016)
    assert [tuple(r) for r in growth.collect()] == [
        ("NYC", 2015, 3, 0), ("NYC", 2016, 1, 2), ("Other NY", 2015, 0, 0), ("Other NY", 2016, 0, 0),
    ]
    top = reports.underserved_markets(demand, locations, daily, 2017, 1, 3).collect()
    assert [tuple(r) for r in top] == [
        ("KINGS", "NYC", 4, 2, Decimal("2.0"), Decimal("1750.75"), "$1,751")
    ]
    assert reports.underserved_markets(demand, locations, daily, 2017, 2, 3).count() == 0


# --- matched sessions -------------------------------------------------------------------


@pytest.fixture
def sessions(spark):
    return frame(
        spark, schemas.RAW_SESSIONS,
        {"session_id": "s1", "station_id": "10", "session_date": "2025-01-02", "kwh_delivered": "10.5",
         "duration_minutes": "60", "revenue_usd": "4.25"},
        {"session_id": "s2", "station_id": "10", "session_date": "1/2/2025", "kwh_delivered": "",
         "duration_minutes": "30", "revenue_usd": "1.00"},
        {"session_id": "s3", "station_id": "9", "session_date": "2025-01-02", "kwh_delivered": "0",
         "duration_minutes": "x", "revenue_usd": "2.00"},
        {"session_id": "s4", "station_id": "77", "session_date": "2025-01-02"},
        {"session_id": "s5", "station_id": None, "session_date": "2025-01-02"},
        {"session_id": "s6", "station_id": "10", "session_date": "bad"},
    )


def test_matched_sessions(spark, matched_stations, sessions):
    fact = facts.fact_session_matched(sessions, matched_stations)
    got = fact.orderBy("session_id")
    assert tuples(got, "session_id", "station_key", "date_key", "kwh_delivered", "revenue_per_kwh") == [
        ("s1", 2, 20250102, Decimal("10.500"), Decimal("0.405")),
        ("s2", 2, 20250102, None, None),
        ("s3", 1, 20250102, Decimal("0.000"), None),
    ]
    orphans = facts.orphan_sessions(sessions, matched_stations)
    assert sorted(r.session_id for r in orphans.collect()) == ["s4", "s5"]
    assert tuple(quality.reconcile(sessions, fact).first()) == (6, 3, 3)
    keyed = facts.with_identity_key(fact, "session_key")
    keys = [r.session_key for r in keyed.collect()]
    assert len(set(keys)) == 3 and None not in keys


def test_whole_number_reading(spark, matched_stations, sessions):
    fact = facts.fact_session_matched(sessions, matched_stations, scale=0)
    first = fact.filter("session_id = 's1'").first()
    assert (first.kwh_delivered, first.revenue_usd) == (Decimal("11.000"), Decimal("4.00"))


def test_repeated_station_ids_fan_out_and_are_found(spark, matched_stations, sessions):
    twice = matched_stations.union(matched_stations)
    assert facts.fact_session_matched(sessions, twice).count() == 6
    assert quality.duplicate_keys(twice, "station_id").count() == 2


def test_snapshot_and_tiers(spark, matched_stations, sessions):
    fact = facts.fact_session_matched(sessions, matched_stations)
    snapshot = facts.fact_station_daily_snapshot(fact, matched_stations)
    got = snapshot.orderBy("station_key").collect()
    assert [tuple(r) for r in got] == [
        (1, 20250102, None, 1, Decimal("0.000"), Decimal("2.00"), None, Decimal("2.00"), None),
        (2, 20250102, 2, 2, Decimal("10.500"), Decimal("5.25"), Decimal("45.00"), Decimal("2.63"),
         Decimal("3.13")),
    ]
    assert [tuple(r) for r in reports.utilization_tiers(snapshot).collect()] == [
        ("0-20% (low)", 1), ("80%+ (saturated)", 1),
    ]
    named = {r.utilization_tier for r in reports.utilization_tiers(snapshot, unknown="none").collect()}
    assert named == {"0-20% (low)", "none"}
    top = reports.top_stations_lifetime(snapshot, matched_stations)
    assert [tuple(r) for r in top.collect()] == [
        ("b", None, 1, 2, Decimal("5.25"), Decimal("3.130000")),
        ("a", None, 1, 1, Decimal("2.00"), None),
    ]


def test_average_prices_are_not_weighted(spark, matched_stations, sessions):
    extra = frame(
        spark, schemas.RAW_SESSIONS,
        {"session_id": "s7", "station_id": "10", "session_date": "2025-01-03", "kwh_delivered": "100",
         "duration_minutes": "60", "revenue_usd": "100"},
    )
    fact = facts.fact_session_matched(sessions.union(extra), matched_stations)
    rows = {r.ev_network: r for r in reports.revenue_by_network(fact, matched_stations).collect()}
    assert rows["Non-Networked"].avg_price_per_kwh == Decimal("0.702500")
    assert rows["Net"].avg_price_per_kwh is None
    assert rows["Non-Networked"].total_revenue == Decimal("105.25")


def test_station_reports(spark, matched_stations):
    assert [tuple(r) for r in reports.top_networks(matched_stations).collect()] == [
        ("Net", 1), ("Non-Networked", 1),
    ]
    assert tuple(reports.port_totals(matched_stations).first()) == (2, None, None, 2)
    locations = dimensions.dim_location_county(*census(spark))
    assert [tuple(r) for r in reports.county_ports(matched_stations, locations).collect()] == [("KINGS", 1, 2)]
    assert reports.largest_locations(locations).first().county_name == "KINGS"


def test_nothing_is_lost_in_reading(spark, matched_stations):
    rows = frame(
        spark, schemas.RAW_SESSIONS,
        {"session_id": "big", "station_id": "10", "session_date": "05-JAN-2025", "kwh_delivered": "12345678.5",
         "duration_minutes": "3000000000", "revenue_usd": "123456789.00"},
    )
    got = facts.fact_session_matched(rows, matched_stations).first()
    assert (got.kwh_delivered, got.revenue_usd) == (Decimal("12345678.500"), Decimal("123456789.00"))
    assert (got.duration_minutes, got.date_key) == (3_000_000_000, 20250105)
    assert got.revenue_per_kwh == Decimal("10.000")
    counts = quality.overflow_counts(rows, schemas.FACT_SESSION_MATCHED).first()
    assert (counts.kwh_delivered, counts.revenue_usd, counts.duration_minutes) == (1, 1, 0)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        schemas.conform(rows.select("kwh_delivered").select(F.col("kwh_delivered").cast("decimal(38,3)").alias("kwh_delivered")), schemas.typed(kwh_delivered=schemas.FACT_SESSION_MATCHED["kwh_delivered"].dataType)).collect()


def test_ratios_are_divided_before_they_are_multiplied(spark):
    q = spark.range(1).select(
        F.round(half_up_ratio(F.lit(Decimal("10.01")), F.lit(Decimal("24")), 8, 28) * 60, 2).alias("rate")
    )
    assert q.first().rate == Decimal("25.02")


def test_overflowing_values_are_counted(spark):
    fact = spark.createDataFrame([(Decimal("1234.5"),), (Decimal("1.5"),), (None,)], "revenue_per_kwh decimal(18,3)")
    assert quality.overflow_counts(fact, schemas.FACT_SESSION_MATCHED).first().revenue_per_kwh == 1


# --- bridged sessions -------------------------------------------------------------------


def test_bridged_sessions(spark, feed):
    station_dim = dimensions.dim_station_bridged(feed)
    regs = clean(spark, {"zip": "10001", "city": "Troy", "county": "A", "make": "m"})
    locations = dimensions.dim_location_zip_city(station_dim, regs)
    markets = dimensions.dim_ev_market(regs)
    days = dim_date(spark, "2025-01-01", "2025-12-31", weekend_as="int")
    day, late = dt.date(2025, 3, 1), dt.date(2026, 3, 1)
    typed = spark.createDataFrame(
        [
            (1, 2, day, Decimal("3.00"), 60, Decimal("1.00")),
            (2, 5, day, Decimal("0.00"), 0, Decimal("1.00")),
            (3, 3, late, Decimal("7.00"), 60, Decimal("2.00")),
            (4, 0, day, Decimal("7.00"), 60, Decimal("2.00")),
            (5, None, day, Decimal("7.00"), 60, Decimal("2.00")),
            (6, -2, None, Decimal("1.00"), 7, None),
        ],
        schemas.TYPED_SESSIONS,
    )
    fact = facts.fact_session_bridged(typed, station_dim, locations, markets, days)
    got = fact.orderBy("session_id")
    assert tuples(
        got, "session_id", "station_key", "date_key", "location_key", "market_key", "revenue_per_kwh",
        "avg_kw_rate",
    ) == [
        (1, 2, 20250301, 1, 1, Decimal("0.33"), Decimal("3.00")),
        (2, 2, 20250301, 1, 1, None, None),
        (3, 3, None, None, None, Decimal("0.29"), Decimal("7.00")),
        (6, 1, None, 2, None, None, Decimal("8.57")),
    ]
    fills = quality.fill_counts(fact, {"d": "date_key", "l": "location_key", "m": "market_key"}).first()
    assert tuple(fills) == (4, 2, 3, 2)
    top = reports.top_stations_revenue(fact, station_dim).collect()
    assert [(r.station_name, r.total_sessions, r.total_revenue) for r in top] == [
        ("y", 1, None), ("x", 2, Decimal("2.00")), ("z", 1, Decimal("2.00")),
    ]
    months = reports.monthly_revenue(fact, days).collect()
    assert [tuple(r) for r in months] == [(3, "Mar", 2, Decimal("2.00"), Decimal("1.00"))]


def test_markets_of_one_city_and_size_merge(spark):
    markets = spark.createDataFrame(
        [(1, "10001", "X", "K", 30), (2, "10002", "X", "K", 30), (3, "10003", "Y", "K", 99)],
        "market_key long, zip string, city string, county string, total_ev_registrations long",
    )
    station_dim = spark.createDataFrame(
        [(1, "10001"), (2, "10002"), (3, "10002"), (4, "99999"), (5, None)], "station_key long, zip string"
    )
    got = reports.evs_per_station(markets, station_dim).collect()
    assert [tuple(r) for r in got] == [("X", "K", 30, 3, Decimal("10.00"))]


def test_skewed_sessions_take_the_shuffled_form(spark, matched_stations, no_broadcast):
    n = F.col("id")
    many = spark.range(3000).select(
        n.cast("string").alias("session_id"),
        F.when(n % 3 == 0, "10").when(n % 7 == 0, "9").otherwise(n.cast("string")).alias("station_id"),
        F.lit("2025-01-02").alias("session_date"),
        F.lit("1").alias("kwh_delivered"),
        F.lit("1").alias("duration_minutes"),
        F.lit("1").alias("revenue_usd"),
    )
    fact = facts.fact_session_matched(many, matched_stations)
    orphans = facts.orphan_sessions(many, matched_stations)
    assert fact.count() + orphans.count() == 3000
    assert fact.filter("station_key = 2").count() == 1000 + many.filter("station_id = '10' AND session_id % 3 <> 0").count()
