"""From CSV files to reports, through stored layers."""

import uuid

import pytest
from pyspark.sql import functions as F

from star_marts import CsvSources, Layers, Marts, Settings, fixed_values as fixed, read_csv_sources, schemas, store_raw
from star_marts.plans import quality, reports


def csv(path, names, records):
    lines = [",".join(names)]
    lines += [",".join(f'"{r[n]}"' if n in r else "" for n in names) for r in records]
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def sources(tmp_path):
    station = {"fuel_type_code": "ELEC", "status_code": "E", "city": "Troy", "open_date": "2020-01-01"}
    stations = [
        {**station, "id": "1", "station_name": "North, Main", "zip": "12180", "ev_level2_evse_num": "2"},
        {**station, "id": "2", "station_name": "South", "zip": "12181", "ev_network": "Net"},
        {**station, "id": "3", "station_name": "Gas", "zip": "12180", "fuel_type_code": "LPG"},
    ]
    registration = {
        "state": "NY", "county": "Rensselaer", "city": "troy", "make": "a", "model_year": "2020",
        "fuel_type": "ELECTRIC", "reg_valid_date": "02/01/2024",
    }
    registrations = [{**registration, "vin": str(n), "zip": "12180"} for n in range(4)]
    registrations.append({**registration, "vin": "5", "zip": "12181-77", "make": "b"})
    feed = tmp_path / "feed.csv"
    feed.write_text(
        "City,ID,Station Name,ZIP,State,EV Network\n"
        "troy,2,South,12181,NY,Net\ntroy,1,North,12180,NY,NULL\ntroy,3,Gas,12180,NY\n"
    )
    sessions = tmp_path / "sessions.csv"
    sessions.write_text(
        ",".join(fixed.SESSION_COLUMNS) + "\n"
        "1,1,2025-01-01,10,60,5.00\n2,1,2025-01-01,20,120,7.00\n3,2,2025-02-01,5,10,1.00\n"
        "4,9,2025-02-01,5,10,1.00\n5,1,never,5,10,1.00\n6,1,2025-02-01\n"
    )
    return CsvSources(
        stations=csv(tmp_path / "stations.csv", fixed.STATION_EXPORT_COLUMNS, stations),
        station_feed=str(feed),
        registrations=csv(tmp_path / "regs.csv", fixed.REGISTRATION_EXPORT_COLUMNS, registrations),
        census_population=csv(
            tmp_path / "pop.csv", fixed.CENSUS_POPULATION_COLUMNS,
            [{"geo_id": "g", "name": "ZCTA5 12180", "population_estimate": "1000"}],
        ),
        census_income=csv(
            tmp_path / "income.csv", fixed.CENSUS_INCOME_COLUMNS,
            [{"geo_id": "g", "name": "ZCTA5 12180", "median_income": "50000"}],
        ),
        sessions=str(sessions),
    )


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path / "warehouse"), prefix=f"e{uuid.uuid4().hex[:8]}_").create()


def test_reset_declares_empty_tables(layers):
    counts = quality.row_counts(layers.reset_raw(), "tbl").collect()
    assert {r.tbl: r.row_count for r in counts} == dict.fromkeys(schemas.RAW_TABLES, 0)


def test_from_csv_to_reports(spark, sources, layers):
    raw, rejected = read_csv_sources(spark, sources)
    assert {name: df.count() for name, df in rejected.items() if df.count()} == {
        "sessions": 1, "typed_sessions": 1,
    }
    marts = Marts(spark, store_raw(raw, layers), Settings(), layers)
    counts = {name: df.count() for name, df in marts.build().items()}
    assert counts == {
        "zip_to_county": 2, "dim_date": 4748, "dim_date_bridged": 365, "dim_location_county": 1,
        "dim_station_matched": 2, "fact_market_demand": 12, "fact_session_matched": 3,
        "fact_station_daily_snapshot": 2, "registrations_clean": 5, "dim_station_bridged": 3,
        "dim_location_zip_city": 2, "dim_ev_market": 2, "fact_session_bridged": 4,
    }
    keys = {r.session_key for r in layers.read("marts.fact_session_matched").collect()}
    assert len(keys) == 3 and None not in keys
    for name, schema in schemas.MARTS.items():
        layer = "staging" if name == "registrations_clean" else "marts"
        stored = layers.read(f"{layer}.{name}").schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in schema], name
    assert layers.read("staging.registrations_clean").count() == 5

    top = reports.revenue_by_network(marts.fact_session_matched, marts.dim_station_matched).collect()
    assert [(r.ev_network, r.session_count) for r in top] == [("Non-Networked", 2), ("Net", 1)]
    demand = marts.fact_market_demand.filter("date_key = 20250101").first()
    assert (demand.ev_registrations_cum, demand.station_count_cum) == (5, 1)
    months = reports.monthly_revenue(marts.fact_session_bridged, marts.dim_date_bridged).collect()
    assert [(r.month, r.session_count) for r in months] == [(1, 2), (2, 2)]
    stars = reports.evs_per_station(marts.dim_ev_market, marts.dim_station_bridged).collect()
    assert [(r.city, r.total_ev_registrations, r.station_count) for r in stars] == [("TROY", 4, 2), ("TROY", 1, 1)]
    fills = quality.fill_counts(marts.fact_session_bridged, {"m": "market_key", "l": "location_key"}).first()
    assert tuple(fills) == (4, 4, 4)


def test_lazy_and_stored_marts_agree(spark, sources, layers):
    raw, _ = read_csv_sources(spark, sources)
    lazy, stored = Marts(spark, raw), Marts(spark, store_raw(raw, layers), layers=layers)
    for name in Marts.TABLES:
        left, right = getattr(lazy, name), getattr(stored, name)
        shared = [c for c in left.columns]
        assert sorted(map(str, left.collect())) == sorted(map(str, right.select(*shared).collect())), name


def test_stored_facts_by_month(spark, sources, layers):
    raw, _ = read_csv_sources(spark, sources)
    marts = Marts(spark, raw, Settings(facts_by_month=True), layers)
    for fact in (marts.fact_session_matched, marts.fact_station_daily_snapshot, marts.fact_session_bridged):
        january = fact.filter(F.col("month_key") == 202501)
        plan = january._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month_key" in plan
        assert january.count() == fact.filter("date_key between 20250101 and 20250131").count() > 0
