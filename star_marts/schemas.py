"""Declared schemas of the raw landing tables and the marts.

Fixed values: names, order and types of the columns are those of the tables this library replaces,
but for whole numbers, which are 64-bit wherever they count or identify.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from star_marts import fixed_values as fixed


def strings(names: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def typed(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, to) for name, to in columns.items()])


STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DATE, BOOLEAN, DOUBLE = T.DateType(), T.BooleanType(), T.DoubleType()

RAW_STATIONS = strings(fixed.STATION_EXPORT_COLUMNS)
RAW_REGISTRATIONS = strings(fixed.REGISTRATION_EXPORT_COLUMNS)
RAW_REGISTRATIONS_POSITIONAL = strings(f"col{i}" for i in range(1, 21))
RAW_CENSUS_POPULATION = strings(fixed.CENSUS_POPULATION_COLUMNS)
RAW_CENSUS_INCOME = strings(fixed.CENSUS_INCOME_COLUMNS)
RAW_SESSIONS = strings(fixed.SESSION_COLUMNS)
RAW_STATION_FEED = strings(fixed.STATION_FEED_COLUMNS)

# The landing tables that are declared before anything is loaded.
RAW_TABLES = {
    "stations": RAW_STATIONS,
    "registrations": RAW_REGISTRATIONS,
    "census_population": RAW_CENSUS_POPULATION,
    "census_income": RAW_CENSUS_INCOME,
    "sessions": RAW_SESSIONS,
}

# Whole-number identifiers are 64-bit: the row counts this is built for pass 2^31.
TYPED_SESSIONS = typed(
    session_id=LONG,
    station_id=LONG,
    session_date=DATE,
    kwh_delivered=T.DecimalType(10, 2),
    duration_minutes=INT,
    revenue_usd=T.DecimalType(10, 2),
)

DIM_DATE_YEAR = typed(date_key=INT, year=INT, full_date=DATE)
DIM_DATE_DAY = typed(
    date_key=INT,
    full_date=DATE,
    year=INT,
    quarter=INT,
    month=INT,
    month_name=STRING,
    day=INT,
    day_of_week=INT,
    day_name=STRING,
    is_weekend=BOOLEAN,
)
DIM_LOCATION_COUNTY = typed(
    location_key=LONG,
    county_name=STRING,
    state_code=STRING,
    region=STRING,
    population=LONG,
    median_income=T.DecimalType(12, 2),
)
DIM_STATION_MATCHED = typed(
    station_key=LONG,
    station_id=STRING,
    station_name=STRING,
    ev_network=STRING,
    city=STRING,
    zip=STRING,
    county=STRING,
    location_key=LONG,
    level1_count=LONG,
    level2_count=LONG,
    dc_fast_count=LONG,
    total_port_count=LONG,
    connector_types=STRING,
    access_code=STRING,
    facility_type=STRING,
    open_date=DATE,
    latitude=DOUBLE,
    longitude=DOUBLE,
    is_active=BOOLEAN,
)
FACT_MARKET_DEMAND = typed(
    market_key=LONG,
    date_key=INT,
    location_key=LONG,
    ev_registrations_cum=LONG,
    new_ev_registrations=LONG,
    station_count_cum=LONG,
    new_stations=LONG,
    ev_per_station=T.DecimalType(10, 2),
    population=LONG,
    median_income=T.DecimalType(12, 2),
)
FACT_SESSION_MATCHED = typed(
    session_key=LONG,
    session_id=STRING,
    station_key=LONG,
    date_key=INT,
    location_key=LONG,
    kwh_delivered=T.DecimalType(10, 3),
    duration_minutes=LONG,
    revenue_usd=T.DecimalType(10, 2),
    revenue_per_kwh=T.DecimalType(6, 3),
    session_date=DATE,
)
FACT_STATION_DAILY = typed(
    snapshot_key=LONG,
    station_key=LONG,
    date_key=INT,
    location_key=LONG,
    total_sessions=LONG,
    total_kwh=T.DecimalType(12, 3),
    total_revenue=T.DecimalType(12, 2),
    avg_session_duration=T.DecimalType(8, 2),
    avg_revenue_per_session=T.DecimalType(8, 2),
    utilization_rate_pct=T.DecimalType(5, 2),
)
ZIP_TO_COUNTY = typed(zip=STRING, county=STRING)
REGISTRATIONS_CLEAN = typed(
    **{name: INT if name == "model_year" else STRING for name in fixed.CLEAN_REGISTRATION_COLUMNS}
)
DIM_DATE_BRIDGED = typed(**{f.name: f.dataType for f in DIM_DATE_DAY.fields} | {"is_weekend": INT})
DIM_STATION_BRIDGED = typed(
    station_key=LONG,
    station_id=LONG,
    station_name=STRING,
    network=STRING,
    zip=STRING,
    city=STRING,
    state=STRING,
    level1_ports=LONG,
    level2_ports=LONG,
    dc_fast_ports=LONG,
    latitude=T.DecimalType(10, 6),
    longitude=T.DecimalType(10, 6),
    status_code=STRING,
    open_date=DATE,
)
DIM_LOCATION_ZIP_CITY = typed(location_key=LONG, zip=STRING, city=STRING, state=STRING, county=STRING)
DIM_EV_MARKET = typed(
    market_key=LONG,
    zip=STRING,
    city=STRING,
    county=STRING,
    total_ev_registrations=LONG,
    unique_makes=LONG,
    most_common_make=STRING,
)
FACT_SESSION_BRIDGED = typed(
    session_id=LONG,
    station_key=LONG,
    date_key=INT,
    location_key=LONG,
    market_key=LONG,
    kwh_delivered=T.DecimalType(10, 2),
    duration_minutes=INT,
    revenue_usd=T.DecimalType(10, 2),
    revenue_per_kwh=T.DecimalType(18, 2),
    avg_kw_rate=T.DecimalType(18, 2),
)



def roomy(schema: T.StructType, *ratios: str) -> T.StructType:
    """A schema whose ratios have 18 digits: a ratio of two good values is no reason to fail."""
    wide = {n: T.DecimalType(18, schema[n].dataType.scale) for n in ratios}
    return T.StructType([T.StructField(f.name, wide.get(f.name, f.dataType)) for f in schema.fields])


# Every stored table by name.
MARTS = {
    "zip_to_county": ZIP_TO_COUNTY,
    "dim_date": DIM_DATE_DAY,
    "dim_date_bridged": DIM_DATE_BRIDGED,
    "dim_location_county": DIM_LOCATION_COUNTY,
    "dim_station_matched": DIM_STATION_MATCHED,
    "fact_market_demand": FACT_MARKET_DEMAND,
    "fact_session_matched": roomy(FACT_SESSION_MATCHED, "revenue_per_kwh"),
    "fact_station_daily_snapshot": roomy(
        FACT_STATION_DAILY, "avg_session_duration", "avg_revenue_per_session", "utilization_rate_pct"
    ),
    "registrations_clean": REGISTRATIONS_CLEAN,
    "dim_station_bridged": DIM_STATION_BRIDGED,
    "dim_location_zip_city": DIM_LOCATION_ZIP_CITY,
    "dim_ev_market": DIM_EV_MARKET,
    "fact_session_bridged": FACT_SESSION_BRIDGED,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema; columns the frame lacks become NULL.

    Names match regardless of case.  Casts are strict: a value that does not fit its
    declared type raises, see `quality.overflow_counts` for a check that does not.
    """
    have = {name.lower(): name for name in df.columns}
    return df.select(
        *[
            (F.col(f"`{have[f.name.lower()]}`") if f.name.lower() in have else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )
