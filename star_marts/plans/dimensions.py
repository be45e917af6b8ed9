"""Dimensions.

Two generations of location and station dimensions exist side by side, told apart by their
grain: county and (zip, city) locations, matched and bridged stations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts import schemas
from star_marts.functions import (
    five_digit_code,
    label_by_members,
    norm_text,
    not_blank,
    try_date,
    try_number,
    try_whole,
)
from star_marts.operators import (
    lookup_join,
    modal_lookup,
    profile_groups,
    weighted_mean,
    with_surrogate_key,
)
from star_marts.session import stage

_ZIP_LENGTH = 5


def zip_to_county(registrations: DataFrame, state: str | None = None) -> DataFrame:
    """Most frequent county per zip as delivered; `state` limits it, by default none does."""
    rows = registrations if state is None else registrations.filter(F.col("state") == state)
    known = rows.filter(F.col("zip").isNotNull() & not_blank("county"))
    return modal_lookup(known.select("zip", norm_text("county").alias("county")), "zip", "county")


def county_census(population: DataFrame, income: DataFrame, zips: DataFrame) -> DataFrame:
    """Population and population-weighted median income per county, from zip-level census.

    A zip without income adds its population but no weight.
    """
    people = population.select(
        "geo_id",
        five_digit_code("name").alias("zip"),
        try_number("population_estimate").alias("population"),
    ).filter(F.col("population").isNotNull())
    incomes = income.select("geo_id", try_number("median_income").alias("median_income"))
    per_zip = people.join(incomes, "geo_id", "left")
    mean = weighted_mean(F.col("median_income"), F.col("population"))
    return (
        lookup_join(per_zip, zips, "zip", "inner")
        .groupBy("county")
        .agg(
            F.sum("population").cast("bigint").alias("population"),
            F.round(mean, 2).cast("decimal(12,2)").alias("median_income"),
        )
    )


def dim_location_county(
    population: DataFrame, income: DataFrame, zips: DataFrame, *, state_code: str = "NY",
    regions: Mapping[str, Sequence[str]] = fixed.NY_REGIONS,
) -> DataFrame:
    """County locations; the state code is stamped on, and is not a filter."""
    rows = county_census(population, income, zips).select(
        F.col("county").alias("county_name"),
        F.lit(state_code).alias("state_code"),
        label_by_members("county", regions, fixed.OTHER_REGION).alias("region"),
        "population",
        "median_income",
    )
    return with_surrogate_key(rows, "location_key", ["county_name"])


def dim_station_matched(
    stations: DataFrame, zips: DataFrame, locations: DataFrame, fuel: str = "ELEC"
) -> DataFrame:
    """Stations of one fuel with county, location key, port total and active flag."""
    ports = {
        level: try_whole(column)
        for level, column in {
            "level1_count": "ev_level1_evse_num",
            "level2_count": "ev_level2_evse_num",
            "dc_fast_count": "ev_dc_fast_count",
        }.items()
    }
    zero = F.lit(0)
    # Both lookups hang on the zip: resolve zip -> county -> location before any station moves.
    counties = locations.select(F.col("county_name").alias("county"), "location_key")
    places = stage(
        zips.join(counties, "county", "left").select("zip", "county", "location_key"), "places"
    )
    kept = stations.filter((F.col("fuel_type_code") == fuel) & F.col("id").isNotNull()).select(
        F.col("id").alias("station_id"),
        "station_name",
        F.coalesce("ev_network", F.lit(fixed.NO_NETWORK)).alias("ev_network"),
        "city",
        "zip",
        *[count.alias(level) for level, count in ports.items()],
        sum((F.coalesce(count, zero) for count in ports.values()), zero).alias("total_port_count"),
        F.col("ev_connector_types").alias("connector_types"),
        "access_code",
        "facility_type",
        try_date("open_date").alias("open_date"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.when(F.col("status_code") == "E", True).otherwise(False).alias("is_active"),
    )
    placed = lookup_join(kept, places, "zip", "left")
    keyed = with_surrogate_key(
        placed, "station_key", [try_number("station_id"), "station_id", "station_name", "city", "zip"]
    )
    return keyed.select(*schemas.DIM_STATION_MATCHED.fieldNames())


def dim_station_bridged(feed: DataFrame) -> DataFrame:
    """Stations of the header-named feed, keyed in the order of their numeric id."""
    rows = feed.filter(F.col("ID").isNotNull()).select(
        F.col("ID").alias("_id"),
        try_whole("ID").alias("station_id"),
        F.col("STATIONNAME").alias("station_name"),
        F.col("EVNETWORK").alias("network"),
        F.trim("ZIP").alias("zip"),
        norm_text("CITY").alias("city"),
        norm_text("STATE").alias("state"),
        try_whole("EVLEVEL1EVSENUM").alias("level1_ports"),
        try_whole("EVLEVEL2EVSENUM").alias("level2_ports"),
        try_whole("EVDCFASTCOUNT").alias("dc_fast_ports"),
        try_number("LATITUDE", 10, 6).alias("latitude"),
        try_number("LONGITUDE", 10, 6).alias("longitude"),
        F.col("STATUSCODE").alias("status_code"),
        try_date("OPENDATE").alias("open_date"),
    )
    order = ["station_id", "_id", "station_name", "zip", "city"]
    return with_surrogate_key(rows, "station_key", order).drop("_id")


def _locations(stations: DataFrame, registrations: DataFrame) -> DataFrame:
    from_stations = stations.select(
        F.trim("zip").alias("zip"),
        norm_text("city").alias("city"),
        norm_text("state").alias("state"),
        F.lit(None).cast("string").alias("county"),
    )
    both = from_stations.unionByName(registrations.select("zip", "city", "state", "county"))
    return both.filter((F.length("zip") == _ZIP_LENGTH) & F.col("city").isNotNull())


def location_variants(stations: DataFrame, registrations: DataFrame) -> DataFrame:
    """Every distinct spelling of a location in either source; NULLs count as equal."""
    return _locations(stations, registrations).distinct()


def dim_location_zip_city(stations: DataFrame, registrations: DataFrame) -> DataFrame:
    """(zip, city) locations seen in either source.

    The largest state and county text wins.  A maximum ignores repeats, so the sources go
    straight into one aggregation and nothing is made distinct before.
    """
    merged = _locations(stations, registrations).groupBy("zip", "city").agg(
        F.max("state").alias("state"), F.max("county").alias("county")
    )
    return with_surrogate_key(merged, "location_key", ["zip", "city"])


def dim_ev_market(registrations: DataFrame) -> DataFrame:
    """Demand per zip: registrations, distinct makes, most frequent make, city and county."""
    known = registrations.filter(F.length("zip") == _ZIP_LENGTH)
    profile = profile_groups(known, "zip", modes=["make", "city", "county"], distinct=["make"])
    rows = profile.select(
        "zip",
        F.col("city_mode").alias("city"),
        F.col("county_mode").alias("county"),
        F.col("total").alias("total_ev_registrations"),
        F.col("make_distinct").alias("unique_makes"),
        F.col("make_mode").alias("most_common_make"),
    )
    return with_surrogate_key(rows, "market_key", ["zip"])
