"""Facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from star_marts.functions import (
    date_key,
    half_up_ratio,
    norm_text,
    try_date,
    try_number,
    try_us_date,
    try_whole,
)
from star_marts.operators import (
    densify,
    lookup_join,
    lookup_star,
    modulo_bridge_key,
)
from star_marts.operators.once import computed_once
from star_marts.session import stage

_MINUTES_PER_DAY = 24 * 60
_WIDE = "decimal(26,8)"  # what measures of 38 digits, and sums, are divided as


def registrations_by_county_year(
    registrations: DataFrame, first: int, last: int, since: dt.date, fuel: str = "ELECTRIC"
) -> DataFrame:
    """Currently valid registrations per county and model year: county, year, n."""
    kept = registrations.filter(
        (F.col("fuel_type") == fuel)
        & F.col("county").isNotNull()
        & (try_us_date("reg_valid_date") >= F.lit(since))
    ).select(
        norm_text("county").alias("county"),
        try_whole("model_year", "int").alias("year"),  # of another year than four digits none is kept
    )
    in_range = kept.filter(F.col("year").between(first, last))
    return in_range.groupBy("county", "year").agg(F.count("*").alias("n"))


def station_openings_by_county_year(
    stations: DataFrame, zips: DataFrame, fuel: str = "ELEC"
) -> DataFrame:
    """Stations per county and opening year: county, year, n.

    Counted per zip before the county lookup, so a zip with many stations moves as one row.
    """
    opened = (
        stations.filter(F.col("fuel_type_code") == fuel)
        .select("zip", F.year(try_date("open_date")).alias("year"))
        .filter(F.col("year").isNotNull())
        .groupBy("zip", "year")
        .agg(F.count("*").alias("n"))
    )
    return opened.join(zips, "zip").groupBy("county", "year").agg(F.sum("n").alias("n"))


def fact_market_demand(
    locations: DataFrame, new_registrations: DataFrame, new_stations: DataFrame,
    first: int, last: int,
) -> DataFrame:
    """County by year: new and cumulative vehicles and stations, vehicles per station.

    The grid has every year of every location, so its key is arithmetic on the dense
    location key; no rows are ordered to find it.
    """
    series = densify(
        locations.select(
            "location_key", F.upper("county_name").alias("county"), "population", "median_income"
        ),
        "county", "year", first, last,
        {"evs": new_registrations, "stations": new_stations},
    )
    per_location = last - first + 1
    return series.select(
        ((F.col("location_key") - 1) * per_location + F.col("year") - first + 1).alias("market_key"),
        (F.col("year") * 10000 + 101).alias("date_key"),
        "location_key",
        F.col("evs_cum").alias("ev_registrations_cum"),
        F.col("evs").alias("new_ev_registrations"),
        F.col("stations_cum").alias("station_count_cum"),
        F.col("stations").alias("new_stations"),
        half_up_ratio(
            F.col("evs_cum").cast("decimal(18,0)"), F.col("stations_cum").cast("decimal(18,0)"), 2
        ).alias("ev_per_station"),
        "population",
        "median_income",
    )


def fact_session_matched(
    sessions: DataFrame, stations: DataFrame, *, scale: int | None = None
) -> DataFrame:
    """Sessions whose station id is known and whose date is one, at session grain.

    Measures are read at the scale of their columns and at all 38 digits; `scale=0` reads them as
    whole numbers.  What exceeds a declared type is counted by `quality.overflow_counts` and is
    an error where the fact is stored.
    """
    kwh = try_number("kwh_delivered", 38, 3 if scale is None else scale).cast("decimal(38,3)")
    revenue = try_number("revenue_usd", 38, 2 if scale is None else scale).cast("decimal(38,2)")
    text = sessions.select("session_id", "station_id", "session_date", "kwh_delivered", "duration_minutes", "revenue_usd")
    dated = computed_once(text, "_day", try_date("session_date")).filter(F.col("_day").isNotNull())
    keys = stations.select("station_id", "station_key", "location_key")
    # Text travels through the join: a number of 38 digits is wider, and dear to parse for nothing.
    found = lookup_join(dated, keys, "station_id", "inner")
    numbers = F.struct(kwh.alias("kwh_delivered"), revenue.alias("revenue_usd"))
    matched = computed_once(found, "_n", numbers).select(
        "session_id", "station_key", "location_key", "_n.*", F.col("_day").alias("session_date"),
        try_whole("duration_minutes").alias("duration_minutes"),
    )
    return matched.select(
        "session_id",
        "station_key",
        date_key("session_date").alias("date_key"),
        "location_key",
        "kwh_delivered",
        "duration_minutes",
        "revenue_usd",
        F.when(
            F.col("kwh_delivered") > 0,
            half_up_ratio(F.col("revenue_usd"), F.col("kwh_delivered"), 3, operands=_WIDE),
        ).alias("revenue_per_kwh"),
        "session_date",
    )


def with_identity_key(fact: DataFrame, name: str) -> DataFrame:
    """Unique 64-bit identity key for a fact, made in the one write of it.

    Numbers grow with the write task and the row in it: they have gaps, and are not the same
    from one rebuild to the next.  Nothing joins on them.
    """
    return fact.select((F.monotonically_increasing_id() + 1).alias(name), *fact.columns)


def orphan_sessions(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Sessions that point at no station."""
    return lookup_join(sessions, stations.select("station_id"), "station_id", "left_anti")


def bridge_sessions(sessions: DataFrame, stations: DataFrame, dates: DataFrame) -> DataFrame:
    """Typed sessions with the station key that they wrap around to and their date key.

    The station keys are dense, so a wrapped key has a station unless it is below one; those
    sessions are dropped.  What reports by station or month need, without any other lookup.
    """
    bridged = sessions.withColumn("station_key", modulo_bridge_key(F.col("station_id"), stations))
    days = dates.select(F.col("full_date").alias("session_date"), "date_key")
    return bridged.filter(F.col("station_key") >= 1).join(days, "session_date", "left").select(
        "session_id", "station_key", "date_key", "kwh_delivered", "duration_minutes", "revenue_usd"
    )


def fact_session_bridged(
    sessions: DataFrame, stations: DataFrame, locations: DataFrame, markets: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Typed sessions bridged to stations, with date, location, market and rates.

    Location and market follow from the station, so they are looked up once per station;
    each session then meets one station row.
    """
    placed = stage(
        lookup_star(
            stations.select("station_key", "zip", "city"),
            [(locations, ["zip", "city"], ["location_key"]), (markets, "zip", ["market_key"])],
        ).select("station_key", "location_key", "market_key"),
        "placed",
    )
    minutes = F.col("duration_minutes").cast("decimal(10,0)")
    bridged = bridge_sessions(sessions, stations, dates)
    return lookup_join(bridged, placed, "station_key", "left").select(
        "session_id",
        "station_key",
        "date_key",
        "location_key",
        "market_key",
        "kwh_delivered",
        "duration_minutes",
        "revenue_usd",
        half_up_ratio(F.col("revenue_usd"), F.col("kwh_delivered"), 2).alias("revenue_per_kwh"),
        # Divided first, to six decimals more than the measure has, and then multiplied.
        F.round(half_up_ratio(F.col("kwh_delivered"), minutes, 8, 28) * 60, 2).alias("avg_kw_rate"),
    )


def fact_station_daily_snapshot(sessions: DataFrame, stations: DataFrame) -> DataFrame:
    """Active station days: sessions, energy, revenue, averages and utilisation.

    Utilisation is session minutes over port minutes of a day, NULL for a station without
    ports.  Sessions are rolled up before the ports are looked up.
    """
    days = sessions.groupBy("station_key", "date_key", "location_key").agg(
        F.count("*").alias("total_sessions"),
        F.sum("kwh_delivered").alias("total_kwh"),
        F.sum("revenue_usd").alias("total_revenue"),
        F.sum("duration_minutes").alias("_minutes"),
        F.count("duration_minutes").alias("_timed"),
        F.count("revenue_usd").alias("_paid"),
    )
    ports = stations.select("station_key", "total_port_count")
    minutes = F.col("_minutes").cast("decimal(19,0)")
    capacity = (F.col("total_port_count") * _MINUTES_PER_DAY).cast("decimal(18,0)")
    return days.join(ports, "station_key").select(
        "station_key",
        "date_key",
        "location_key",
        "total_sessions",
        "total_kwh",
        "total_revenue",
        half_up_ratio(minutes, F.col("_timed").cast("decimal(18,0)"), 2).alias("avg_session_duration"),
        half_up_ratio(F.col("total_revenue"), F.col("_paid"), 2, operands=_WIDE).alias(
            "avg_revenue_per_session"
        ),
        F.when(
            F.col("total_port_count") > 0, F.round(half_up_ratio(minutes, capacity, 6, 28) * 100, 2)
        ).alias("utilization_rate_pct"),
    )
