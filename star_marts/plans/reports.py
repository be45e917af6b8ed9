"""Business reports on the marts.

Facts are rolled up by their foreign key before any dimension is joined, so that a station
with a third of all sessions reaches the join as one row.  Averages travel as sum and count.
Top-k reports break ties by name, so their rows are the same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts.functions import half_up_ratio, money_text, month_key, tier_label
from star_marts.operators import count_keys, key_bitmaps, merge_bitmaps, top_k


_MONTH = "month_key"  # what stored facts may be partitioned by


def _mean(total: str, count: str, scale: int) -> Column:
    return half_up_ratio(F.sum(total), F.sum(count), scale, operands="decimal(26,8)")


def _dated(facts: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    """Rows of the given days, with columns of the calendar.

    A fact that is stored by month is joined by month too, so that what the calendar is filtered
    to decides, while the query runs, which months are read.
    """
    days = dates.select("date_key", *columns)
    if _MONTH not in facts.columns:
        return facts.join(days, "date_key")
    return facts.join(days.withColumn(_MONTH, month_key("date_key")), ["date_key", _MONTH])


def _by_day(facts: DataFrame) -> list[str]:
    """What a roll-up to days keeps, so that it can be pruned by month."""
    return ["date_key", _MONTH] if _MONTH in facts.columns else ["date_key"]


# --- demand by county -------------------------------------------------------------------


def underserved_markets(
    demand: DataFrame, locations: DataFrame, dates: DataFrame, year: int = 2025,
    min_stations: int = 5, min_vehicles: int = 100, k: int = 10,
) -> DataFrame:
    """Counties with most vehicles per station, above both thresholds."""
    in_year = demand.drop("population", "median_income").filter(
        (F.col("station_count_cum") > min_stations)
        & (F.col("ev_registrations_cum") > min_vehicles)
    )
    in_year = _dated(in_year, dates.filter(F.col("year") == year))
    named = in_year.join(
        locations.select("location_key", "county_name", "region", "median_income"), "location_key"
    )
    top = top_k(named, "ev_per_station", k, "county_name")
    return top.select(
        "county_name",
        "region",
        "ev_registrations_cum",
        "station_count_cum",
        F.round("ev_per_station", 1).alias("ev_per_station"),
        "median_income",
        money_text("median_income").alias("median_income_text"),
    )


def regional_growth(
    demand: DataFrame, locations: DataFrame, dates: DataFrame, first: int = 2020, last: int = 2025
) -> DataFrame:
    """Vehicles and stations added per region and year."""
    added = demand.select(*_by_day(demand), "location_key", "new_ev_registrations", "new_stations")
    in_range = _dated(added, dates.filter(F.col("year").between(first, last)), "year")
    return (
        in_range.join(locations.select("location_key", "region"), "location_key")
        .groupBy("region", "year")
        .agg(
            F.sum("new_ev_registrations").alias("new_evs_added"),
            F.sum("new_stations").alias("new_stations_added"),
        )
        .orderBy("region", "year")
    )


# --- stations ---------------------------------------------------------------------------


def top_networks(stations: DataFrame, k: int = 10) -> DataFrame:
    counts = stations.groupBy("ev_network").agg(F.count("*").alias("station_count"))
    return top_k(counts, "station_count", k, "ev_network")


def port_totals(stations: DataFrame) -> DataFrame:
    return stations.agg(
        F.sum("level1_count").alias("total_level1"),
        F.sum("level2_count").alias("total_level2"),
        F.sum("dc_fast_count").alias("total_dc_fast"),
        F.sum("total_port_count").alias("total_ports"),
    )


def county_ports(stations: DataFrame, locations: DataFrame, k: int = 10) -> DataFrame:
    """Counties with most stations."""
    per_location = (
        stations.filter(F.col("location_key").isNotNull())
        .groupBy("location_key")
        .agg(F.count("*").alias("n"), F.sum("total_port_count").alias("ports"))
    )
    named = per_location.join(locations.select("location_key", "county_name"), "location_key")
    counts = named.groupBy("county_name").agg(
        F.sum("n").alias("station_count"), F.sum("ports").alias("total_ports")
    )
    return top_k(counts, "station_count", k, "county_name")


# --- matched sessions -------------------------------------------------------------------


def revenue_by_network(sessions: DataFrame, stations: DataFrame, k: int = 10) -> DataFrame:
    """Networks by revenue.  The average price is the plain mean of the sessions' prices."""
    per_station = sessions.groupBy("station_key").agg(
        F.count("*").alias("n"),
        F.sum("kwh_delivered").alias("kwh"),
        F.sum("revenue_usd").alias("revenue"),
        F.sum("revenue_per_kwh").alias("prices"),
        F.count("revenue_per_kwh").alias("priced"),
    )
    named = per_station.join(stations.select("station_key", "ev_network"), "station_key")
    networks = named.groupBy("ev_network").agg(
        F.sum("n").alias("session_count"),
        F.sum("kwh").alias("total_kwh"),
        F.sum("revenue").alias("total_revenue"),
        _mean("prices", "priced", 6).alias("avg_price_per_kwh"),
    )
    return top_k(networks, "total_revenue", k, "ev_network")


def utilization_tiers(
    snapshot: DataFrame, tiers: Sequence[tuple[int, str]] = tuple(fixed.UTILIZATION_TIERS),
    top: str = fixed.TOP_UTILIZATION_TIER, unknown: str | None = None,
) -> DataFrame:
    """Station days per utilisation tier, lowest tier first.

    Days without a known utilisation count in the top tier unless `unknown` labels them.
    """
    label = tier_label("utilization_rate_pct", tiers, top, unknown)
    return (
        snapshot.groupBy(label.alias("utilization_tier"))
        .agg(F.count("*").alias("snapshot_count"), F.min("utilization_rate_pct").alias("_low"))
        .orderBy(F.col("_low").asc_nulls_last())
        .drop("_low")
    )


def top_stations_lifetime(snapshot: DataFrame, stations: DataFrame, k: int = 10) -> DataFrame:
    """Stations by lifetime revenue.  Same-named stations of one city count as one."""
    per_station = snapshot.groupBy("station_key").agg(
        F.count("*").alias("days"),
        F.sum("total_sessions").alias("n"),
        F.sum("total_revenue").alias("revenue"),
        F.sum("utilization_rate_pct").alias("rates"),
        F.count("utilization_rate_pct").alias("rated"),
    )
    named = per_station.join(stations.select("station_key", "station_name", "city"), "station_key")
    merged = named.groupBy("station_name", "city").agg(
        F.sum("days").alias("active_days"),
        F.sum("n").alias("lifetime_sessions"),
        F.sum("revenue").alias("lifetime_revenue"),
        _mean("rates", "rated", 6).alias("avg_utilization"),
    )
    return top_k(merged, "lifetime_revenue", k, "station_name", "city")


# --- bridged sessions -------------------------------------------------------------------


def top_stations_revenue(sessions: DataFrame, stations: DataFrame, k: int = 10) -> DataFrame:
    per_station = sessions.groupBy("station_key").agg(
        F.count("*").alias("n"),
        F.sum("revenue_usd").alias("revenue"),
        F.sum("kwh_delivered").alias("kwh"),
    )
    named = per_station.join(
        stations.select("station_key", "station_name", "network", "city"), "station_key"
    )
    merged = named.groupBy("station_name", "network", "city").agg(
        F.sum("n").alias("total_sessions"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"),
        F.round(F.sum("kwh"), 2).alias("total_kwh"),
    )
    return top_k(merged, "total_revenue", k, "station_name", "network", "city")


def monthly_revenue(sessions: DataFrame, dates: DataFrame, year: int | None = None) -> DataFrame:
    """Sessions and revenue per calendar month, of all years or of one."""
    per_day = (
        sessions.filter(F.col("date_key").isNotNull())
        .groupBy(*_by_day(sessions))
        .agg(
            F.count("*").alias("n"),
            F.sum("revenue_usd").alias("revenue"),
            F.count("revenue_usd").alias("paid"),
        )
    )
    days = dates if year is None else dates.filter(F.col("year") == year)
    months = _dated(per_day, days, "month", "month_name")
    return (
        months.groupBy("month", "month_name")
        .agg(
            F.sum("n").alias("session_count"),
            F.round(F.sum("revenue"), 2).alias("monthly_revenue"),
            _mean("revenue", "paid", 2).alias("avg_session_revenue"),
        )
        .orderBy("month")
    )


def evs_per_station(markets: DataFrame, stations: DataFrame, k: int = 10) -> DataFrame:
    """Largest markets that have stations, with vehicles per station.

    Markets of one city, county and size merge.  A station counts once in a market, however many
    of its zips list it.
    """
    merged = market_stations(markets, stations)
    rated = merged.withColumn(
        "evs_per_station",
        half_up_ratio(
            F.col("total_ev_registrations").cast("decimal(18,0)"),
            F.col("station_count").cast("decimal(18,0)"),
            2,
        ),
    )
    return top_k(rated, "total_ev_registrations", k, "city", "county")


_MARKET = ["city", "county", "total_ev_registrations"]


def _station_bitmaps(markets: DataFrame, stations: DataFrame) -> DataFrame:
    listed = stations.filter(F.col("zip").isNotNull()).select("zip", "station_key")
    return key_bitmaps(listed.join(markets.select("zip", *_MARKET), "zip"), _MARKET, "station_key")


def market_stations(markets: DataFrame, stations: DataFrame) -> DataFrame:
    """city, county, total_ev_registrations and the distinct stations of each market that has some."""
    return count_keys(_station_bitmaps(markets, stations), _MARKET, "station_count")


def county_stations(markets: DataFrame, stations: DataFrame) -> DataFrame:
    """Distinct stations per county, merged from those of its markets."""
    merged = merge_bitmaps(_station_bitmaps(markets, stations), ["county"])
    return count_keys(merged, ["county"], "station_count").orderBy(F.col("county").asc_nulls_last())


def largest_locations(locations: DataFrame, k: int = 10) -> DataFrame:
    return top_k(locations, "population", k, "county_name")


def sample_rows(df: DataFrame, k: int = 5) -> DataFrame:
    """Any `k` rows, to look at."""
    return df.limit(k)


def calendar_listing(dates: DataFrame) -> DataFrame:
    return dates.orderBy("full_date")

