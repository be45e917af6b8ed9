"""Times the queries and prints one JSON line.

`queries` are derived from the raw tables each time, dimensions and keys included.
`stored` are the same reports on marts that were written once, as a dashboard would run them;
`rebuild` is the writing of the landing tables and of all marts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import QUERIES, _layers  # noqa: E402
from star_marts import Marts, local_session, store_raw  # noqa: E402
from star_marts.plans import quality, reports  # noqa: E402
from star_marts.sample_layer import SAMPLE_SETTINGS, SampleLayer  # noqa: E402
from star_marts.session import drop_scratch  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "revenue_by_network", "clean_registrations", "zip_to_county", "calendar_day",
    "census_weighted_income", "dim_location_county", "dim_location_zip_city",
    "dim_station_matched", "dim_station_bridged", "dim_ev_market", "surrogate_keys",
    "identity_keys", "new_registrations_by_county_year", "station_openings_by_county_year",
    "market_demand", "underserved_markets", "regional_growth", "session_fact_matched",
    "session_fact_bridged", "orphan_sessions", "load_reconciliation", "station_daily_snapshot",
    "utilization_tiers", "top_stations_lifetime", "top_networks", "county_ports",
    "top_stations_revenue", "monthly_revenue", "evs_per_station", "row_counts",
    "duplicate_keys", "fk_fill_rates", "csv_sessions_loaded", "csv_sessions_rejected",
]


def seconds(build: Callable[[], DataFrame]) -> float:
    """Time to compute every row of a result, without bringing it to the driver."""
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(
        CPUS, "star-marts-bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(lambda: QUERIES["revenue_by_network"](spark, SF_DIR))  # warm-up, not reported
    times = {}
    for name in HEADLINE:
        times[name] = seconds(lambda name=name: QUERIES[name](spark, SF_DIR))
        drop_scratch(spark)

    layers = _layers(spark)
    start = time.perf_counter()
    marts = Marts(spark, store_raw(SampleLayer(spark, SF_DIR), layers), SAMPLE_SETTINGS, layers)
    marts.build()
    rebuild = round(time.perf_counter() - start, 3)
    on_stored = {
        "revenue_by_network": lambda: reports.revenue_by_network(
            marts.fact_session_matched, marts.dim_station_matched),
        "utilization_tiers": lambda: reports.utilization_tiers(marts.fact_station_daily_snapshot),
        "top_stations_lifetime": lambda: reports.top_stations_lifetime(
            marts.fact_station_daily_snapshot, marts.dim_station_matched),
        "top_stations_revenue": lambda: reports.top_stations_revenue(
            marts.fact_session_bridged, marts.dim_station_bridged),
        "monthly_revenue": lambda: reports.monthly_revenue(
            marts.fact_session_bridged, marts.dim_date_bridged),
        "evs_per_station": lambda: reports.evs_per_station(
            marts.dim_ev_market, marts.dim_station_bridged),
        "underserved_markets": lambda: reports.underserved_markets(
            marts.fact_market_demand, marts.dim_location_county, marts.dim_date, 2000),
        "regional_growth": lambda: reports.regional_growth(
            marts.fact_market_demand, marts.dim_location_county, marts.dim_date, 1997, 2000),
        "fk_fill_rates": lambda: quality.fill_counts(
            marts.fact_session_bridged, {"has_date": "date_key", "has_market": "market_key"}),
    }
    stored = {name: seconds(build) for name, build in on_stored.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stored": stored,
                "rebuild": rebuild,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
