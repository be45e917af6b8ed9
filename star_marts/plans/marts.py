"""Both generations of the marts as lazily built tables over one raw layer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from star_marts import fixed_values as fixed
from star_marts import schemas
from star_marts.functions import dim_date, month_key
from star_marts.plans import dimensions, facts, staging
from star_marts.plans.raw import RawLayer
from star_marts.session import stage
from star_marts.sources import Layers

BUCKET_ROWS = 1 << 19  # rows that a bucket has on average, at most


@dataclass(frozen=True)
class Settings:
    """Date ranges, state, thresholds and region lists of a build.

    `state` selects registrations for the (zip, city) tables.  The county tables only stamp it
    on, unless `county_state` limits the registrations that map zips to counties.
    `facts_by_month` partitions stored facts by a `month_key` (yyyymm); reports read only the months
    that their calendar rows fall in.  `station_buckets` stores session facts, snapshots and matched
    stations by at least that many buckets of the station key, so that roll-ups and joins by station
    move no fact row; a bucket is one task's, so the number doubles until it has `BUCKET_ROWS` or
    fewer on average.  A fact in which one station has too many rows for a bucket is stored plainly.
    """

    calendar_first: dt.date = dt.date(2014, 1, 1)
    calendar_last: dt.date = dt.date(2026, 12, 31)
    bridged_first: dt.date = dt.date(2025, 1, 1)
    bridged_last: dt.date = dt.date(2025, 12, 31)
    demand_first: int = 2015
    demand_last: int = 2026
    registered_since: dt.date = dt.date(2024, 1, 1)
    state: str = "NY"
    county_state: str | None = None
    facts_by_month: bool = False
    station_buckets: int | None = None
    regions: Mapping[str, Sequence[str]] = field(default_factory=lambda: fixed.NY_REGIONS)


class Marts:
    """Tables by name; asking for one builds what it depends on.

    With `layers` every table is written once, with its declared schema, and read back from
    there.  Without, dimensions and cleaned registrations are staged, and facts stay plans.
    """

    TABLES = (
        "zip_to_county", "dim_date", "dim_date_bridged", "dim_location_county",
        "dim_station_matched", "fact_market_demand", "fact_session_matched",
        "fact_station_daily_snapshot", "registrations_clean", "dim_station_bridged",
        "dim_location_zip_city", "dim_ev_market", "fact_session_bridged",
    )

    def __init__(
        self, spark: SparkSession, raw: RawLayer, settings: Settings | None = None,
        layers: Layers | None = None,
    ):
        self.spark = spark
        self.raw = raw
        self.settings = settings or Settings()
        self.layers = layers

    def build(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in self.TABLES}

    def _keep(self, name: str, df: DataFrame, layer: str = "marts") -> DataFrame:
        """Write a table once.  Without layers it is staged, so that joins know its true size."""
        if self.layers is None:
            return stage(df, name)
        return self.layers.replace(df, f"{layer}.{name}", schemas.MARTS.get(name))

    def _dimension(self, name: str, df: DataFrame) -> DataFrame:
        """A station dimension, stored in the buckets of its facts."""
        if self.layers is None or self.settings.station_buckets is None:
            return self._keep(name, df)
        return self.layers.replace(
            df, f"marts.{name}", schemas.MARTS.get(name), bucket_by=("station_key", self.station_buckets)
        )

    def _enough_buckets(self, rows: int) -> int:
        buckets = self.settings.station_buckets
        while rows > buckets * BUCKET_ROWS:
            buckets *= 2
        return buckets

    @cached_property
    def station_buckets(self) -> int:
        """Buckets for the sessions or stations of the raw layer, whichever are more: one number for
        all tables that fits, so that they meet without a shuffle."""
        raw = self.raw
        return self._enough_buckets(max(t.count() for t in (raw.sessions, raw.stations, raw.station_feed)))

    def _fact(self, name: str, df: DataFrame, key: str | None = None) -> DataFrame:
        """Only stored facts have an identity key: nothing joins on it."""
        if self.layers is None:
            return df
        rows = df if key is None else facts.with_identity_key(df, key)
        schema = schemas.MARTS.get(name)
        by_month = self.settings.facts_by_month and "date_key" in df.columns
        if by_month:
            typed = rows if schema is None else schemas.conform(rows, schema)
            rows, schema = typed.withColumn("month_key", month_key("date_key")), None
        buckets = self._buckets(df)
        return self.layers.replace(
            rows, f"marts.{name}", schema, ["month_key"] if by_month else (), buckets
        )

    def _buckets(self, fact: DataFrame) -> tuple[str, int] | None:
        """By station, unless one station alone has more than two buckets' fair share of the rows."""
        if self.settings.station_buckets is None or "station_key" not in fact.columns:
            return None
        per_station = fact.groupBy("station_key").agg(F.count("*").alias("n"))
        total, most = per_station.agg(F.sum("n"), F.max("n")).first()
        buckets = max(self.station_buckets, self._enough_buckets(total or 0))
        return None if total and most * buckets > 2 * total else ("station_key", buckets)

    # --- county generation --------------------------------------------------------------

    @cached_property
    def zip_to_county(self) -> DataFrame:
        df = dimensions.zip_to_county(self.raw.registrations, self.settings.county_state)
        return self._keep("zip_to_county", df)

    @cached_property
    def dim_date(self) -> DataFrame:
        s = self.settings
        return self._keep("dim_date", dim_date(self.spark, s.calendar_first, s.calendar_last))

    @cached_property
    def dim_location_county(self) -> DataFrame:
        df = dimensions.dim_location_county(
            self.raw.census_population, self.raw.census_income, self.zip_to_county,
            state_code=self.settings.state, regions=self.settings.regions,
        )
        return self._keep("dim_location_county", df)

    @cached_property
    def dim_station_matched(self) -> DataFrame:
        df = dimensions.dim_station_matched(
            self.raw.stations, self.zip_to_county, self.dim_location_county
        )
        return self._dimension("dim_station_matched", df)

    @property
    def new_registrations(self) -> DataFrame:
        s = self.settings
        return facts.registrations_by_county_year(
            self.raw.registrations, s.demand_first, s.demand_last, s.registered_since
        )

    @property
    def new_stations(self) -> DataFrame:
        return facts.station_openings_by_county_year(self.raw.stations, self.zip_to_county)

    @cached_property
    def fact_market_demand(self) -> DataFrame:
        s = self.settings
        df = facts.fact_market_demand(
            self.dim_location_county, self.new_registrations, self.new_stations,
            s.demand_first, s.demand_last,
        )
        if self.layers is None:
            return self._keep("fact_market_demand", df)
        return self._fact("fact_market_demand", df)

    @cached_property
    def fact_session_matched(self) -> DataFrame:
        df = facts.fact_session_matched(self.raw.sessions, self.dim_station_matched)
        return self._fact("fact_session_matched", df, "session_key")

    @cached_property
    def fact_station_daily_snapshot(self) -> DataFrame:
        df = facts.fact_station_daily_snapshot(self.fact_session_matched, self.dim_station_matched)
        return self._fact("fact_station_daily_snapshot", df, "snapshot_key")

    # --- zip and city generation --------------------------------------------------------

    @cached_property
    def registrations_clean(self) -> DataFrame:
        df = staging.clean_registrations(self.raw.registrations_positional, self.settings.state)
        return self._keep("registrations_clean", df, "staging")

    @cached_property
    def dim_date_bridged(self) -> DataFrame:
        s = self.settings
        df = dim_date(self.spark, s.bridged_first, s.bridged_last, weekend_as="int")
        return self._keep("dim_date_bridged", df)

    @cached_property
    def dim_station_bridged(self) -> DataFrame:
        return self._dimension(
            "dim_station_bridged", dimensions.dim_station_bridged(self.raw.station_feed)
        )

    @cached_property
    def dim_location_zip_city(self) -> DataFrame:
        df = dimensions.dim_location_zip_city(self.dim_station_bridged, self.registrations_clean)
        return self._keep("dim_location_zip_city", df)

    @cached_property
    def dim_ev_market(self) -> DataFrame:
        return self._keep("dim_ev_market", dimensions.dim_ev_market(self.registrations_clean))

    @property
    def bridged_sessions(self) -> DataFrame:
        """Keys and measures of the bridged fact, as a plan, without its lookups."""
        return facts.bridge_sessions(
            self.raw.typed_sessions, self.dim_station_bridged, self.dim_date_bridged
        )

    @cached_property
    def fact_session_bridged(self) -> DataFrame:
        df = facts.fact_session_bridged(
            self.raw.typed_sessions, self.dim_station_bridged, self.dim_location_zip_city,
            self.dim_ev_market, self.dim_date_bridged,
        )
        return self._fact("fact_session_bridged", df)
