"""The raw layer: what the marts are built from."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from star_marts import schemas
from star_marts.sources import Layers, land, read_by_header


@dataclass(frozen=True)
class RawLayer:
    """Landing tables.  All are text except `typed_sessions`."""

    stations: DataFrame
    station_feed: DataFrame
    registrations: DataFrame
    registrations_positional: DataFrame
    census_population: DataFrame
    census_income: DataFrame
    sessions: DataFrame
    typed_sessions: DataFrame


@dataclass(frozen=True)
class CsvSources:
    """Paths of the source files; each may be a file, a folder or a list of them."""

    stations: str | list[str]
    station_feed: str | list[str]
    registrations: str | list[str]
    census_population: str | list[str]
    census_income: str | list[str]
    sessions: str | list[str]


def read_csv_sources(
    spark: SparkSession, sources: CsvSources, multiline: bool = False
) -> tuple[RawLayer, dict[str, DataFrame]]:
    """The raw layer of a set of CSV files, and per table the rows that were skipped.

    Files read by position are parsed here, once each; what comes back are reads of what that left.
    """
    by_position = {
        "stations": schemas.RAW_STATIONS,
        "registrations": schemas.RAW_REGISTRATIONS,
        "census_population": schemas.RAW_CENSUS_POPULATION,
        "census_income": schemas.RAW_CENSUS_INCOME,
        "sessions": schemas.RAW_SESSIONS,
    }
    landed = {
        name: land(
            spark, getattr(sources, name), schema, multiline=multiline,
            typed=schemas.TYPED_SESSIONS if name == "sessions" else None,
        )
        for name, schema in by_position.items()
    }
    good = {name: landing.text for name, landing in landed.items()}
    raw = RawLayer(
        **good,
        station_feed=read_by_header(
            spark, sources.station_feed, schemas.RAW_STATION_FEED, multiline=multiline
        ),
        registrations_positional=good["registrations"].toDF(
            *schemas.RAW_REGISTRATIONS_POSITIONAL.fieldNames()
        ),
        typed_sessions=landed["sessions"].typed,
    )
    rejected = {name: landing.malformed for name, landing in landed.items()}
    return raw, {**rejected, "typed_sessions": landed["sessions"].mistyped}


def store_raw(raw: RawLayer, layers: Layers) -> RawLayer:
    """Write the landing tables to the raw layer once, and go on from there."""
    return RawLayer(
        **{
            f.name: layers.replace(getattr(raw, f.name), f"raw.{f.name}") for f in fields(RawLayer)
        }
    )
