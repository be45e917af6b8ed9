"""Dimensional marts on Spark: landing, cleaning, dimensions, facts, checks and reports."""

from star_marts.plans import CsvSources, Marts, RawLayer, Settings, read_csv_sources, store_raw
from star_marts.session import local_session
from star_marts.sources import Layers

__all__ = [
    "CsvSources", "Layers", "Marts", "RawLayer", "Settings", "local_session", "read_csv_sources",
    "store_raw",
]
