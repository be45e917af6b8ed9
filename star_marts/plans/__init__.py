"""The marts: staging, dimensions, facts, quality checks and reports."""

from star_marts.plans.marts import Marts, Settings
from star_marts.plans.raw import CsvSources, RawLayer, read_csv_sources, store_raw

__all__ = ["CsvSources", "Marts", "RawLayer", "Settings", "read_csv_sources", "store_raw"]
