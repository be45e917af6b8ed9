"""CSV landing and layered tables."""

from star_marts.sources.landing import (
    Landed,
    Landing,
    apply_types,
    land,
    read_by_header,
    read_positional,
    read_typed,
)
from star_marts.sources.layers import Layers

__all__ = [
    "Landed", "Landing", "Layers", "apply_types", "land", "read_by_header", "read_positional", "read_typed",
]
