"""Distributed building blocks: keys, lookups, modes, densified series."""

from star_marts.operators.densify import densify
from star_marts.operators.distinct import count_keys, key_bitmaps, merge_bitmaps
from star_marts.operators.joins import lookup_join, lookup_star, size_in_bytes
from star_marts.operators.keys import modulo_bridge_key, with_surrogate_key
from star_marts.operators.modal import modal_lookup, profile_groups, weighted_mean
from star_marts.operators.ranking import top_k

__all__ = [
    "count_keys", "densify", "key_bitmaps", "lookup_join", "lookup_star", "merge_bitmaps", "modal_lookup", "modulo_bridge_key",
    "profile_groups", "size_in_bytes", "top_k", "weighted_mean", "with_surrogate_key",
]
