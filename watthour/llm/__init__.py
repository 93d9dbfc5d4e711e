"""Operators for preparing training text: joins, dedup, packing, scoring, mixing, sharding."""
