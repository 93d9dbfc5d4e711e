"""Registered queries over the test tables, each with its SQL twin where SQL can say it."""

from watthour.catalog import (  # noqa: F401  (importing registers the queries)
    dataset, drift, evaluate, explore, forecast, models, monitor, profile, series, store,
)
from watthour.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
