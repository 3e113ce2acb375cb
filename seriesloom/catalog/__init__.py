"""Registered queries over the test tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from seriesloom.catalog.base import ORACLES, QUERIES
from seriesloom.catalog import (  # noqa: F401  (imports register the queries)
    calendar,
    features,
    models,
    prep,
    series_stats,
)

__all__ = ["ORACLES", "QUERIES"]
