"""Registered queries, each with the equivalent SQL where SQL can say it."""

from panelcast.catalog import (  # noqa: F401  (imported for their registrations)
    calendars,
    evaluations,
    features,
    models,
    projections,
    qualities,
    reports,
    selections,
    serieses,
    tables,
    windowing,
)
from panelcast.catalog.base import CHECKS

__all__ = ["CHECKS"]
