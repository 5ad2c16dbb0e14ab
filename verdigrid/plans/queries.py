"""All registered queries and their checks."""

from verdigrid.plans import band_queries, model_queries, raster_queries, series_queries  # noqa: F401
from verdigrid.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
