"""Importing this module registers every query."""

from seriesmill.plans import error_queries, fitting_queries, job_queries, model_queries, series_queries, table_queries
from seriesmill.plans.registry import REGISTRY

__all__ = ["REGISTRY", "error_queries", "fitting_queries", "job_queries", "model_queries", "series_queries", "table_queries"]
