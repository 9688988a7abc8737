"""Importing this module registers every query."""

from panelwise.plans import model_queries, panel_queries, portfolio_queries, prep_queries, scale_queries, series_queries, storage_queries  # noqa: F401
from panelwise.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
