"""Registered queries and their SQL."""

from panelwright.plans import customer_queries, long_queries, model_queries, panel_queries, report_queries
from panelwright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "customer_queries", "long_queries", "model_queries", "panel_queries", "report_queries"]
