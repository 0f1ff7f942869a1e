"""Imports every query module, so that the registry is complete."""

from merclake.plans import q_customers, q_growth, q_loads, q_quality, q_sales, q_streams  # noqa: F401
from merclake.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
