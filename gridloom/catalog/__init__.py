"""Every operator as a query over the test tables, with an independent SQL form to check it.

All queries read their whole tables; filters occur only where they are the operator.
"""

from gridloom.catalog import forecasts, inputs, jobs, load, places, quality, time, weather, writes  # noqa: F401
from gridloom.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
