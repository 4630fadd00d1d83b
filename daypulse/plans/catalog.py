"""Imports every query module so that the registry is complete."""

from daypulse.plans import (  # noqa: F401
    cdc_queries, log_queries, order_queries, sales_queries, search_queries, stream_queries)
from daypulse.plans.registry import ORACLE, QUERIES  # noqa: F401
