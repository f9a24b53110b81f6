"""All registered queries."""

from jobtide.plans import flow_queries, gate_queries, quality_queries, release_queries, stock_queries  # noqa: F401  (importing registers the queries)
from jobtide.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
