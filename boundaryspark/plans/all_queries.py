"""Importing the query modules fills the registry."""

from boundaryspark.plans import catalog_queries, compare_queries, intake_queries, job_queries, layer_queries, monitor_queries, source_queries, topology_queries  # noqa: F401
from boundaryspark.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
