"""Queries over the star tables, and the SQL each must agree with."""

from workload import documents, ingest, operators, pipeline
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "documents", "ingest", "operators", "pipeline"]
