"""Queries over the test tables, each with the SQL that checks it."""

from millrace.workloads import audit, chains, ingest, maintenance, messages, updates
from millrace.workloads.data import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "audit", "chains", "ingest", "maintenance", "messages", "updates"]
